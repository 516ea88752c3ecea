import random

import pytest

# Columns whose names operators might use themselves.
CLASHING = [
    "shard", "size", "slot", "row", "pos", "hi", "lo", "first_doc", "at", "anchor", "run", "tag", "fingerprint",
    "component_id", "cell", "value", "node", "root", "label", "score", "kept", "rule", "bucket", "item", "distance",
    "lang_pred", "n_words", "dropped", "block", "share", "drawn", "key", "line", "filter", "salt", "wanted", "gone",
    "__id", "__row", "__gone", "__lines", "__kept", "__lang", "__bits", "__head", "__hit", "___id", "__N_lines",
]


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    draw = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta", "été", "naïve", "straße", "x1", "##", "$%", "日本"]
    long = " ".join(draw.choice(words) for _ in range(9000))
    line = "A shared line of some length"
    same = "The same text twice over, with words enough to be compared at all.\n" + line
    return [
        (1, same, "en", "s"),
        (2, same, "en", "s"),
        (2, same, "en", "s"),
        (3, None, "en", "s"),
        (4, "", "de", None),
        (5, "   \n\t\n", None, "s"),
        (6, long, "fr", "s"),
        (7, long + " end", "fr", None),
        (None, same + "\nand more", None, None),
        (9, "12345 67890 !!!", "de", "t"),
        (10, f" {line.upper()}\t\n\nother line here\n{line}", "de", "t"),
        (11, "\n".join([line] * 3), "en", "t"),
        (-5, "\x00\x01 a\x0bb\x0cc", "en", "t"),
        (12, "one", "es", "t"),
        (12, "two rows share an id", "es", "t"),
        (13, "nbsp  here there", "es", "t"),
    ]


@pytest.fixture(scope="session")
def schema():
    extra = ", ".join(f"{c} string" for c in CLASHING)
    return f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}"


@pytest.fixture(scope="session")
def odd(spark, schema):
    rows = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(CLASHING)) for r in odd_rows()]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def none(spark, schema):
    return spark.createDataFrame([], schema)


@pytest.fixture(scope="session")
def texts(spark, small):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


def as_docs(spark, rows):
    return spark.createDataFrame([(r[0], r[1], None, None) for r in rows], "doc_id bigint, text string, lang string, source string")


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)
