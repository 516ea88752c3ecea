"""Word breaks, phrases, fuzzy terms and query strings."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from termloom import (
    Analyzer,
    Collection,
    FieldMapping,
    QueryStringError,
    fuzzy,
    phrase,
    prefix,
    query_string,
    standard_analyzer,
    url_email_analyzer,
    wildcard,
)
from termloom.functions.query_string import MUST, MUST_NOT, SHOULD, parse_query
from termloom.functions.text import analyzed
from termloom.functions.wordbreak import ENGLISH_STOP_WORDS
from termloom.operators.term_stats import term_stats


# -- word breaks ------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "text, words",
    [
        ("The quick (“brown”) fox can’t jump 32.3 feet, right?", "the quick brown fox can’t jump 32.3 feet right"),
        ("can't 'tis x's' rock'n'roll", "can't tis x's rock'n'roll"),
        ("3.14 3,456.789 1,2,3. 10:30 1;2", "3.14 3,456.789 1,2,3 10 30 1;2"),
        ("e.g. a.b.c a:b a..b a.1 1.a 1a.b", "e.g a.b.c a:b a b a 1 1 a 1a.b"),
        ("a_b __x x__ __ _1_2_ a1b2", "a_b __x x__ _1_2_ a1b2"),
        ("日本語テキスト ひらがな 한국어", "日 本 語 テキスト ひ ら が な 한국어"),
        ("ab日本cd カタカナー_x", "ab 日 本 cd カタカナー_x"),
        ("ไทย ພາສາ", "ไทย ພາສາ"),
        ("cafe\u0301s na\u00efve a\u200db", "cafe\u0301s na\u00efve a\u200db"),
        ('א"ב foo-bar foo/bar', 'א"ב foo bar foo bar'),
        ("½ ² 😀 🇩🇪 … -- !", ""),
    ],
)
def test_word_breaks(spark, text, words):
    assert analyzed(spark, standard_analyzer(), text) == words.split()


def test_urls_and_addresses_stay_whole(spark):
    text = "See https://x.org/a?b=c, mail me.too@ex-ample.co.uk. (ftp://h/p) no@where"
    found = ["See", "https://x.org/a?b=c", "mail", "me.too@ex-ample.co.uk", "ftp://h/p", "no", "where"]
    assert analyzed(spark, url_email_analyzer(stop_words=(), lowercase=False), text) == found


def test_stop_words_go_before_lower_casing(spark):
    assert analyzed(spark, url_email_analyzer(), "The end of THE story is it") == ["the", "end", None, "the", "story", None, None]
    assert len(ENGLISH_STOP_WORDS) == 33


def test_long_tokens_are_left_out_and_read_without_recursion(spark):
    analyzer = standard_analyzer()
    for text in ("a" * 200_000, "a.b" * 50_000, "1,2" * 50_000, "x_" * 50_000 + "x", "カ" * 50_000):
        assert analyzed(spark, analyzer, f"one {text} two") == ["one", None, "two"]
    whole = standard_analyzer(max_token_length=None)
    assert [len(t) for t in analyzed(spark, whole, "b " + "a.b" * 50_000)] == [1, 150_000]


def test_tokens_are_the_slots_that_remain(spark):
    for analyzer in (Analyzer(), Analyzer(stop_words=("b",)), url_email_analyzer(), standard_analyzer(max_token_length=1)):
        row = spark.createDataFrame([("a b The the CC",), (None,)], "t string").select(
            analyzer.tokens(F.col("t")).alias("tokens"), analyzer.slots(F.col("t")).alias("slots")
        )
        for tokens, slots in row.collect():
            assert tokens == [s for s in slots if s is not None]


# -- conditions -----------------------------------------------------------------------------------------
ROWS = [
    (1, "the quick brown fox", "en", 5, ["red green", "blue"]),
    (2, "brown the quick", "en", 15, ["green red"]),
    (3, "quick red brown fox fox", "de", 25, None),
    (4, "Quack brwon fax", None, 35, []),
    (5, None, "fr", None, [None, "red"]),
    (6, "fox", "en", -3, ["blue green"]),
    (7, "don't stop a-b quicker", "de", 100, ["x"]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return Collection(
        spark.createDataFrame(ROWS, "doc_id int, text string, lang string, n int, tags array<string>"),
        mapping=FieldMapping(keywords=frozenset({"lang"})),
    )


@pytest.fixture(scope="module")
def dictionary(docs):
    return term_stats(docs.df, ["text", "tags"], docs.mapping)


def found(docs, query):
    return sorted(r["doc_id"] for r in docs.hits(query)[0].collect())


@pytest.mark.parametrize(
    "text, slop, expected",
    [
        ("quick brown", 0, [1]),
        ("quick brown", 1, [1, 3]),
        ("brown quick", 0, []),
        ("brown quick", 1, [2]),
        ("brown quick", 2, [1, 2]),
        ("quick brown fox", 1, [1, 3]),
        ("fox fox", 0, [3]),
        ("fox fox", 5, [3]),
        ("fox fox fox", 9, []),
        ("fox", 0, [1, 3, 6]),
        ("", 0, []),
        ("the", 3, [1, 2]),
    ],
)
def test_phrases(docs, text, slop, expected):
    assert found(docs, phrase("text", text, slop)) == expected


def test_equal_terms_with_slop_against_every_choice_of_places(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("wwab") + " " for _ in range(draw.randrange(1, 9))) for _ in range(150)]
    docs = Collection(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    for asked, slop in (("w w", 1), ("w w w", 2), ("w a w", 2), ("a w w b", 3), ("b w", 2)):
        terms = asked.split()

        def holds(text):
            words = text.split()
            for at in itertools.permutations(range(len(words)), len(terms)):
                moved = [p - i for i, p in enumerate(at)]
                if [words[p] for p in at] == terms and max(moved) - min(moved) <= slop:
                    return True
            return False

        assert found(docs, phrase("text", asked, slop)) == [i for i, t in enumerate(texts) if holds(t)]


def test_equal_terms_with_slop_in_a_text_that_is_full_of_them(spark):
    # Each place looks at its own surroundings only; with all places for each place this took hours.
    texts = [(1, "was a b c d e " * 2000), (2, "was a b c d e " * 2000 + "was was")]
    docs = Collection(spark.createDataFrame(texts, "doc_id int, text string"))
    began = time.monotonic()
    assert found(docs, phrase("text", "was was was", slop=2)) == []
    assert found(docs, phrase("text", "was was", slop=2)) == [2]
    assert time.monotonic() - began < 60


def test_phrases_over_array_values_and_keywords(docs):
    assert found(docs, phrase("tags", "green blue")) == [1]
    assert found(docs, phrase("lang", "en", analyzer=Analyzer())) == [1, 2, 6]


def test_a_dropped_word_keeps_its_place(spark):
    rows = [(1, "king of spain"), (2, "king spain"), (3, "king in spain"), (4, "king of of spain")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    docs = Collection(frame, mapping=FieldMapping(default=url_email_analyzer()))
    assert found(docs, phrase("text", "king of spain")) == [1, 3]
    assert found(docs, phrase("text", "king spain", slop=1)) == [1, 2, 3]


@pytest.mark.parametrize(
    "query, expected",
    [
        (lambda **o: fuzzy("text", "quick", 1, **o), [1, 2, 3, 4]),
        (lambda **o: fuzzy("text", "quick", 2, **o), [1, 2, 3, 4, 7]),
        (lambda **o: fuzzy("text", "quikc", 1, **o), [1, 2, 3]),
        (lambda **o: fuzzy("text", "quikc", 1, transpositions=False, **o), []),
        (lambda **o: fuzzy("text", "borwn", 1, **o), [1, 2, 3]),
        (lambda **o: fuzzy("text", "brown", 1, **o), [1, 2, 3, 4]),
        (lambda **o: fuzzy("text", "rbonw", 2, **o), [1, 2, 3]),
        (lambda **o: fuzzy("text", "FAX", 0, **o), [4]),
        (lambda **o: fuzzy("text", "fax", 1, prefix_length=2, **o), [4]),
        (lambda **o: fuzzy("tags", "rid", 1, **o), [1, 2, 5]),
        (lambda **o: prefix("text", "QUIC", **o), [1, 2, 3, 7]),
        (lambda **o: prefix("text", "zzz", **o), []),
        (lambda **o: wildcard("text", "*o?", **o), [1, 3, 4, 6, 7]),
        (lambda **o: wildcard("text", "f*", **o), [1, 3, 4, 6]),
        (lambda **o: wildcard("text", "%", **o), []),
    ],
)
def test_terms_by_dictionary_and_by_token(docs, dictionary, query, expected, monkeypatch):
    assert found(docs, query()) == expected
    assert found(docs, query(dictionary=dictionary)) == expected
    monkeypatch.setattr("termloom.functions.conditions.MOST_EXPANDED", 0)
    assert found(docs, query(dictionary=dictionary)) == expected


def test_a_dictionary_spares_the_test_of_every_token(docs, dictionary):
    plan = docs.hits(wildcard("text", "q?ick*", dictionary=dictionary))[0]._jdf.queryExecution().toString()
    assert " LIKE " not in plan and "RLIKE" not in plan
    assert " LIKE " in docs.hits(wildcard("text", "q?ick*"))[0]._jdf.queryExecution().toString()


# -- query strings ------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "q, expected",
    [
        ("quick fax", [1, 2, 3, 4]),
        ("quick AND fox", [1, 3]),
        ("quick && fox", [1, 3]),
        ("+quick -red", [1, 2]),
        ("quick NOT fox", [2]),
        ("quick !fox", [2]),
        ("-fox", [2, 4, 5, 7]),
        ("fox OR quick AND the", [1, 2]),
        ("quick AND (red OR the)", [1, 2, 3]),
        ('"quick brown"', [1]),
        ('"quick brown"~1', [1, 3]),
        ("lang:en", [1, 2, 6]),
        ("lang:(en OR fr) AND -text:fox", [2, 5]),
        ("n:15", [2]),
        ("n:[5 TO 25]", [1, 2, 3]),
        ("n:{5 TO 25]", [2, 3]),
        ("n:[25 TO *]", [3, 4, 7]),
        ("n:>=25 n:<0", [3, 4, 6, 7]),
        ("n:>25", [4, 7]),
        ("n:\\-3", [6]),
        ("text:[fow TO foz]", [1, 3, 6]),
        ("text:{brown TO fox}", [4, 7]),
        ("qu?ck", [1, 2, 3, 4]),
        ("qui*", [1, 2, 3, 7]),
        ("QUI*", [1, 2, 3, 7]),
        ("q\\*ick", []),
        ("quick~1", [1, 2, 3, 4]),
        ("quick~0.7", [1, 2, 3, 4]),
        ("/f[ao]x/", [1, 3, 4, 6]),
        ("_exists_:lang", [1, 2, 3, 5, 6, 7]),
        ("lang:*", [1, 2, 3, 5, 6, 7]),
        ("*:*", [1, 2, 3, 4, 5, 6, 7]),
        ("*", [1, 2, 3, 4, 5, 6, 7]),
        ("a-b", [7]),
        ("don't^2 (fax)^0.5", [4, 7]),
        ("nosuch:fox", []),
        ("", []),
        ("...", []),
        ("+... fox", [1, 3, 6]),
        ("tags:green AND tags:blue", [1, 6]),
        ('tags:"green blue"', [1]),
    ],
)
def test_query_strings(docs, dictionary, q, expected):
    assert found(docs, query_string(q, "text")) == expected
    assert found(docs, query_string(q, "text", dictionary=dictionary)) == expected


@pytest.mark.parametrize(
    "q, expected",
    [("quick fox", [1, 3]), ("quick OR fax", [1, 2, 3, 4]), ("quick -fox", [2]), ("fox quick OR red", [1, 3, 6]), ("a-b", [7])],
)
def test_all_words_by_default(docs, q, expected):
    assert found(docs, query_string(q, "text", default_operator="AND")) == expected


def test_options(docs):
    assert found(docs, query_string("en fax", ["text", "lang"])) == [1, 2, 4, 6]
    assert found(docs, query_string("en fax")) == [1, 2, 4, 6]
    assert found(docs, query_string("QUI*", "text", lowercase_expanded_terms=False)) == []
    assert found(docs, query_string("don't", "text", analyzer=Analyzer(r"[a-z']+"))) == []
    assert found(docs, query_string("Qu!ck*".replace("!", "\\!"), "text", analyze_wildcard=True)) == []
    assert found(docs, query_string("n:many", "text", lenient=True)) == []
    with pytest.raises(ValueError, match="no value of the field 'n'"):
        found(docs, query_string("n:many", "text"))
    with pytest.raises(ValueError, match="neither 'or' nor 'and'"):
        query_string("a", default_operator="xor")


@pytest.mark.parametrize(
    "q, at",
    [("a (b", 2), ("a )", 2), ("AND x", 0), ("f:", 2), ('"open', 0), ("a [1 TO", 2), ("-", 1), ("a OR", 4), ("a ^", 2), ("()(", 2)],
)
def test_errors_name_their_position(q, at):
    with pytest.raises(QueryStringError, match=f"at position {at}$"):
        parse_query(q)


def test_joints_reach_back():
    assert [o for o, _ in parse_query("a AND b OR c").clauses] == [MUST, MUST, SHOULD]
    assert [o for o, _ in parse_query("-a AND b c").clauses] == [MUST_NOT, MUST, SHOULD]
    assert [o for o, _ in parse_query("a OR b c", "and").clauses] == [SHOULD, SHOULD, MUST]


def test_a_query_string_chooses_a_page_in_one_analysis(docs):
    from termloom import FeatureSpec

    spec = FeatureSpec.from_spec([{"field": "text", "span": ["fox", "quick"]}])
    matrix = docs.vectorize_all(spec, query_string('"quick brown" OR fo*', "text"))
    assert sorted((r["doc_id"], len(r["cells"])) for r in matrix.docs.collect()) == [(1, 2), (3, 2), (6, 1)]
    assert matrix.docs._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all") <= 2
