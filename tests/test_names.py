"""Collections by name, wildcard and exclusion."""

import pytest

from termloom import Collection, FeatureSpec, scan_matching
from termloom.sources.names import expand_names, list_collections

KNOWN = ["logs_1", "logs_2", "logs_old", "mail", "odd[1]", "what?"]


@pytest.mark.parametrize(
    ("expression", "options", "expected"),
    [
        ("mail", {}, ["mail"]),
        ("mail, logs_1,mail", {}, ["mail", "logs_1"]),
        ("logs_*", {}, ["logs_1", "logs_2", "logs_old"]),
        ("*_1,mail", {}, ["logs_1", "mail"]),
        ("logs_*,-*old", {}, ["logs_1", "logs_2"]),
        ("logs_*,-logs_1,+logs_1", {}, ["logs_2", "logs_old", "logs_1"]),
        ("-logs*", {}, ["mail", "odd[1]", "what?"]),
        ("", {}, sorted(KNOWN)),
        ([], {}, sorted(KNOWN)),
        ("_all", {}, sorted(KNOWN)),
        ("_all,-_all", {}, []),
        ("+mail,-nothing", {}, ["mail"]),
        ("odd[1]", {}, ["odd[1]"]),
        ("odd[1*", {}, ["odd[1]"]),
        ("what?*", {}, ["what?"]),
        ("wha??*", {}, []),
        ("none_*", {}, []),
        ("logs_*", {"closed": ["logs_old"]}, ["logs_1", "logs_2"]),
        ("logs_*", {"closed": ["logs_old"], "expand_wildcards": "closed"}, ["logs_old"]),
        ("logs_*", {"closed": ["logs_old"], "expand_wildcards": "all"}, ["logs_1", "logs_2", "logs_old"]),
        ("logs_*", {"closed": ["logs_old"], "expand_wildcards": "open,closed"}, ["logs_1", "logs_2", "logs_old"]),
        ("logs_*,mail", {"expand_wildcards": "none"}, ["mail"]),
        ("mail,gone", {"ignore_unavailable": True}, ["mail"]),
        ("logs_old", {"closed": ["logs_old"], "ignore_unavailable": True}, []),
    ],
)
def test_expression(expression, options, expected):
    assert expand_names(expression, KNOWN, **options) == expected


@pytest.mark.parametrize(
    ("expression", "options", "message"),
    [
        ("mail,gone", {}, "gone is missing"),
        ("logs_old", {"closed": ["logs_old"]}, "logs_old is closed"),
        ("none_*", {"allow_no_indices": False}, "like none_"),
        ("mail,-m*", {"allow_no_indices": False}, "left"),
        ("gone", {"allow_no_indices": False, "ignore_unavailable": True}, "left"),
        ("mail", {"expand_wildcards": "ajar"}, "ajar"),
    ],
)
def test_errors(expression, options, message):
    with pytest.raises(ValueError, match=message):
        expand_names(expression, KNOWN, **options)


def _write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))


def test_listing_and_scan(spark, tmp_path):
    _write(spark, tmp_path / "logs_1.parquet", [(1, "red fox")], "id int, text string")
    _write(spark, tmp_path / "logs_2", [(1, "red red"), (None, None)], "id int, text string")
    _write(spark, tmp_path / "mail.parquet", [(9, "fox", True)], "key int, text string, read boolean")
    (tmp_path / "_notes.parquet").mkdir()
    (tmp_path / ".hidden").mkdir()
    (tmp_path / "other.json").write_text("{}")
    assert sorted(list_collections(spark, str(tmp_path))) == ["logs_1", "logs_2", "mail"]
    both = scan_matching(spark, str(tmp_path), "logs*,mail,-*_1", columns={"mail": {"key": "id"}})
    rows = sorted((r["_index"], r["id"] or 0, r["text"], r["read"]) for r in both.collect() if r["text"])
    assert rows == [("logs_2", 1, "red red", None), ("mail", 9, "fox", True)]
    assert both.count() == 3
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["red", "fox"]}])
    cells = Collection(both, ("_index", "id")).vectorize_all(spec).to_coo().collect()
    assert sorted((c["col"], c["data"]) for c in cells) == [(0, 2.0), (1, 1.0)]


def test_nothing_left(spark, tmp_path):
    _write(spark, tmp_path / "mail.parquet", [(9, "fox")], "id int, text string")
    none = scan_matching(spark, str(tmp_path), "logs*", schema="id int, text string")
    assert none.count() == 0 and none.columns == ["id", "text", "_index"]
    spec = FeatureSpec.from_spec([{"field": "text", "span": ["red"]}])
    assert tuple(Collection(none, ("_index", "id")).vectorize_all(spec).shape().first()) == (0, 1)
    assert scan_matching(spark, str(tmp_path), "logs*").columns == ["_index"]
    with pytest.raises(ValueError, match="like logs"):
        scan_matching(spark, str(tmp_path), "logs*", allow_no_indices=False)


def test_ambiguous_names(spark, tmp_path):
    for name in ("mail", "mail.parquet"):
        _write(spark, tmp_path / name, [(9, "fox")], "id int, text string")
    with pytest.raises(ValueError, match="mail"):
        list_collections(spark, str(tmp_path))
