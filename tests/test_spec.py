import pytest

from termloom import Feature, FeatureSpec


def spec(*entries):
    return FeatureSpec.from_spec(entries)


def test_default_option_and_any_case():
    assert spec({"field": "t", "span": ["a"]}).option("t") == "term_freq"
    assert spec({"field": "t", "span": ["a"], "value": "DOC_freq"}).option("t") == "doc_freq"


def test_last_option_of_a_field_wins():
    two = spec(
        {"field": "t", "span": ["a"], "value": "binary"},
        {"field": "t", "span": ["b"], "value": "ttf"},
    )
    assert two.option("t") == "ttf" and two.n_cols == 2


def test_an_entry_without_span_only_sets_the_option():
    two = spec({"field": "t", "span": ["a"], "value": "ttf"}, {"field": "t", "value": "binary"})
    assert two.option("t") == "binary" and two.n_cols == 1


def test_first_position_of_a_repeated_term_wins():
    s = spec({"field": "t", "span": ["a", "b", "a"]}, {"field": "t", "span": ["c", "b"]})
    assert [f.term for f in s.features] == ["a", "b", "c"]


def test_same_term_in_two_fields_is_two_columns():
    s = spec({"field": "t", "span": ["a"]}, {"field": "u", "span": ["a"]})
    assert s.features == (Feature("t", "a"), Feature("u", "a"))


def test_repeated_numeric_field_merges_its_slots():
    s = spec({"field": "n", "span": 2}, {"field": "t", "span": ["a"]}, {"field": "n", "span": 3})
    assert s.slot_columns() == {"n": [0, 1, 3]} and s.n_cols == 4


@pytest.mark.parametrize("span", [0, -3])
def test_spans_without_columns(span):
    s = spec({"field": "n", "span": span})
    assert s.n_cols == 0 and s.numeric_fields == ("n",)


def test_value_of_a_numeric_entry_is_ignored():
    s = spec({"field": "n", "span": 1, "value": "doc_freq"})
    assert not s.options and not s.needs_statistics


@pytest.mark.parametrize(
    "entry, message",
    [
        ({"field": "t", "span": "a"}, "span"),
        ({"field": "t", "span": True}, "span"),
        ({"field": "t", "span": ["a"], "weight": 1}, "weight"),
        ({"span": ["a"]}, "field"),
        ({"field": "t", "span": ["a"], "value": "idf"}, "idf"),
        ({"field": "t", "span": [["a"]]}, "plain terms"),
    ],
)
def test_errors(entry, message):
    with pytest.raises(ValueError, match=message):
        spec(entry)


def test_statistics_are_needed_only_for_their_options():
    s = spec({"field": "t", "span": ["a"], "value": "binary"})
    assert s.all_binary and not s.needs_statistics
    assert s.set_value("t", "ttf").needs_statistics
    assert s.set_value("t", "ttf").features == s.features


def test_extending_keeps_columns():
    s = spec({"field": "t", "span": ["a", "b"], "value": "binary"}, {"field": "n", "span": 1})
    longer = s.extend_terms("t", ["b", "c"])
    assert longer.features[: s.n_cols] == s.features
    assert longer.feature_names() == ["t=a", "t=b", "n[0]", "t=c"]
    assert longer.option("t") == "binary"


def test_head_drops_the_label():
    s = spec({"field": "t", "span": ["a"]}, {"field": "n", "span": 1})
    assert s.head(1).features == (Feature("t", "a"),) and s.head(1).numeric_fields == ()


def test_stored_and_read_back(tmp_path):
    s = spec({"field": "t", "span": ["é", "b"], "value": "binary"}, {"field": "n", "span": 2})
    s.save(str(tmp_path / "spec.json"))
    assert FeatureSpec.load(str(tmp_path / "spec.json")) == s


def test_vocabulary_frame(spark):
    s = spec({"field": "t", "span": ["a"]}, {"field": "n", "span": 1})
    rows = [tuple(r) for r in s.vocabulary(spark).orderBy("col").collect()]
    assert rows == [(0, "t", "a", None), (1, "n", None, 0)]
