"""Whitening, spelling variants and token counts against plain versions of their definitions."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import CLASHING, as_docs, odd_rows
from tokenizers import Tokenizer

from termloom.llm import buffers, line_dedup, quality_rules, spelling_variants, text_counts, token_counts, whitening

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# -- whitening --------------------------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_rank_one_updates(size):
    draw = np.random.default_rng(size)
    whole = draw.normal(size=(size, size))
    whole = whole @ whole.T
    values, vectors = np.linalg.eigh(whole)
    for step in range(120):
        vector = draw.normal(size=size) * draw.choice([1e-6, 1, 100])
        if step % 5 == 0:
            vector = vectors[:, 0] * 3
        whole = whole + 0.7 * np.outer(vector, vector)
        values, vectors = whitening.rank_one(values, vectors, 0.7, vector)
    assert np.allclose(vectors * values @ vectors.T, whole, rtol=0, atol=1e-12 * np.abs(whole).max())
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-13)


def test_roots_lie_between_close_poles():
    d = np.array([0.0, 1e-9, 1.0, 1.0 + 1e-12, 5.0])
    z = np.array([0.3, 0.4, 0.5, 0.6, 0.2])
    roots, delta = whitening.secular_roots(d, z, 2.0)
    exact = np.linalg.eigvalsh(np.diag(d) + 2.0 * np.outer(z, z))
    assert np.allclose(roots, exact, atol=1e-13)
    assert (delta.diagonal() < 0).all() and (np.diag(delta, -1) > 0).all()


def test_spectra_combine_like_their_rows():
    draw = np.random.default_rng(3)
    rows = (draw.normal(size=(90, 6)) * 50 + 100_000).astype(np.int64)
    rows[60:] += 400
    parts = []
    for block in (rows[:30], rows[30:60], rows[60:]):
        part = whitening.Spectrum()
        part.widen(6)
        for row in block:
            part.add(row, 1)
        parts.append(part)
    for other in parts[1:]:
        parts[0].merge(other)
    scatter = np.cov(rows.T, bias=True) * 90
    built = parts[0].vectors * parts[0].values @ parts[0].vectors.T
    assert parts[0].n == 90 and (parts[0].sums == rows.sum(0)).all()
    assert np.allclose(built, scatter, atol=1e-10 * np.abs(scatter).max())


def plain_whitened(rows, k=8):
    """``(id, component) -> n, deviation, whitened, explained`` with the sign left open."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in good), default=0)
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in [*v, *[0.0] * (dim - len(v))]] for _, v in good])
    n, sums = len(x), x.sum(0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(dim, dim))
    order = [i for i in np.argsort(-values)[:k] if values[i] > 1e-13 * values.sum()]
    white = ((x * n - sums) / n) @ vectors[:, order] / np.sqrt(values[order])
    deviation = ((x * n - sums) ** 2).sum(1)
    return [i for i, _ in good], n, deviation, white, values[order] / values.sum()


def check_whitened(got, rows):
    ids, n, deviation, white, explained = plain_whitened(rows)
    k = white.shape[1]
    assert len(got) == n * k
    # The components of one row follow each other.
    chunks = sorted((got[i : i + k] for i in range(0, n * k, k)), key=lambda c: (str(c[0]["vec_id"]), c[0]["deviation"]))
    by_row = [r for chunk in chunks for r in chunk]
    assert all([r["component"] for r in chunk] == list(range(1, k + 1)) for chunk in chunks)
    order = sorted(range(n), key=lambda j: (str(ids[j]), deviation[j]))
    table = np.array([r["whitened"] for r in by_row]).reshape(n, k)
    assert [r["deviation"] for r in by_row[::k]] == [int(deviation[j]) for j in order]
    sign = np.sign((table * white[order]).sum(0))
    assert np.allclose(table * sign, white[order], atol=1e-9)
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    assert np.allclose([r["explained"] for r in by_row[:k]], explained, rtol=1e-10)


def test_whitening_of_the_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    check_whitened(whitening.whiten(table.repartition(7)).collect(), rows)


def test_whitening_of_odd_rows(spark):
    draw = np.random.default_rng(5)
    usual = [[float(np.float32(c)) for c in row] for row in draw.normal(size=(40, 5))]
    rows = [(i, v) for i, v in enumerate(usual)]
    rows += [(3, usual[3]), (None, usual[4]), (41, None), (42, [1.0, None, 0.0, 0.0, 0.0])]
    rows += [(43, [float("nan"), 0.0, 0.0, 0.0, 0.0]), (44, [float("inf")] * 5), (45, []), (46, [0.5])]
    extra = ", ".join(f"{c} string" for c in CLASHING if c != "label")
    marks = ["x"] * (len(CLASHING) - 1)
    frame = spark.createDataFrame([(*r, *marks) for r in rows], f"vec_id bigint, embedding array<float>, {extra}")
    check_whitened(whitening.whiten(frame).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, None)], [(1, []), (2, [])], [(1, [0.5]), (2, [0.5])]])
def test_whitening_without_variance(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = whitening.whiten(frame)
    assert found.columns == whitening.RESULT.names and found.collect() == []


def test_equal_rows_weigh_as_often_as_they_occur(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(50)] + [(50, [1.0, 0.0, 3.0]), (51, [4.0, 2.0, 3.5])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    check_whitened(whitening.whiten(frame).collect(), rows)


def test_deviation_beyond_64_bits_is_null():
    huge = np.array([[1 << 40, 3], [5, 4]], np.int64) << 22
    assert whitening._deviations(huge).to_pylist() == [None, (5 << 22) ** 2 + (4 << 22) ** 2]


# -- spelling variants ----------------------------------------------------------------------------
def plain_variants(rows):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    holds = {}
    for w in words:
        for i in range(len(w)):
            holds.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
    near = {w: set() for w in words}
    for (_, left), group in holds.items():
        for w in group:
            near[w].update(v for v in group if v != w)
            if left in words:
                near[w].add(left)
                near[left].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def spelt(frame, **options):
    return sorted(map(tuple, spelling_variants.variants(frame, **options).collect()), key=str)


@pytest.mark.parametrize("group_rows", [20_000, 8])
def test_variants_of_the_table(spark, small, texts, group_rows):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    assert spelt(frame, group_rows=group_rows) == plain_variants(texts)


@pytest.mark.parametrize("group_rows", [20_000, 3])
def test_variants_around_one_hot_beginning(spark, group_rows):
    """Nearly all words share their halves; edits stand at every place, also at both ends."""
    stem = "spellings"
    words = {stem[:i] + c + stem[i + k :] for i in range(10) for c in ("", "a", "é", "s", "zz") for k in (0, 1)}
    rows = [(i, " ".join(sorted(words)) + f" {stem}" * i + " aaaaa aaaaaa AAAAAAA ÿÿÿÿÿ") for i in range(5)]
    assert spelt(as_docs(spark, rows), group_rows=group_rows) == plain_variants(rows)


def test_variants_of_odd_rows(spark, odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert spelt(odd) == plain_variants(rows)
    assert spelt(none) == []
    long = [(1, "x" * 5_000 + " " + "y" * 70), (2, None), (None, "x" * 5_000 + "z"), (2, "")] * 3
    assert spelt(as_docs(spark, long)) == plain_variants(long)


def test_digests_are_crc32():
    runs = [b"a", b"spelling", b"x" * 64, b"x" * 65, "é".encode() * 40]
    text = np.frombuffer(b" ".join(runs), np.uint8)
    ends = np.cumsum([len(r) + 1 for r in runs]) - 1
    starts = ends - [len(r) for r in runs]
    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in range(len(runs))], np.uint32)
    found = spelling_variants._digests(text, starts, ends, seeds)
    assert found.tolist() == [zlib.crc32(f"{i}:".encode() + r) for i, r in enumerate(runs)]


# -- token counts --------------------------------------------------------------------------------
ODD_TEXTS = [
    "don't can't WE'LL 'll '' 's ''s 'sx x're're 'rex 'Re 5's a'b'c'd 'mm",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <| <|x",
    "\x00\x01 a\x0bb\x0cc\x1cd\x7f\x85e\xa0f",
    "İstanbul Σίσυφος ΟΔΟΣ é é ≮ ≮ Ångstrom K's it’s",
    "日本語テキスト 한국어 １２３ ①② ½ x²",
    "😀😃 👨‍👩‍👧 🇩🇪",
    "a" * 3000 + " " + "=" * 700 + " " + "1" * 50,
    "é" * 600 + " =" + "=" * 700,
    "",
    None,
    "  \t\n ",
    "naïve's café'll ÀÉ'S İ's ẞ ﬁ ǅ",
    "<|endoftext|><|endoftext|>x<|endof",
    "tab\tnew\rline sep p　i",
]


def plain_tokens(rows):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    counts = [(i, t or "", len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    return sorted(((i, len(t.encode()), n, n > 2048) for i, t, n in counts), key=str)


def counted(frame, **options):
    return sorted(map(tuple, token_counts.count_tokens(frame, WORD_BPE, **options).collect()), key=str)


@pytest.mark.parametrize("hot_bytes", [0, 4_000, token_counts.HOT_BYTES])
def test_token_counts_equal_the_library(spark, texts, hot_bytes):
    rows = texts + list(enumerate(ODD_TEXTS))
    assert counted(as_docs(spark, rows), hot_bytes=hot_bytes) == plain_tokens(rows)


def test_token_counts_of_odd_rows(spark, odd, none):
    assert counted(odd) == plain_tokens([(r[0], r[1]) for r in odd_rows()])
    assert counted(none) == []


def test_a_long_piece_in_every_row(spark):
    rows = [(i, f"{'#' * 400} {'é' * 300} row {i}") for i in range(60)]
    assert counted(as_docs(spark, rows)) == plain_tokens(rows)


def test_other_ways_of_splitting_are_refused():
    with pytest.raises(ValueError):
        token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))


# -- hashes of ranges ----------------------------------------------------------------------------
def thue_morse(size: int, a: str, b: str) -> str:
    return "".join(b if bin(i).count("1") % 2 else a for i in range(size))


@pytest.mark.parametrize("size", [1_024, 4_096, 65_536])
@pytest.mark.parametrize("a, b", [("a", "b"), ("0", "z"), ("x", "!")])
def test_complements_do_not_collide(size, a, b):
    one, two = thue_morse(size, a, b), thue_morse(size, b, a)
    text = f"{one}\n{two}\n{one} {two} {one}x {two}x {one}y {two}y"
    counts = text_counts.count(pa.array([text, f"{one}\n{one}\n{two}"]))
    assert counts["n_dup_lines"].tolist() == [0, 1] and counts["n_repeat_words"].tolist() == [0, 0]
    buffer = np.frombuffer((one + two + one).encode(), np.uint8)
    hashes = buffers.RangeHash(buffer).of(np.arange(3) * size, np.arange(1, 4) * size)
    assert hashes[0] == hashes[2] != hashes[1]


def test_range_hashes_equal_plain_polynomials():
    draw = np.random.default_rng(2)
    buffer = draw.integers(0, 256, 4_000).astype(np.uint8)
    buffer[1_000:1_500] = buffer[3_000:3_500]
    hashes = buffers.RangeHash(buffer)
    starts = draw.integers(0, 3_000, 200)
    ends = starts + draw.integers(0, 1_000, 200)
    prime = (1 << 61) - 1
    for s, e in zip(starts.tolist(), ends.tolist()):
        value = 0
        for byte in buffer[s:e][::-1].tolist():
            value = (value * buffers._PLACES[0] + byte + 1) % prime
        raw = np.array([value], np.uint64) + np.uint64(((e - s) * 0xD6E8FEB86659FD93) % (1 << 64))
        assert hashes.of(np.array([s]), np.array([e]))[0] == buffers.mix(raw)[0]
    for width in (3, 8, 24, 29):
        grams, same = buffers.gram_hashes(buffer, width), 501 - width
        assert len(grams) == 4_001 - width and (grams[1_000 : 1_000 + same] == grams[3_000 : 3_000 + same]).all()
        distinct = {buffer[i : i + width].tobytes() for i in range(4_001 - width)}
        assert len(np.unique(grams)) == len(distinct)


def test_long_ranges_are_hashed_in_parts(monkeypatch):
    monkeypatch.setattr(buffers, "_PART", 100)
    buffer = np.random.default_rng(4).integers(0, 256, 3_000).astype(np.uint8)
    buffer[2_000:2_555] = buffer[17:572]
    hashes = buffers.RangeHash(buffer)
    found = hashes.of(np.array([17, 2_000, 18]), np.array([572, 2_555, 573]))
    assert found[0] == found[1] != found[2]


# -- quality rules: a group's sketch and that of its language --------------------------------------
def test_verdicts_do_not_turn_over_with_one_more_document(spark):
    """A small source unlike its language: its verdict changes step by step, not at one size."""
    plain = " ".join(f"word{i}" for i in range(40))
    marked = " ".join(f"#$#$word{i}##" for i in range(40))
    def share(n):
        rows = [(i, plain + f" {i}", "en", "usual") for i in range(400)]
        rows += [(1_000 + i, marked + f" {i}", "en", "other") for i in range(n)]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
        limits = quality_rules.fences(quality_rules.sketch(quality_rules.measure(frame).persist()))
        row = limits.where("source = 'other'").first()
        return row["symbols_high"]
    sizes = [1, 10, 49, 50, 51, 200]
    highs = [share(n) for n in sizes]
    assert highs[2] == highs[3] or abs(highs[3] / highs[2] - 1) < 0.2
    assert highs[0] < 1 < highs[-1]


# -- line index: changes -------------------------------------------------------------------------------
def dropped_lines(index):
    return sorted((str(r["doc_id"]), sorted(r["dropped"])) for r in index.dropped().collect())


def test_null_ids_are_deleted(spark):
    rows = [(1, "a line that is long enough\nanother line of its own"), (None, "a line that is long enough"), (2, "another line of its own")]
    index = line_dedup.LineIndex.build(as_docs(spark, rows))
    assert len(dropped_lines(index)) == 2
    gone = index.delete(spark.createDataFrame([(None,)], "doc_id bigint"))
    assert gone.refs.count() == 3 and dropped_lines(gone) == [("2", [0])]


def test_filters_grow_with_their_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 20)
    early = [(i, f"the first shared line number {i % 10}") for i in range(20)]
    late = [(100 + i, f"one of very many later lines {i % 150}") for i in range(300)]
    grown = line_dedup.LineIndex.build(as_docs(spark, early)).insert(as_docs(spark, late))
    whole = line_dedup.LineIndex.build(as_docs(spark, early + late))
    assert grown.shards >= whole.shards > 1 and grown.filters.count() == grown.shards
    assert dropped_lines(grown) == dropped_lines(whole)
    late_ids = as_docs(spark, late).select("doc_id")
    assert dropped_lines(grown.delete(late_ids)) == dropped_lines(line_dedup.LineIndex.build(as_docs(spark, early)))
