"""Operators beside plain versions of the same definitions, on odd rows and on real ones."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from conftest_llm import as_docs, odd_rows, rows_of

from termloom.llm import (
    bpe,
    buffers,
    byte_cnn,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    sharding,
    simhash,
    suffix_dedup,
    suffixes,
    text_counts,
)
from termloom.llm.components import components
from termloom.llm.cuckoo import CuckooFilter
from termloom.llm.license_texts import TEMPLATES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
LAST = (1 << 63) - 1


def sha(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# -- 2: encoding ------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference_encoding():
    with open(RANKS, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_that_of_the_library(spark, odd, texts, reference_encoding):
    for frame, rows in ((odd, odd_rows()), (as_docs(spark, texts), texts)):
        expected = []
        for doc_id, text, *_ in rows:
            ids = reference_encoding.encode_ordinary(text or "")
            listed = " ".join(map(str, ids)).encode()
            expected.append((doc_id, len(ids), sha(listed), sha((text or "").encode())))
        got = bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN)
        assert rows_of(got) == sorted(expected, key=str)


def test_random_strings_encode_alike(reference_encoding):
    with open(RANKS, "rb") as f:
        coder = bpe.BytePairEncoder(bpe.parse_ranks(f.read()), public_tokenizers.PATTERN)
    draw = random.Random(1)
    anything = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for i in range(3000):
        pool = anything if i % 3 else "abcdetins '  \n\t.,1"
        text = "".join(draw.choice(pool) for _ in range(draw.randint(1, 60)))
        ids, listed = coder.encode(text)
        assert ids == reference_encoding.encode_ordinary(text)
        assert listed == " ".join(map(str, ids)) and coder.decode(ids) == text.encode()
    for text in ("a" * 20000, "the" * 9000, " " * 5000, "é" * 5000):
        assert coder.encode(text)[0] == reference_encoding.encode_ordinary(text)


def test_ids_round_trip(spark, odd):
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, RANKS)
    expected = sorted(((r[0], (r[1] or "").encode()) for r in odd_rows()), key=str)
    assert sorted(((r[0], bytes(r[1])) for r in decoded.collect()), key=str) == expected


# -- 4: lines -----------------------------------------------------------------------------------------
def plain_lines(rows):
    key = lambda line: ascii_lower(line.strip(BLANK))
    holders = defaultdict(set)
    named = [(LAST if d is None else d, d, t or "") for d, t, *_ in rows]
    for at, _, text in named:
        for line in text.split("\n"):
            holders[key(line)].add(at)
    out = []
    for at, doc_id, text in named:
        lines = text.split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == at]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return sorted(out, key=str)


def test_lines(spark, odd, texts):
    assert rows_of(line_dedup.dedup_lines(odd)) == plain_lines(odd_rows())
    assert rows_of(line_dedup.dedup_lines(as_docs(spark, texts))) == plain_lines(texts)


def test_lines_in_many_small_shards(spark, odd, monkeypatch):
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 1)
    monkeypatch.setattr(line_dedup, "LINES_PER_GROUP", 2)
    assert rows_of(line_dedup.dedup_lines(odd)) == plain_lines(odd_rows())


def test_line_index_learns_and_forgets(spark, texts):
    early, late = as_docs(spark, texts[:120]), as_docs(spark, texts[120:])
    index = line_dedup.LineIndex.build(early)
    grown = index.insert(late)
    whole = line_dedup.LineIndex.build(as_docs(spark, texts))
    dropped = lambda i: sorted((r[0], r[1], sorted(r[2])) for r in i.dropped().collect())
    assert dropped(grown) == dropped(whole)
    back = grown.delete(late.select("doc_id"))
    assert dropped(back) == dropped(index)
    first = as_docs(spark, texts[:1]).select("doc_id")
    assert dropped(whole.delete(first)) == dropped(line_dedup.LineIndex.build(as_docs(spark, texts[1:])))


def test_cuckoo_filter():
    draw = np.random.default_rng(2)
    keys = draw.integers(-(1 << 62), 1 << 62, 20000)
    other = draw.integers(-(1 << 62), 1 << 62, 20000)
    found = CuckooFilter(1000)  # far too small: tables are chained
    found.add(keys)
    found = CuckooFilter.from_bytes(found.to_bytes())
    assert found.contains(keys).all() and len(found.tables) > 1
    fitting = CuckooFilter(len(keys))
    fitting.add(keys)
    assert fitting.contains(keys).all() and len(fitting.tables) == 1
    assert fitting.contains(other).mean() < 0.001
    fitting.remove(keys[:10000])
    assert fitting.contains(keys[10000:]).all() and fitting.contains(keys[:10000]).mean() < 0.001
    # Chained tables, and keys that were added several times, forget one by one.
    found.remove(keys[5000:])
    assert found.contains(keys[:5000]).all() and sum(int((t > 0).sum()) for t in found.tables) == 5000
    often = np.repeat(keys[:3], 7)
    found = CuckooFilter(8)
    found.add(often)
    found.remove(np.repeat(keys[:2], [7, 6]))
    assert found.contains(keys[:3]).tolist() == [False, True, True]
    found.remove(keys[:0])
    found.remove(keys[1:3])
    assert found.contains(keys[:3]).tolist() == [False, False, True]
    found.remove(keys[:1])  # what is not there changes nothing
    assert sum(int((t > 0).sum()) for t in found.tables) == 6


# -- 5: counts ------------------------------------------------------------------------------------------
def plain_counts(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(BLANK)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_counts(texts):
    rows = [r[1] for r in odd_rows()] + [t for _, t in texts] + ["a b c d e a b c d e", "é\x0b x\n x\n\nx\n x"]
    counts = text_counts.count(pa.array(rows))
    assert list(zip(*(counts[n].tolist() for n in text_counts.NAMES))) == [plain_counts(t) for t in rows]
    assert all(len(v) == 0 for v in text_counts.count(pa.array([], pa.string())).values())


# -- 6: shards -------------------------------------------------------------------------------------------
def plain_draw(key, shard, weight):
    number = int(hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:13], 16)
    return -math.log((number + 0.5) / 16.0**13) / weight


def test_shards(odd):
    shards = [(0, 1.0), (1, 2.0), (5, 0.5)]
    rows = sharding.assign(odd, shards, overhead=16, new_shard=(7, 1.5)).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 16) for r in odd_rows()
    )
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        best = min((plain_draw(key, s, w), s) for s, w in shards)
        assert r["shard"] == best[1]
        assert r["grown_shard"] == (7 if plain_draw(key, 7, 1.5) < best[0] else best[1])
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_rows_with_one_key_are_divided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "EQUAL_BLOCK", 7)
    rows = [(None, "the same text")] * 500 + [(None, f"text {i}") for i in range(300)] + [(4, "a")] * 8 + [(5, None)] * 7
    docs = as_docs(spark, rows).repartition(5)
    got = sharding.assign(docs, [(0, 1.0), (1, 1.0)]).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for shard in (0, 1):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_weights_set_the_shares(spark):
    ids = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text")
    counts = dict(sharding.assign(ids, [(0, 1.0), (1, 3.0)]).groupBy("shard").count().collect())
    assert 0.7 < counts[1] / 4000 < 0.8
    with pytest.raises(ValueError):
        sharding.assign(ids, [(0, 0.0)])


# -- 9: repeated strings ----------------------------------------------------------------------------------
def plain_repeats(rows, length):
    order = sorted(range(len(rows)), key=lambda i: (LAST if rows[i][0] is None else rows[i][0], i))
    data = [(rows[i][1] or "").encode() for i in range(len(rows))]
    seen, out = set(), []
    for i in order:
        text, gone = data[i], bytearray(len(data[i]))
        for p in range(len(text) - length + 1):
            window = text[p : p + length]
            if window in seen:
                gone[p : p + length] = b"\x01" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((rows[i][0], len(text), sum(gone), spans, sha(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"hot_runs": 0}, {"block_bytes": 300}])
def test_repeated_strings(spark, sizes):
    draw = random.Random(3)
    base = "".join(draw.choice("abcd ") for _ in range(500))
    rows = [(3, base), (1, "xx" + base[:250] + "zz"), (2, base[100:390]), (4, "q" * 300), (5, "ab" * 150 + base[:99])]
    rows += [(6, base[200:330] + "é" + base[200:330]), (None, base), (7, None), (8, ""), (9, "short"), (10, base[50:149])]
    frame = as_docs(spark, rows).repartition(3)
    assert rows_of(suffix_dedup.remove_repeats(frame, **sizes)) == plain_repeats(rows, 100)


def test_odd_rows_lose_no_byte_wrongly(odd):
    got = suffix_dedup.remove_repeats(odd).collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(r[0]), len((r[1] or "").encode())) for r in odd_rows())
    # of equal rows of one id none comes before the other
    assert len({tuple(r) for r in got if r["doc_id"] == 2}) == 1


def test_rows_of_one_id_have_their_own_bytes(spark):
    """Null ids with texts of very different lengths: stretches stay with the text they were found in."""
    draw = random.Random(12)
    base = "".join(draw.choice("abcd ") for _ in range(400))
    rows = [(None, base[: 120 + 7 * k] + "x" * (k % 3)) for k in range(30)] + [(1, base), (1, base[:150]), (None, base)]
    got = suffix_dedup.remove_repeats(as_docs(spark, rows).repartition(4)).collect()
    size = {len(t.encode()) for _, t in rows}
    assert len(got) == len(rows) and {r["n_bytes"] for r in got} == size
    # All is in the text of document 1; what a text adds at its end covers at most its last window.
    for r in got:
        if r["doc_id"] is None:
            assert r["n_bytes"] - r["n_removed"] <= 2


def test_an_anchor_with_very_many_runs(spark):
    """One line between ever different neighbours, all in one document: its anchor is found and dissolved."""
    draw = random.Random(1)
    # A line with a gram of so small a hash that nearly every window around it has it as anchor.
    lines = ("".join(draw.choice("abcdefgh ") for _ in range(30)) for _ in range(100_000))
    line = next(x for x in lines if buffers.gram_hashes(np.frombuffer(x.encode(), np.uint8), 24).min() < 1 << 55)
    many = "".join(f"{draw.randrange(10**9):09d}{line}{draw.randrange(10**9):09d}" for _ in range(6_000))
    rows = [(1, many), (2, "y" * 130), (3, many[3_000:3_400]), (4, line * 6)]
    texts = as_docs(spark, rows).selectExpr("doc_id", "text", "xxhash64(text) AS tag")
    assert len(suffix_dedup._hot_slots(texts, 100, 24, 3_000)) >= 1
    assert len(suffix_dedup._hot_slots(texts, 100, 24, 20_000)) == 0
    dissolved = rows_of(suffix_dedup.remove_repeats(as_docs(spark, rows), hot_runs=3_000))
    assert dissolved == rows_of(suffix_dedup.remove_repeats(as_docs(spark, rows))) == plain_repeats(rows, 100)


def test_classes_of_a_block():
    draw = np.random.default_rng(5)
    block = draw.integers(97, 100, 3000).astype(np.uint8)
    block[2000:2600] = block[100:700]
    content = block.tobytes() + b"\xff"
    order, group = suffixes.classes(np.frombuffer(content, np.uint8), 20)
    strings = [content[i : i + 20] for i in order]
    assert strings == sorted(strings)
    assert all((a == b) == (x == y) for a, b, x, y in zip(strings, strings[1:], group, group[1:]))


# -- 10: fingerprints ---------------------------------------------------------------------------------------
def plain_components(rows):
    prints = []
    for _, text, *_ in rows:
        words = re.findall(f"[^{BLANK}]+", ascii_lower(text or ""))
        shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    different = sorted(set(prints))
    for i, a in enumerate(different):
        for b in different[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    ids = [LAST if r[0] is None else r[0] for r in rows]
    least = {}
    for doc_id, p in zip(ids, prints):
        least[find(p)] = min(least.get(find(p), LAST), doc_id)
    out = lambda x: None if x == LAST else x
    return sorted(((out(d), f"{p:016x}", out(least[find(p)])) for d, p in zip(ids, prints)), key=str)


def test_components_of_documents(spark, odd, texts):
    assert rows_of(simhash.near_duplicates(odd)) == plain_components(odd_rows())
    assert rows_of(simhash.near_duplicates(as_docs(spark, texts))) == plain_components(texts)


@pytest.mark.parametrize("hot", [simhash.HOT_CELL, 40])
def test_no_link_is_lost_in_dense_groups(spark, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_CELL", hot)
    draw = np.random.default_rng(1)
    values = set()
    for base in draw.integers(0, 1 << 63, 20, dtype=np.uint64):
        for _ in range(int(draw.integers(1, 200))):
            value = int(base)
            for bit in draw.integers(0, 64, int(draw.integers(0, 8))):
                value ^= 1 << int(bit)
            values.add(value)
    known = np.array(sorted(values), np.uint64)
    root = list(range(len(known)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(known)):
        for j in np.flatnonzero(np.bitwise_count(known[i + 1 :] ^ known[i]) <= 4):
            root[find(i)] = find(i + 1 + int(j))
    signed = known.view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint bigint"))
    assert links.count() < 40 * len(signed)  # far from all pairs
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    ours, theirs = defaultdict(set), defaultdict(set)
    for i, v in enumerate(signed):
        ours[roots.get(v, v)].add(v)
        theirs[find(i)].add(v)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_the_embedding_is_a_lower_bound():
    draw = np.random.default_rng(9)
    a, b = (draw.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(2))
    b[:2500] = a[:2500] ^ (np.uint64(1) << draw.integers(0, 64, 2500).astype(np.uint64))
    assert (np.bitwise_count(simhash._embedded(a) ^ simhash._embedded(b)) <= np.bitwise_count(a ^ b)).all()


# -- 1: languages ------------------------------------------------------------------------------------------
def test_code_lengths_are_those_of_the_trees(monkeypatch):
    monkeypatch.setattr(language_id, "_BLOCK", 97)
    samples = {"a": ["the cat sat on the mat and the hat", "that is that"], "b": ["les chats été là", "la la été"]}
    counts = defaultdict(lambda: defaultdict(int))
    for lang, rows in samples.items():
        batch = pa.record_batch({"lang": [lang] * len(rows), "text": rows})
        for part in language_id._gram_counts(3)(iter([batch])):
            for gram, n in zip(part.column("gram").to_pylist(), part.column("n").to_pylist()):
                counts[lang][gram] += n
    model = language_id.build_model(counts, 3)
    total = Counter()
    for table in counts.values():
        total.update(table)
    kept = {g for g in total if (g.bit_length() - 1) // 8 <= language_id.ALWAYS_KEPT or total[g] >= language_id.MIN_COUNT}

    def cost(lang, context, byte):
        ruled_out, bits = set(), 0.0
        for k in range(len(context), -1, -1):
            marked = int.from_bytes(b"\x01" + context[len(context) - k :], "big")
            follows = {g & 255: n for g, n in counts[lang].items() if g >> 8 == marked and g in kept}
            if not follows:
                continue
            whole = sum(n for b, n in follows.items() if b not in ruled_out) + len(follows)
            if byte in follows:
                return bits - math.log2(follows[byte] / whole)
            bits -= math.log2(len(follows) / whole)
            ruled_out |= set(follows)
        return bits + math.log2(256 - len(ruled_out))

    texts = ["the chat", "", "été là-bas the hat " * 20, "\x00日本", "x"]
    bits = language_id.code_lengths(model, *buffers.utf8(pa.array(texts)))
    for i, text in enumerate(texts):
        data = text.encode()
        for j, lang in enumerate(model.langs):
            expected = sum(cost(lang, data[max(0, p - 3) : p], data[p]) for p in range(len(data)))
            assert bits[i, j] == pytest.approx(expected, rel=1e-9, abs=1e-9)


# -- 3: items ------------------------------------------------------------------------------------------------
def plain_distance(item, text):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", ascii_lower(t))
    own, other = words(item), words(text)
    row = [0] * (len(other) + 1)
    for i, word in enumerate(own, 1):
        new = [i]
        for j, there in enumerate(other, 1):
            new.append(min(row[j - 1] + (word != there), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), len(own)


def test_items_are_found_up_to_the_allowed_distance(spark, small, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    draw = random.Random(5)
    vocabulary = sorted({w for _, t in items + texts[:50] for w in t.split()})
    rows = []
    for i, (_, text) in enumerate(items * 4):
        words = text.split()
        for _ in range(draw.randint(0, int(0.2 * len(words)))):
            at = draw.randrange(len(words))
            change = draw.random()
            if change < 0.34:
                words[at] = draw.choice(vocabulary)
            elif change < 0.67:
                del words[at]
            else:
                words.insert(at, draw.choice(vocabulary))
        around = texts[i % 60][1].split()[:80]
        rows.append((i, " ".join(around[:40] + words + around[40:])))
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.matches(as_docs(spark, rows), frame).collect()}
    near = {}
    for doc_id, text in rows:
        item_id, item = items[doc_id % len(items)]
        distance, size = plain_distance(item, text)
        if distance <= decontaminate.max_edits(size):
            near[doc_id, item_id] = distance
    assert len(near) > 100
    assert sum(k in got for k in near) >= 0.9 * len(near)
    by_id = dict(items)
    for (doc_id, item_id), r in got.items():  # what is found is exact
        assert plain_distance(by_id[item_id], rows[doc_id][1])[0] <= r["distance"] <= 0.2 * r["item_words"]
        passage = rows[doc_id][1].encode()[r["begin"] : r["end"]].decode()
        assert plain_distance(by_id[item_id], passage)[0] == r["distance"]


@pytest.mark.parametrize("size", [6, 10, 16, 38, 59, 100, 150, 250, 400])
@pytest.mark.parametrize("lost_only", [False, True])
def test_recall_at_the_largest_distance(size, lost_only):
    draw = random.Random(size)
    word = lambda: f"w{draw.randrange(3000)}"
    items = [[word() for _ in range(size)] for _ in range(60)]
    index = decontaminate.ItemIndex.build(list(range(60)), [" ".join(i) for i in items])
    more = lambda: [f"v{draw.randrange(3000)}" for _ in range(draw.randint(20, 50))]
    for before, after in ((False, False), (True, False), (True, True)):
        texts = []
        for item in items:
            copy = list(item)
            for _ in range(decontaminate.max_edits(size)):
                at = draw.randrange(len(copy))
                change = 1 if lost_only else draw.randrange(3)
                copy[at : at + (change != 2)] = [word()] if change != 1 else []
            texts.append(" ".join((more() if before else []) + copy + (more() if after else [])))
        found = {r[:2] for r in decontaminate.search(index, *buffers.utf8(pa.array(texts)))}
        assert sum((k, k) in found for k in range(60)) >= 0.9 * 60


@pytest.mark.parametrize("size", [6, 16, 38, 100, 250])
def test_items_that_lost_words_at_the_edges_of_a_text(size):
    draw = random.Random(size)
    items = [[f"w{draw.randrange(3000)}" for _ in range(size)] for _ in range(60)]
    index = decontaminate.ItemIndex.build(list(range(60)), [" ".join(i) for i in items])
    more = lambda: [f"v{draw.randrange(3000)}" for _ in range(draw.randint(20, 50))]
    lost = decontaminate.max_edits(size)
    for before, after in ((False, False), (True, False), (False, True)):
        texts = []
        for item in items:
            gone = set(draw.sample(range(size), lost))
            copy = [w for k, w in enumerate(item) if k not in gone]
            texts.append(" ".join((more() if before else []) + copy + (more() if after else [])))
        found = {r[:3] for r in decontaminate.search(index, *buffers.utf8(pa.array(texts)))}
        assert sum((k, k, lost) in found for k in range(60)) >= 0.9 * 60
        # what is found in a text does not depend on the texts beside it
        for k in range(20):
            alone = decontaminate.search(index, *buffers.utf8(pa.array(texts[k : k + 1])))
            assert {r[1:3] for r in alone} == {r[1:] for r in found if r[0] == k}


def test_words_of_other_scripts():
    def split(text):
        data, at = buffers.utf8(pa.array(["x", text, "y"]))
        _, row, start, end = decontaminate.words(data, at)
        content = data.tobytes()
        return [content[a:b].decode() for a, b in zip(start[row == 1], end[row == 1])]

    assert split("«Où» – “déjà”… ¿qué? l’été") == ["Où", "déjà", "qué", "l", "été"]
    assert split("日本語。テストabc12、終") == [*"日本語テスト", "abc12", "終"]
    assert split("ab日c") == ["ab", "日", "c"] and split("日") == ["日"] and split("。") == []
    assert split("ที่นี่x") == ["ที่", "นี่", "x"]  # marks stay with their letter
    assert split("e\u0301te\u0301 हिन्दी 한국어 नम") == ["e\u0301te\u0301", "हिन्दी", "한국어", "नम"]
    assert split("𠀀𠀁a😀b") == ["𠀀", "𠀁", "a", "b"]


def test_items_in_scripts_without_blanks():
    draw = random.Random(6)
    item = "".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(40))
    latin = "Il a dit : « voilà un texte assez long pour que cela compte » et puis il est parti"
    changed = item[:20] + "字" + item[21:]
    texts = ["前文" * 20 + item + "后文" * 20, "前文，" * 9 + changed + "。后文" * 9, "前文" * 40, latin.replace("« ", "“").replace(" »", "”")]
    index = decontaminate.ItemIndex.build([0, 1], [item, latin])
    found = {r[:3] for r in decontaminate.search(index, *buffers.utf8(pa.array(texts)))}
    assert found == {(0, 0, 0), (1, 0, 1), (3, 1, 0)}


def test_items_in_blocks_and_odd_items(spark, odd):
    items = [(1, "shared line of some length"), (2, None), (None, "one"), (3, ""), (4, "ONE"), (4, "one"), (5, "absent words")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    whole = rows_of(decontaminate.matches(odd, frame))
    assert rows_of(decontaminate.matches(odd, frame, block_bytes=40)) == whole
    assert {(r[0], r[1]) for r in whole} == {(1, 1), (2, 1), (None, 1), (10, 1), (11, 1), (12, 4)}
    kept = decontaminate.clean(odd, frame)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in odd_rows()} - {1, 2, None, 10, 11, 12}


# -- 8: licences -----------------------------------------------------------------------------------------------
def plain_dice(a, b):
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", ascii_lower(t))
    bags = [Counter(zip(w, w[1:])) for w in (words(a), words(b))]
    return 2 * (bags[0] & bags[1]).total() / (bags[0].total() + bags[1].total())


def test_licences(spark, odd):
    by_name = defaultdict(list)
    for name, text in TEMPLATES:
        by_name[name].append(text)
    changed = TEMPLATES[0][1].replace("free of charge", "gratis")
    rows = [(1, f"code here\n{changed}\nmore"), (2, "All Rights\nReserved!"), (3, "rights"), (4, None), (5, "all rights " * 999)]
    rows += [(100 + i, f"before {text} after") for i, (_, text) in enumerate(TEMPLATES)]
    got = defaultdict(dict)
    for r in license_scan.scan(as_docs(spark, rows)).collect():
        passage = dict(rows)[r["doc_id"]].encode()[r["begin"] : r["end"]].decode()
        assert r["dice"] == pytest.approx(max(plain_dice(passage, t) for t in by_name[r["license"]]))
        assert r["dice"] >= license_scan.THRESHOLD
        got[r["doc_id"]][r["license"]] = r["dice"]
    assert 0.9 < got[1]["MIT"] < 1 and got[2] == {"all-rights-reserved": 1.0}
    assert not {3, 4} & set(got)
    for i, (name, _) in enumerate(TEMPLATES):
        assert got[100 + i][name] == 1.0
    assert license_scan.scan(odd).count() == 0


def test_whole_texts_of_long_licences(monkeypatch):
    index = license_scan.TemplateIndex(TEMPLATES)
    whole = dict(reversed(TEMPLATES))  # the first of each name
    whole.update((n, t) for n, t in TEMPLATES if len(t) > len(whole[n]))
    names = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Artistic-1.0-Perl", "Unlicense"]
    # the last tenth, with notices and appendices, is missing
    texts = ["before " + whole[n][: len(whole[n]) * 9 // 10] + " after" for n in names]
    found = {(row, name): dice for row, name, dice, *_ in license_scan.scan_texts(index, *buffers.utf8(pa.array(texts)))}
    for row, name in enumerate(names):
        assert 0.9 < found[row, name]
    # long and short passages are compared alike
    short = ["x " + t.replace("software", "work") + " and the software, and the" for _, t in TEMPLATES[:20]]
    data = buffers.utf8(pa.array(short))
    by_arrays = license_scan.scan_texts(index, *data)
    monkeypatch.setattr(license_scan, "_LONG", 1 << 40)
    assert by_arrays == license_scan.scan_texts(index, *data)


def test_candidates_are_thinned_without_loss():
    """A begin that stands for others near it finds what each of them finds."""
    draw = random.Random(3)
    item = [f"w{k}" for k in range(40)]
    index = decontaminate.ItemIndex.build([0], [" ".join(item)])
    gone = set(draw.sample(range(40), 8))
    copy = [w for k, w in enumerate(item) if k not in gone]
    text = " ".join([f"v{k}" for k in range(50)] + copy + [f"u{k}" for k in range(50)])
    data, at = buffers.utf8(pa.array([text]))
    hashes, _, _, _ = decontaminate.words(data, at)
    low, high = np.zeros(1, np.int64), np.full(1, len(hashes))
    for begin in range(50 - 16, 50 + 17):  # up to the allowed edits before it, and as many of thinning
        found = decontaminate.verify(index, 0, np.array([begin]), hashes, low, high)
        assert found[0].tolist() == [8, 50, 82]


# -- 7: the network ------------------------------------------------------------------------------------------
def plain_score(net, data):
    step, size = byte_cnn.CHUNK - byte_cnn.OVERLAP, byte_cnn.CHUNK
    best = []
    for start in range(0, max(1, len(data) - byte_cnn.OVERLAP), step):
        chunk = data[start : start + size].ljust(size, b"\0")
        responses = [
            np.concatenate([net.embed[b] for b in chunk[p : p + byte_cnn.WIDTH]]) @ net.filters + net.shift
            for p in range(size - byte_cnn.WIDTH + 1)
        ]
        best.append(np.maximum(np.max(responses, 0), 0))
    pooled = np.concatenate([np.max(best, 0), np.mean(best, 0)])
    return 1 / (1 + np.exp(-(pooled @ net.weights + net.bias)))


def test_network_equals_a_plain_forward_pass():
    draw = random.Random(1)
    net = byte_cnn.ByteNet.fresh(3, 0.6)
    net.shift = np.linspace(-1, 1, byte_cnn.FILTERS).astype(np.float32)
    sizes = [0, 1, 7, 8, 63, 64, 65, 511, 512, 513, 575, 576, 577, 960, 961, 1500, 3000]
    data = [bytes(draw.randrange(1, 128) for _ in range(n)) for n in sizes]
    flat, at = buffers.utf8(pa.array([d.decode() for d in data]))
    expected = [plain_score(net, d) for d in data]
    assert byte_cnn.score(net, flat, at) == pytest.approx(expected, rel=1e-4)


def test_network_learns_by_its_gradient():
    """The steps that ``fit`` takes follow the slope of the log loss, measured by small differences."""
    draw = np.random.default_rng(2)
    texts = ["".join(map(chr, draw.integers(97, 123, n))) for n in (30, 700, 1200, 520)]
    labels = np.array([1, 0, 1, 0])
    flat, at = buffers.utf8(pa.array(texts))
    chunks, owner = [], []
    for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
        starts = np.array(byte_cnn.chunk_starts(int(b - a))) + a
        chunks.append(byte_cnn.cut(flat, starts, np.full(len(starts), b)))
        owner += [k] * len(starts)
    net = byte_cnn.ByteNet.fresh(7, 0.5)
    grads = byte_cnn.gradients(net, np.concatenate(chunks), np.array(owner), labels)

    def loss():
        p = np.clip(byte_cnn.score(net, flat, at), 1e-9, 1 - 1e-9)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + 5e-5 * float((net.weights**2).sum())

    for name in ("embed", "filters", "shift", "weights"):
        values, slope = getattr(net, name), grads[name]
        for place in np.argsort(-np.abs(slope).ravel())[:5]:
            at_place = np.unravel_index(place, values.shape)
            kept, step = values[at_place], 2e-3
            values[at_place] = kept + step
            up = loss()
            values[at_place] = kept - step
            down = loss()
            values[at_place] = kept
            assert (up - down) / (2 * step) == pytest.approx(float(slope[at_place]), rel=0.1, abs=2e-4)
