"""Suffix dedup, hard negatives and the Merkle manifest against brute force, and the queries of all three against whole tables."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from lexitrack.llm import common, hard_negatives, merkle, queries, suffix_dedup

SF = "/root/testdata/sf0.001"


# Repeated strings

def cut(texts, length=suffix_dedup.LENGTH):
    """(bytes, removed, spans, digest of the rest) of every text, from all its strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        spans = []
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                if spans and spans[-1][1] >= k:
                    spans[-1][1] = k + length
                else:
                    spans.append([k, k + length])
        kept, at = b"", 0
        for lo, hi in spans:
            kept, at = kept + d[at:lo], hi
        out.append((len(d), sum(hi - lo for lo, hi in spans), len(spans), hashlib.sha256(kept + d[at:]).hexdigest()))
    return out


def deduped(spark, rows):
    common.importable(spark)
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, text_1 string, a int").repartition(5)
    found = suffix_dedup.dedup(docs).collect()
    return sorted(repr(tuple(r)) for r in found), sorted(repr((i, *e)) for (i, _), e in zip(rows, cut([t for _, t in rows]), strict=True))


def prose(pick, n):
    return "".join(pick.choice("abcdefghij klmnop éü中") for _ in range(n))


def test_awkward_texts(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    long_one = [r for r in rows if not r[1] or len(r[1]) < 60_000]  # "word" 30,000 times twice is below
    got, want = deduped(spark, long_one)
    assert got == want
    got, want = deduped(spark, [(1, "word " * 900), (1, "word " * 900), (None, "word " * 90), (2, "x" * 399), (3, "x" * 399), (4, "y" * 401)])
    assert got == want


@pytest.mark.parametrize("seed", range(2))
def test_shared_passages_at_every_length(spark, seed):
    """Passages a byte shorter, as long as and longer than the limit, next to each other, nested, inside one text, in copies."""
    pick = random.Random(seed)
    passages = [prose(pick, n) for n in (230, 390, 399, 400, 401, 430, 800, 1500)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(pick.randint(1, 5)):
            p = pick.choice(passages)
            lo = pick.choice([0, 0, 1, pick.randrange(len(p))])
            parts += [p[lo : lo + pick.choice([len(p), 400, 420])], prose(pick, pick.choice([0, 1, 7, 300]))]
        rows.append((i, "".join(parts)))
    rows += [(i + 100, t) for i, t in rows[:7]] + [(200, rows[3][1][5:]), (201, None), (None, rows[4][1]), (3, rows[9][1])]
    for i in range(20):  # near copies: one sign differs
        base = passages[7]
        at = pick.randrange(len(base))
        rows.append((300 + i, base[:at] + "#" + base[at + 1 :]))
    got, want = deduped(spark, rows)
    assert got == want


def test_periodic_texts_have_no_anchors(spark):
    rows = [(i, t) for i, t in enumerate(["z" * 1200, "ab" * 500, "ba" * 400 + "#", "abc" * 133 + "a", "abc" * 134, ("x" * 399 + "#") * 4])]
    got, want = deduped(spark, rows)
    assert got == want


def odd_words(pick, word, n, every):
    """A word again and again, one letter in ``every`` another one: few anchors, or none for a while."""
    return "".join(pick.choice("qvxz") if pick.randrange(every) == 0 else word[k % len(word)] for k in range(n))


@pytest.mark.parametrize("seed", range(2))
def test_parts_of_nearly_periodic_texts(spark, seed):
    """Parts of all lengths near the limit, moved by any number of bytes, between others and next to prose."""
    pick = random.Random(seed)
    whole = [odd_words(pick, w, 2500, every) for w, every in (("handti ", 90), ("wh ", 150), ("ab", 40), ("keitschver ", 200), ("é中 ", 60))]
    rows = [(i, t) for i, t in enumerate(whole)]
    for i in range(50):
        parts = []
        for _ in range(pick.randint(1, 3)):
            t = pick.choice(whole)
            at = pick.randrange(len(t) - 700)
            parts += [t[at : at + pick.choice([300, 380, 398, 399, 400, 401, 402, 416, 450, 700])], prose(pick, pick.choice([0, 1, 5, 60]))]
        rows.append((100 + i, "".join(parts)))
    got, want = deduped(spark, rows)
    assert got == want


def test_places_are_looked_for_by_cells(spark, tmp_path, monkeypatch):
    """Strings without anchors that occur once, of which few may be stored and shuffled place by place."""
    pick = random.Random(3)
    texts = [odd_words(pick, prose(pick, 9) + " ", 4000, 70) for _ in range(20)]
    monkeypatch.setattr(suffix_dedup, "remove", lambda *a: None)
    common.importable(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert suffix_dedup.repeats(docs, f"{tmp_path}/steps").count() <= len(texts)
    bare = spark.read.parquet(f"{tmp_path}/steps/ranges").filter("rank < 0").select(F.sum(F.col("end") - F.col("start"))).first()[0]
    assert bare > 4 * spark.read.parquet(f"{tmp_path}/steps/strings").count() > 0


def test_least_place_is_the_first_of_its_window():
    pick = np.random.default_rng(4)
    data = np.concatenate([pick.integers(97, 99, 900), np.tile([97, 98, 99], 200)]).astype(np.uint8)
    grams = [int.from_bytes(data[k : k + suffix_dedup.GRAM].tobytes(), "little") for k in range(len(data) - suffix_dedup.GRAM + 1)]
    hashes = common.mix(np.array(grams, np.uint64) + np.uint64(1)).tolist()
    begin, size = np.array([5, 800, 1100]), np.array([300, 250, 1])
    want = [min(range(k, k + suffix_dedup.WINDOW), key=lambda j: (hashes[j], j)) for b, n in zip(begin, size, strict=True) for k in range(b, b + n)]
    assert suffix_dedup._least(data, begin, size).tolist() == want


def test_nothing_to_dedup(spark, empty):
    assert suffix_dedup.dedup(empty).count() == 0
    kept = suffix_dedup.cut(spark.createDataFrame([(7, "short"), (8, None)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]), r["spans"]) for r in kept) == [(7, b"short", []), (8, b"", [])]


def test_anchors_depend_on_near_bytes_only():
    pick = np.random.default_rng(0)
    data = pick.integers(97, 105, 300_000).astype(np.uint8)
    whole = suffix_dedup.anchors_of(data, np.array([0, len(data)]))
    part = suffix_dedup.anchors_of(data[1000:5000], np.array([0, 4000])) + 1000
    inside = whole[(whole >= 1000 + suffix_dedup.REACH) & (whole < 5000 - suffix_dedup.REACH - suffix_dedup.GRAM)]
    assert set(inside) <= set(part) <= set(whole)
    step = common.BLOCK_BYTES
    try:
        suffix_dedup.BLOCK_BYTES = 1000
        assert (suffix_dedup.anchors_of(data, np.array([0, len(data)])) == whole).all()
    finally:
        suffix_dedup.BLOCK_BYTES = step


def test_hashes_of_long_texts_come_in_pieces():
    data = np.random.default_rng(1).integers(0, 256, 200_001).astype(np.uint8)
    codes = common.byte_codes()
    for start, length in ((0, 10), (65_530, 20), (3, 190_000), (200_001, 0), (100_000, 100_001)):
        a, b = common.suffix_sums(data, np.array([start, start + length]), codes)
        value = 0
        for byte in data[start : start + length][::-1].tolist():
            value = (int(codes[byte]) + common._BASE * value) % (1 << 64)
        assert (int(a) - int(common.power(np.array([length]))[0]) * int(b)) % (1 << 64) == value


# Hard negatives

def negatives(rows, anchor, k=5):
    """rows: id, label, vector of integers or None."""
    rows = list(dict.fromkeys((i, lab, tuple(v)) for i, lab, v in rows if lab is not None and v is not None))
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, lab, v + (0,) * (width - len(v))) for i, lab, v in rows]
    place = lambda i: (1 << 63) - 1 if i is None else i
    out = []
    for one in rows:
        if not anchor(one[0]):
            continue
        scored = sorted([(-sum(x * y for x, y in zip(one[2], r[2], strict=True)), place(r[0]), r[1], r) for r in rows if r != one], key=lambda x: x[:2])
        for p, _, _, positive in [x for x in scored if x[2] == one[1]][:k]:
            fits = [x for x in scored if x[2] != one[1] and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(one[0], positive[0], rank, x[3][0], -p, -x[0]) for rank, x in enumerate(fits, 1)]
    return sorted(map(repr, out))


def mined(spark, rows, **more):
    vectors = spark.createDataFrame(rows, "id long, label int, vector array<long>").repartition(4)
    return sorted(repr(tuple(r)) for r in hard_negatives.mine(vectors, F.col("id") % 10 == 0, **more).collect())


@pytest.mark.parametrize("spread", [3, 40])
def test_negatives(spark, spread):
    common.importable(spark)
    pick = random.Random(spread)
    rows = [(i, pick.choice([0, 0, 0, 1, 2]), [pick.randint(-spread, 2 * spread) for _ in range(5)]) for i in range(300)]  # many ties
    rows += [(None, 1, [9, 9, 9, 9, 9]), (None, 0, [1] * 5), (310, None, [1] * 5), (320, 1, None), (5, 1, [7] * 5), rows[0], rows[10], (7, 2, [3, 4])]
    rows += [(1000 + i, 4, [2, 2, 2, 2, 2]) for i in range(60)] + [(400, 7, [1, 2, 3, 4, 5]), (500, 8, [0] * 5), (501, 8, [0] * 5)]
    assert mined(spark, rows, block=16) == negatives(rows, lambda i: i is not None and i % 10 == 0)


def test_zone_maps_rule_blocks_out(spark):
    """Clusters far apart: an anchor's windows need few blocks, and nothing is missed."""
    common.importable(spark)
    pick = np.random.default_rng(3)
    centres = pick.integers(-400, 400, (20, 8))
    rows = []
    for i in range(1600):  # of two clusters in one direction the second is a tenth nearer and has another label
        c = i % 40
        v = centres[c // 2] * (10 - c % 2) // 10 + pick.integers(-5, 6, 8)
        rows.append((i, c % 7, [int(x) for x in v]))
    read = []
    got = mined(spark, rows, block=32, read=read)
    assert got == negatives(rows, lambda i: i % 10 == 0) and got
    blocks = -(-1600 // 32)
    needed = [sum(sum(r["anchors"]) for r in t.collect()) / (160 * blocks) for t in read]
    assert needed[0] < 0.15 and needed[1] < 0.6


def test_no_negatives(spark):
    common.importable(spark)
    empty = spark.createDataFrame([], "id long, label int, vector array<long>")
    assert hard_negatives.mine(empty, F.col("id") % 10 == 0).count() == 0
    assert mined(spark, [(0, 1, [1, 2]), (1, 2, [1, 2])]) == []  # no positive
    assert mined(spark, [(1, 1, [1, 2]), (2, 1, [1, 2])]) == []  # no anchor


def test_large_components_are_exact(spark):
    common.importable(spark)
    big = 1 << 30
    rows = [(0, 1, [big, 3]), (1, 1, [big, 1]), (2, 2, [big, 0]), (3, 2, [big, 1]), (4, 2, [big, 2])]
    assert mined(spark, rows) == negatives(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, 1, [1 << 40]), (1, 1, [1 << 40]), (2, 2, [1])])


def test_components_become_whole_numbers(spark):
    rows = spark.createDataFrame([([0.5, -0.001],), ([float("nan")],), ([float("inf")],), ([None],), (None,), ([],)], "e array<float>")
    got = [r[0] for r in rows.select(hard_negatives.quantised(F.col("e"))).collect()]
    assert got == [[128, -1], None, None, None, None, []]


def test_curve_visits_every_cell_once():
    grid = np.array([[x, y, z] for x in range(4) for y in range(4) for z in range(4)])
    keys = [k.tobytes() for k in hard_negatives.hilbert_keys(grid)]
    assert len(set(keys)) == 64
    path = grid[sorted(range(64), key=lambda i: keys[i])]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()  # a step goes to a neighbour


# Manifest

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, k):
    out = []
    for level in levels[:-1]:
        at = k // 16 * 16
        out.append((level[at : at + 16], k - at))
        k //= 16
    return out


def manifest(rows):
    """rows: key, group, leaf, changed."""
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    own = {g: sorted([r for r in rows if r[1] == g], key=lambda r: (r[0] is not None, r[0] or 0, r[2])) for g in groups}
    trees = {g: tree([r[2] for r in own[g]]) for g in groups}
    top = tree([trees[g][-1][0] for g in groups])
    root, out = top[-1][0], []
    for n, g in enumerate(groups):
        for k, (key, _, leaf, changed) in enumerate(own[g]):
            steps = path(trees[g], k) + path(top, n)
            folded = changed or leaf
            for run, slot in steps:
                folded = h("".join([*run[:slot], folded, *run[slot + 1 :]]))
            proof = h("".join("".join(run[:slot] + run[slot + 1 :]) for run, slot in steps))
            out.append((key, leaf, trees[g][-1][0], root, proof, folded, folded == root))
    return sorted(map(repr, out))


@pytest.mark.parametrize("groups", [
    {"a": 300, "b": 1, None: 17, "é": 16, "": 2, "Z": 256}, {"one": 1}, {"one": 18}, {str(i): 1 for i in range(40)}, {"a": 16, "b": 1},
])
def test_manifest(spark, groups):
    rows = [(None if k % 50 == 7 else k // 2, g, h(f"{g}{k // 3}"), h(f"new{k}") if k % 5 == 0 else None) for g, n in groups.items() for k in range(n)]
    leaves = spark.createDataFrame(rows, "key long, group string, leaf string, changed string").repartition(6)
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    got = merkle.climb(merkle.build(leaves))
    assert got.columns == ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == manifest(rows)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_empty_manifest(spark):
    leaves = spark.createDataFrame([], "key long, group string, leaf string, changed string")
    found = merkle.build(leaves)
    assert found.root is None and merkle.climb(found).count() == 0


def test_fields(spark):
    row = spark.createDataFrame([(None, "", "é1", 12)], "a string, b string, c string, d int")
    assert row.select(merkle.row_digest(*[F.col(c) for c in "abcd"])).first()[0] == h("-0:3:é12:12")


# Queries

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, duck(SF), name, SF) is None


def test_suffix_query_over_its_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(repr((r["doc_id"], *e)) for r, e in zip(docs, cut([r["text"] for r in docs]), strict=True))
    assert sorted(repr(tuple(r)) for r in queries.op11_suffix_dedup(spark, SF).collect()) == want


def test_tampered_rows_are_those_of_the_checksum(spark):
    got = queries.op13_merkle_manifest(spark, SF).collect()
    ids = {r["doc_id"] for r in got if not r["verified"]}
    assert ids <= {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0} and len(ids) > 20
    assert math.isclose(len(ids) / len(got), 0.2, abs_tol=0.06)
