"""Each operator against brute force on rows with every awkward case; see conftest for them."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexitrack.llm import (
    byte_bpe, decontaminate, fingerprint, id_planes, jaccard_join, language_id, lm_score, pii, quality, secret_scan,
)
from lexitrack.llm.common import blocks, tokenizer_path

SMALL = {i: i + 32 for i in range(65, 91)}


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", (text or "").translate(SMALL)) if w]


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# Language

def test_language(docs, empty):
    model = language_id.train(docs.filter(F.length("text") < 1000))  # of so few rows a long one would be most of a language
    found = {r["text"]: r["l"] for r in language_id.predict(docs, model, out="l").collect()}
    assert found[None]["lang"] == found[""]["lang"] == found["12 34 !!"]["lang"] == "und"
    assert [found[t]["lang"] for t in found if t and t.startswith(("The", "Der"))] in (["en", "de"], ["de", "en"])
    assert all(0 <= r["score"] <= 1 for r in found.values())
    nothing = language_id.train(empty)
    assert {r["l"]["lang"] for r in language_id.predict(docs, nothing, out="l").collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


@pytest.mark.parametrize("languages", [1, 2, 4, 9, 40])
def test_codewords_differ(languages):
    code = language_id.codewords(languages)
    assert len({tuple(r) for r in code.tolist()}) == languages


# Scores of a language model

def test_lm_score(docs, empty):
    rows = rows_of(docs)
    texts = [words(t) for _, t in rows]
    counts = Counter(tuple(w[i : i + n]) for w in texts for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(map(len, texts))
    expected = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        own = Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))

        def score(g):
            c = counts[g] - own[g]
            if len(g) == 1:
                return (c or 0.4) / max(1, total - len(w))
            return c / (counts[g[:-1]] - own[g[:-1]]) if c else 0.4 * score(g[1:])

        expected.append((doc_id or 0, len(w), round(sum(math.log10(score(tuple(w[max(0, i - 2) : i + 1]))) for i in range(len(w))), 4)))
    found = [(r["doc_id"] or 0, r["n_words"], round(r["score"], 4)) for r in lm_score.score(docs).collect()]
    assert sorted(found) == sorted(expected)
    assert lm_score.score(empty).count() == 0


# Quality

def test_non_negative_risk_separates():
    random = np.random.default_rng(0)
    good, bad = random.normal(1, 0.5, (400, 5)), random.normal(-1, 0.5, (400, 5))
    model = quality.fit(good[:200], np.concatenate([good[200:], bad[:66]]), 0.75)
    assert (model.scores(good) > 0.5).mean() > 0.97 and (model.scores(bad) < 0.5).mean() > 0.95


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (9, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    found = quality.score(docs, model, out="q")
    scores = [r["q"] for r in found.collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    assert quality.score(docs, quality.train(empty, labels.limit(0)), out="q").select("q").distinct().count() == 1


def test_samples_are_bounded_and_drawn_by_row(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 1, F.concat(F.lit("text "), "id")).alias("text"))
    x = quality._sampled(rows.repartition(5), 300)  # two thirds without a text, half of these without an id
    nothing = quality.features(pa.array([""]).cast(pa.large_string()))[0]
    assert len(x) == 300 and 170 < (x == nothing).all(1).sum() < 230
    assert (x == quality._sampled(rows.repartition(2), 300)).all() and len(quality._sampled(rows, 5000)) == 3000


def test_equal_texts_have_equal_features():
    many = pa.array(["ab cd", "", "Ab!", "ab cd", "\n", "ab cd"]).cast(pa.large_string())
    x = quality.features(many)
    assert (x[0] == x[3]).all() and (x[0] == x[5]).all()
    assert np.allclose(x[0], quality.features(pa.array(["ab cd"]).cast(pa.large_string()))[0])


# Secrets

BASE = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
}


def base_secrets(text):
    keep = {"assign": lambda m: len(m[1]) >= 12, "access": lambda m: len(m[0]) >= 18, "hex": lambda m: len(m[0]) >= 16}
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text, re.A) if keep[k](m)]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def test_secrets(docs, empty):
    for r in secret_scan.scan(docs, out="s").collect():
        found = [(s["kind"], s["start"], s["end"]) for s in r["s"]]
        assert [s for s in found if s[0] != "literal"] == base_secrets(r["text"] or "")
    assert secret_scan.scan(empty).count() == 0
    masked = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs).collect()}
    assert masked[9].startswith("<assign>' mail") and masked[6] is None


def test_constants_reach_their_targets():
    text = 'a = "Zk39Xq20LmPw81"\nb = a\ndb.password = b\nurl = "http://x.y/abc123XYZ"\nconf = {"clientSecret": "aB3" + "dE5fG7hJ9kL"}'
    assert [text[a:b] for _, a, b, _ in secret_scan.spans(text)] == ["Zk39Xq20LmPw81", "aB3", "dE5fG7hJ9kL"]
    assert secret_scan.spans("password_file: /etc/some/path\ncolour = blue") == []


def test_typed_long_and_later_values():
    value = "Zk39Xq20LmPw81"
    forms = [
        'password: str = "{}"', 'const apiKey: string = "{}"', 'var password string = "{}"', 'let token: &str = "{}"',
        "static PASSWORD: &'static str = \"{}\"", 'secret: Optional[str] = "{}"', 'password: str | None = "{}"',
        "password:\n  {}\nother: x", 'password = (\n    "{}"\n)', "password: |\n  {}\nother: x", 'password = """\n{}\n"""',
        'db.password = KEY\nKEY = "{}"', 'db.password = b\nb = a\na = "{}"',
    ]
    for form in forms:
        text = form.format(value)
        found = [text[a:b].strip() for _, a, b, _ in secret_scan.spans(text)]
        assert len(found) == 1 and value in found[0], text
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIB" + "aB3x" * 10 + "\n-----END RSA PRIVATE KEY-----"
    assert [pem] == [("k:\n" + pem)[a:b] for _, a, b, _ in secret_scan.spans("k:\n" + pem)]
    for text in ("a:" * 50_000, "a: |\n  " * 20_000, 'a="""' * 40_001, "a:\n  b" * 20_000, "a=(\n" * 20_000, "a: " + "b|" * 50_000):
        secret_scan.spans(text)


def test_secrets_are_linear():
    for text in ("a" * 200_000, "token" * 30_000, "a=" * 50_000, '"' * 50_000 + "=", "token " + " " * 100_000):
        secret_scan.spans(text)


# Decontamination

def windows(items):
    out = {}
    for item, text in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            out.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    return out


def test_decontamination(spark, docs, empty):
    items = [
        (1, "fox jumps over the lazy dog near the old river bank today and"), (2, "Wiese, und!"), (3, None), (4, ""),
        (5, "quick brown fox jumps over the lazy dog near the old river bank today and sleeps now then"), (6, "word " * 20), (7, "und"),
    ]
    table = spark.createDataFrame(items, "item_id long, text string")
    known = windows(items)
    found = decontaminate.find(docs, table, out="b").collect()
    assert len(found) == docs.count()
    for r in found:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(SMALL))
        hit, names = set(), set()
        for size in {len(k) for k in known}:
            for i in range(len(w) - size + 1):
                if s := known.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= s
        assert (r["b"]["n_words"], r["b"]["n_hit"], r["b"]["items"]) == (len(w), len(hit), sorted(names))
    assert decontaminate.find(empty, table).count() == 0
    assert {r["b"]["n_hit"] for r in decontaminate.find(docs, table.limit(0), out="b").collect()} == {0}


# Stored ids

@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(kind):
    for ids in ([5], [0, 0], [1, 65535, 70000, 2**31], list(range(3000))):
        x = np.array(ids, np.uint32)
        assert (id_planes.from_planes(id_planes.to_planes(x, kind), len(x), kind) == x).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_stored_ids(docs, kind, monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path(id_planes.VOCABULARY))
    found = sorted(id_planes.store_and_read(docs, kind=kind).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in rows_of(docs)), key=lambda i: -1 if i is None else i)
    start, texts = 0, {i: t for i, t in rows_of(docs)}
    for r in found:
        ids = np.array([*plain.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_join():
    data = np.random.default_rng(0).bytes(4000)
    parts = [data[:400], data[400:2400], data[2400:]]
    lists = pa.array([[{"piece": i, "n": len(p) // 4, "crc": zlib.crc32(p)} for i, p in enumerate(parts)]])
    assert next(id_planes._joined_crc(iter([lists]))).to_pylist() == [zlib.crc32(data)]


# Fingerprints

def test_fingerprints(docs, empty):
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    found = {r["doc_id"]: r for r in fingerprint.with_next_text(docs).collect()}
    assert found[1]["next_text"] == found[2]["text"] and found[13]["next_text"] == rows[0][1]
    assert fingerprint.with_next_text(empty).count() == 0
    alone = fingerprint.with_next_text(docs.filter("doc_id = 4")).first()
    assert alone["next_text"] == alone["text"]
    one = fingerprint.sketch(docs, "text", "a").select("doc_id", "text", "a")
    sets = {}
    for r in one.collect():
        w = re.split(r"[ \t-\r]+", (r["text"] or "").lower())
        w = [x for x in w if x]
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(r["a"]) == min(128, len(sets[r["doc_id"]])) and r["a"] == sorted(r["a"])
    pair = one.filter("doc_id = 1").select("a").crossJoin(one.filter("doc_id = 3").select(F.col("a").alias("b")))
    a, b = sets[1], sets[3]
    near, inside, size = pair.select(
        fingerprint.resemblance(F.col("a"), F.col("b")), fingerprint.containment(F.col("a"), F.col("b")),
        fingerprint.distinct_shingles(fingerprint.merge([F.col("a"), F.col("b")])),
    ).first()
    assert (near, inside, size) == (pytest.approx(len(a & b) / len(a | b)), pytest.approx(len(a & b) / len(a)), len(a | b))
    merged = fingerprint.merge_groups(one.withColumn("k", F.lit(1)), ["k"], "a").first()["a"]
    assert merged == sorted({v for r in one.collect() for v in r["a"]})[:128]


# Personal data

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        twice = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_pii(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PII.items()) for m in re.finditer(p, text) if counts(k, m[0])]
    return [(k, a, b) for a, _, b, k in sorted(found)]


def test_personal_data(spark, docs, empty):
    more = ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.4", "+1(((((", "4111-1111 1111-1111 1", "a@b" + ".c" * 5000, "1.1.1.1 " * 700, "é😀 x@y.zz"]
    rows = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    for r in pii.find(docs.select("doc_id", "text").unionByName(rows), out="s").collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["s"]] == base_pii(r["text"] or "")
    assert pii.find(empty).count() == 0
    assert pii.find(docs, out="s").columns == [*docs.columns, "s"]


def test_disclosing_terms(spark):
    texts = [f"Call Zorro at zz@x.com now {w}" for w in ("red", "blue", "green")] + [f"now call {i}" for i in range(60)] + ["Zorro left"]
    rows = spark.createDataFrame([(t,) for t in [*texts, texts[0], texts[0]]], "text string")
    found = pii.find(rows, min_bits=3.0).select("text", pii.masked(F.col("text"), F.col("spans")).alias("clean")).collect()
    clean = {r["text"]: r["clean"] for r in found}
    assert clean["Zorro left"] == "<TERM> left" and clean["now call 3"] == "now call 3"
    assert clean[texts[0]] == "Call <TERM> at <EMAIL> now red"


# Byte-level BPE

def test_byte_bpe(docs, empty):
    import public_tokenizers
    import tiktoken

    path = tokenizer_path(byte_bpe.VOCABULARY)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.Vocabulary(path).ranks, special_tokens={})
    for r in byte_bpe.round_trip(docs, out="b").collect():
        ids = np.array(plain.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        text = (r["text"] or "").encode()
        assert tuple(r["b"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())
    both = byte_bpe.decode_ids(byte_bpe.encode(docs, out="ids"))
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in both.collect())
    assert byte_bpe.encode(empty).count() == 0


def test_byte_bpe_passes_ids_on_by_blocks():
    path = tokenizer_path(byte_bpe.VOCABULARY)
    texts = [None, "", *(f"{'word é ' * (i % 900)}{i}" for i in range(4000)), "long " * 400_000]
    parts = list(byte_bpe.id_lists(iter([pa.array(texts)]), path))
    whole, at, _, _ = byte_bpe.encode_block(next(blocks(pa.array(texts), 1 << 40)), path)
    assert max(map(len, parts)) <= 1024 and len(parts) > 10
    assert sum(map(len, parts)) == len(texts)
    assert np.array_equal(np.concatenate([p.flatten().to_numpy() for p in parts]), whole.astype(np.int32))
    assert np.array_equal(np.concatenate([p.value_lengths().to_numpy() for p in parts]), np.diff(at))


def test_classes_equal_the_library():
    """Slices of every awkward mixture, in blocks of several sizes, begin where the pattern's matches do."""
    import public_tokenizers
    import regex

    random = np.random.default_rng(5)
    parts = ["'s", "'re", "'", " ", "  ", "\n", "a", "é", "中", "1", "!", "?.", "s", "ll", "\x85", " ", "x" * 70]
    texts = ["".join(random.choice(parts, random.integers(0, 12))) for _ in range(3000)] + [""]
    for limit in (50, 1 << 20):
        got = []
        for block in blocks(pa.array(texts), limit):
            data, offsets = byte_bpe.raw(block)
            leads = np.flatnonzero((data & 0xC0) != 0x80)
            firsts = np.isin(leads, offsets[:-1][offsets[:-1] < offsets[1:]])
            starts = [*leads[byte_bpe.slice_starts(byte_bpe.code_points(data), firsts)].tolist(), len(data)]
            got += [data[a:b].tobytes().decode() for a, b in zip(starts, starts[1:], strict=False)]
        assert got == [m for t in texts for m in regex.findall(public_tokenizers.PATTERN, t)]


# Jaccard join

def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    return sorted((d or 0, len(sets[i]), (least[find(i)] if sets[i] else d) or 0) for i, (d, _) in enumerate(rows))


def test_jaccard_join(spark, docs, empty):
    random = np.random.default_rng(1)
    rows, base = rows_of(docs), [f"w{i}" for i in random.integers(0, 5000, 400)]
    for k in range(90):  # chains and stars of edits, some too far, and one passage that all share
        text = list(base[(k % 3) * 100 : (k % 3) * 100 + random.integers(20, 100)])
        for _ in range(random.integers(0, 4)):
            text[random.integers(0, len(text))] = f"x{random.integers(0, 50)}"
        rows.append((1000 + k, " ".join(text + base[300:330] * (k % 2))))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in jaccard_join.join(table).collect())
    assert found == brute_components(rows)
    assert jaccard_join.join(empty).count() == 0


def test_near_copies_without_or_with_one_id(spark):
    base = [[f"{c}{i}" for i in range(60)] for c in "abcd"]
    near = [" ".join([*b, "more"]) for b in base]
    plain = [" ".join(b) for b in base]
    rows = [
        (None, plain[0]), (7, near[0]), (None, plain[1]), (None, near[1]),  # without ids
        (3, plain[2]), (3, plain[3]), (4, near[3]), (5, near[2]), (3, "some third text of this id"), (3, plain[2]),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_join.components_of(table).collect()
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in found) == brute_components(rows)
    assert sum(r["first"] for r in found) == 6  # one of each of five components, one of them twice
    assert jaccard_join.join(table).columns == ["doc_id", "n_shingles", "component_id"]


def test_linked_sets_share_a_key():
    random = np.random.default_rng(2)
    for _ in range(1500):
        a = random.integers(0, 2**63, random.integers(3, 300)).astype(np.uint64)
        gone = random.integers(0, len(a) // 5 + 1)
        b = np.concatenate([a[gone:], random.integers(0, 2**63, random.integers(0, len(a) // 5 + 1)).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if jaccard_join.linked(a, b) and not np.array_equal(a, b):
            assert len(np.intersect1d(jaccard_join.keys(a), jaccard_join.keys(b)))
            assert len(np.intersect1d(jaccard_join.keys(a, 7, 1), jaccard_join.keys(b, 7, 1)))
        assert jaccard_join.apart(jaccard_join.sketch(a), jaccard_join.sketch(b)) <= len(np.setxor1d(a, b))


# Pipeline

def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old river bank today and")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, str(tmp_path))
        assert kept.columns == before.columns, name
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert sorted(texts, key=lambda i: i or 0) == [None, 4, 9, 10, 12, 13] and kept.count() == 6
    assert "<EMAIL>" in texts[9] and "<PHONE>" in texts[9] and "<IP>" in texts[9] and "<CARD>" in texts[13]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in out.collect()) == sorted(
        (r["doc_id"] or 0, r["n"]) for r in byte_bpe.encode(kept, out="i").select("doc_id", F.size("i").alias("n")).collect())


def test_rare_entities_short_names_and_other_lines(spark):
    texts = [f"text {i} says nothing of anybody" for i in range(1500)] + [
        "Quillon\nwrites from q.v@x.com again", "of Li:\n\nli@y.com or so", "王芳\n+1 (234) 555-1234 says", "Quillonia left, li too"]
    texts += [f"{'Orsolya' if i < 700 else 'anybody'} says desk@z.com {i}" for i in range(800)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = pii.find(rows).select("text", pii.masked(F.col("text"), F.col("spans")).alias("clean")).collect()
    clean = {r["text"]: r["clean"] for r in found}
    assert clean[texts[1500]].startswith("<TERM>\n") and "<EMAIL>" in clean[texts[1500]]
    assert clean[texts[1501]] == "of <TERM>:\n\n<EMAIL> or so" and clean[texts[1502]].startswith("<TERM>\n<PHONE> says")
    assert clean[texts[1503]] == texts[1503] and clean[texts[0]] == texts[0]
    assert clean["Orsolya says desk@z.com 5"] == "<TERM> says <EMAIL> 5"  # frequent: less than MIN_BITS to tell
    assert clean["anybody says desk@z.com 750"] == "anybody says <EMAIL> 750"


def test_near_copies_go_by_id_and_text(spark):
    import corpus_pipeline

    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a + " more"), (2, b), (None, a + " other"), (None, c), (None, c + " more"), (2, b), (9, "single")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [tuple(r) for r in corpus_pipeline.without_near_copies(spark, table, "").collect()]
    assert len(kept) == 4 and {(1, a), (2, b), (9, "single")} < set(kept)
