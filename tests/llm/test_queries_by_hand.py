"""The ten earlier queries over a whole table, their columns counted by hand from the contract's words; and the learners by hand."""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexitrack.llm import common, language_id, pii, quality, queries, secret_scan
from test_llm import BASE, PII, SMALL, base_pii, base_secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


def result(spark, query):
    return {r["doc_id"]: r for r in query(spark, SF).collect()}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_op1(spark, rows):
    got = result(spark, queries.op1_language_id)
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == {i for i, _ in rows} and all(r["held_out"] == held_out(i) for i, r in got.items())
    judged = [i for i, t in rows if held_out(i) and lang[i] and any(c.isalpha() for c in t)]
    assert sum(got[i]["lang_pred"] == lang[i] for i in judged) >= 0.9 * len(judged)
    assert all((got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t)) and 0 <= got[i]["score"] <= 1 for i, t in rows)


def test_op2(spark, rows):
    got = result(spark, queries.op2_lm_score)
    assert {i: len(re.findall(r"[^ \t-\r]+", t)) for i, t in rows} == {i: r["n_words"] for i, r in got.items()}


def test_op3(spark, rows):
    got = result(spark, queries.op3_quality)
    assert set(got) == {i for i, _ in rows} and all(r["held_out"] == held_out(i) for i, r in got.items())
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


@pytest.mark.parametrize("query, kinds, found", [(queries.op4_secrets, BASE, base_secrets), (queries.op8_pii, PII, base_pii)])
def test_op4_and_op8(spark, rows, query, kinds, found):
    got = result(spark, query)
    for i, t in rows:
        base = found(t)
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in base) for k in kinds]
        assert got[i]["base_sha256"] == sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(got[i]["spans"].split(","))


def test_op5(spark, rows):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(SMALL))

    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    windows = defaultdict(set)
    for item, w in items.items():
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(item)
    lengths = {len(k) for k in windows}
    got = result(spark, queries.op5_decontaminate)
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if of := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= of
        want = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w))
        assert tuple(got[i][c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == want


def test_op6(spark, rows):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(common.tokenizer_path("word_bpe_49k.json"))
    got, start = result(spark, queries.op6_id_planes), 0
    for i, t in rows:
        ids = [*coder.encode(t, add_special_tokens=False).ids, 1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op7(spark, rows):
    got = result(spark, queries.op7_fingerprint)
    for (i, t), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        half = len(t) // 2
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(t), sha(t[: len(t) - half] + after[:half]))
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    prints = defaultdict(set)
    for i, t in rows:
        prints[t].add(got[i]["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_op9(spark, rows):
    import public_tokenizers
    import tiktoken

    from lexitrack.llm import byte_bpe

    ranks = byte_bpe.Vocabulary(common.tokenizer_path(byte_bpe.VOCABULARY)).ranks
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = result(spark, queries.op9_byte_bpe)
    for i, t in rows:
        ids = plain.encode_ordinary(t)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(t))


def test_op10(spark, rows):
    def shingles(t):
        w = re.findall(r"[^ \t-\r]+", t.translate(SMALL))
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for a, b in {(a, b) for ids in where.values() for a in ids for b in ids if a < b}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            a, b = sorted((top(a), top(b)))
            label[b] = a
    got = result(spark, queries.op10_jaccard_join)
    assert {i: (len(s), top(i)) for i, s in sets.items()} == {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()}


# Learners by hand

def grams(text):
    """Buckets of the grams of one to three characters from every position, blanks for what is no letter."""
    small = [ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32 for c in text] + [32, 32]
    out = []
    for k in range(len(text)):
        h = small[k] * 0x9E3779B1 % 2**32
        out.append(h >> 17)
        for n, factor in ((1, 0x85EBCA6B), (2, 0xC2B2AE35)):
            h = (h ^ small[k + n]) * factor % 2**32
            out.append(h >> 17)
    return out


def test_language_decoding_by_hand(spark):
    """Counts, bit classifiers, their trust and the loss-weighted decoding in plain loops."""
    common.importable(spark)
    rows = [("en", "the cat sat on the mat and then it ran"), ("en", "a dog and the cat"), ("de", "der Hund und die Katze"), ("de", "ich bin über dem Berg"),
            ("fr", "le chat est sur la table"), ("fr", "où est-ce que tu vas"), (None, "zzz")]
    asked = ["the dog ran", "der Berg und ich", "tu es sur le chat", "xyz", "und the la", "1 2 3"]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string"))
    names = sorted({x for x, _ in rows if x})
    code = language_id.codewords(3)
    counts = {x: np.zeros(language_id.BUCKETS) for x in names}
    for x, t in rows:
        if x:
            for g in grams(t):
                counts[x][g] += 1
    often = {x: (c + 0.5) / (c.sum() + 0.5 * language_id.BUCKETS) for x, c in counts.items()}

    def margins(t):
        out = []
        for bit in range(code.shape[1]):
            have, lack = ([often[x] for k, x in enumerate(names) if code[k, bit] == s] for s in (1, -1))
            logs = np.log(np.mean(have, 0)) - np.log(np.mean(lack, 0))
            out.append(sum(logs[g] for g in grams(t)) * min(len(t), language_id.FULL_EVIDENCE) / max(len(t), 1) / 3)
        return out

    trust = np.zeros(code.shape)
    for k, x in enumerate(names):
        own = [margins(t) for lang, t in rows if lang == x]
        trust[k] = [(sum(m[b] * code[k, b] > 0 for m in own) + 0.5) / (len(own) + 1) for b in range(code.shape[1])]
    trust /= trust.sum(1, keepdims=True)
    docs = spark.createDataFrame([(t,) for t in asked], "text string")
    for r in language_id.predict(docs, model, out="l").collect():
        m = margins(r["text"])
        losses = [sum(trust[k, b] * math.log1p(math.exp(-m[b] * code[k, b])) for b in range(len(m))) for k in range(3)]
        odds = [math.exp(-4 * x) for x in losses]
        best = max(range(3), key=lambda k: odds[k])
        if not any(c.isalpha() for c in r["text"]):
            assert tuple(r["l"]) == ("und", 0.0, False)
            continue
        assert r["l"]["lang"] == names[best] and r["l"]["score"] == pytest.approx(odds[best] / sum(odds), rel=1e-4)
        gap = sorted(x / sum(odds) for x in odds)
        assert r["l"]["ambiguous"] == (gap[-1] - gap[-2] < language_id.GAP)


def risk(model, p, u, prior):
    """The non-negative risk of logistic losses, with the fit's small penalty."""
    def loss(x, y):
        z = np.clip((x - model.mean) / model.scale, -6, 6) @ model.weights + model.bias
        return np.log1p(np.exp(-z if y else z)).mean()

    return prior * loss(p, 1) + max(0.0, loss(u, 0) - prior * loss(p, 0)) + 0.5e-4 * (model.weights**2).sum()


def test_fit_is_at_a_low_point_of_the_risk():
    random = np.random.default_rng(2)
    p, u = random.normal(0.7, 1, (300, 4)), np.concatenate([random.normal(0.7, 1, (120, 4)), random.normal(-0.7, 1, (280, 4))])
    model = quality.fit(p, u, 0.3)
    low = risk(model, p, u, 0.3)
    for _ in range(30):
        other = quality.Model(model.mean, model.scale, model.weights + random.normal(0, 0.3, 4), model.bias + random.normal(0, 0.3))
        assert risk(other, p, u, 0.3) > low - 1e-3


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_from_positives_and_unlabelled_rows(share):
    random = np.random.default_rng(5)
    p = random.normal(1, 0.8, (1500, 6))
    n = int(3000 * share)
    u = random.permutation(np.concatenate([random.normal(1, 0.8, (n, 6)), random.normal(-1, 0.8, (3000 - n, 6))]))
    assert quality.estimate_prior(p, u) == pytest.approx(share, abs=0.06)
    assert quality.estimate_prior(p[:0], u) == quality.NO_PRIOR == quality.estimate_prior(p, u[:1])


def test_trusted_positives_are_enough(spark):
    """Without a single label of 0: bad rows are told apart as they are with them."""
    common.importable(spark)
    good = [" ".join(f"word{(7 * i + k) % 90} and the rest" for k in range(30)) for i in range(150)]
    bad = ["$$ %% 11 " * (20 + i) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*good, *bad])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 150, 2)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["q"] for r in quality.score(docs, quality.train(docs, labels), out="q").collect()}
    assert sum(scores[i] >= 0.3 for i in range(150)) >= 145 and sum(scores[i] >= 0.3 for i in range(150, 250)) <= 5


# Long texts

def test_lexer_is_linear():
    for line in ('token = token + "Zk39Xq20LmPw81"\n', 'k = k + "ab"\n', 'x["a"] = y["b"]\n', 'password = "Zk39Xq20LmPw81" + \'aB3dE5fG7hJ9\'\n'):
        began = time.perf_counter()
        secret_scan.spans(line * (1_000_000 // len(line)))
        assert time.perf_counter() - began < 20, line
    found = secret_scan.spans('token = token + "Zk39Xq20LmPw81"\n' * 50)
    assert [(a, b) for _, a, b, _ in found] == [(17 + 33 * k, 31 + 33 * k) for k in range(50)]


@pytest.mark.parametrize("text, value", [
    ('x["password"] = "Zk39Xq20LmPw81"', "Zk39Xq20LmPw81"), ('os.environ["SECRET_KEY"] = "Zk39Xq20LmPw81"', "Zk39Xq20LmPw81"),
    ("cfg['api_key'] = 'Zk39Xq20LmPw81'", "Zk39Xq20LmPw81"), ('password = b"Zk39Xq20LmPw81"', "Zk39Xq20LmPw81"),
    ("token = rb'Zk39Xq20LmPw81'", "Zk39Xq20LmPw81"), ('secret: f"Zk39Xq20LmPw81"', "Zk39Xq20LmPw81"), ('x[key] = "Zk39Xq20LmPw81"', None),
])
def test_subscripts_and_prefixes(text, value):
    assert [text[a:b] for _, a, b, _ in secret_scan.spans(text)] == ([value] if value else [])


def test_judgement_of_a_growing_text():
    whole = secret_scan.Judged(secret_scan.Counter())
    for part in ("Zk3", "9Xq", "20Lm", "Pw81"):
        whole = whole.plus(part)
    assert whole.score() == secret_scan.randomness("Zk39Xq20LmPw81") == 1.0
    assert secret_scan.randomness("aaaaaaaaaaaa") == 0 == secret_scan.randomness("example1A2b3C4d") == secret_scan.randomness("aB3")
    assert secret_scan.randomness("short\nZk39Xq20LmPw81") == 1.0


def test_masking_is_linear(spark):
    mails = " ".join(f"a{i}@x{i % 7}.com" for i in range(70_000))  # over a megabyte
    rows = spark.createDataFrame([(1, mails), (2, None), (3, ""), (4, "é😀 x@y.zz," * 3000)], "doc_id long, text string")
    began = time.perf_counter()
    found = pii.base_spans(rows).select("doc_id", "text", pii.masked(F.col("text"), F.col("spans")).alias("clean"), F.size("spans").alias("n"))
    got = {r["doc_id"]: r for r in found.collect()}
    assert time.perf_counter() - began < 30
    assert got[1]["clean"] == " ".join(["<EMAIL>"] * 70_000) and got[2]["clean"] is None and got[3]["clean"] == ""
    assert got[4]["clean"] == "é😀 <EMAIL>," * 3000


def test_spans_that_overlap_become_one(spark):
    rows = spark.createDataFrame([("0123456789" * 900, [(10, 0, 20, "ip", ""), (12, 1, 15, "card", ""), (18, 1, 25, "card", ""), (4090, 0, 5000, "ip", "")])],
                                 f"text string, spans {pii._SPAN}")
    text, clean, blank = rows.select("text", pii.masked(F.col("text"), F.col("spans")), pii._blanked(F.col("text"), F.col("spans"))).first()
    assert clean == text[:10] + "<IP>" + text[25:4090] + "<IP>" + text[5000:]
    assert blank == text[:10] + " " * 15 + text[25:4090] + " " * 910 + text[5000:]


# Known words

def test_known_words_are_forgotten_in_time():
    asked = []

    def encode(words):
        asked.append(len(words))
        return [len(w) for w in words for _ in w], [len(w) for w in words]

    cache = common.SliceCache(encode, limit=50)
    for turn in range(40):
        words = [f"w{k % 20}" for k in range(40)] + [f"t{turn}-{k}" for k in range(10)] + ["", "é"]
        ids, offsets = cache.lookup(pa.array([w.encode() for w in words], pa.binary()))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [[len(w.encode())] * len(w.encode()) for w in words]
        assert len(cache.key) <= 50 + 32
    assert sum(asked[5:]) < 35 * 24  # words that come back stay known


def test_workers_keep_other_paths(spark, monkeypatch):
    monkeypatch.setitem(spark.sparkContext.environment, "PYTHONPATH", "/some/where")
    common.importable(spark)
    assert spark.sparkContext.environment["PYTHONPATH"].endswith("/some/where") and json.dumps(spark.sparkContext.environment)
