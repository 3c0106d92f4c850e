"""Language-model scores with stupid backoff, from n-gram counts of the whole corpus.

Documents are dealt into blocks by a hash. Every block counts its n-grams of one to ``ORDER`` words and asks for their
counts in the corpus: the distinct n-gram hashes go to partitions by hash, where the blocks' counts are summed into
the count table, and each block gets the sums of what it asked for. Its documents' n-grams are looked up there and the
logarithms summed for each document. A document is scored against the rest of the corpus: its own occurrences are
taken off every count (copies of it still count).

A word w after the words h scores c(h w) / c(h) if c(h w) > 0, else ``ALPHA`` times its score after one word less; a
single word scores c(w) / N, and an unseen one ``ALPHA`` / N. The first words of a text have shorter histories. Words
stand between ASCII white space, A-Z made small. Nulls count as empty texts: no words and a score of 0.

Per n-gram and block one hash travels, so a very frequent n-gram costs no more than one for each block. Rows that
repeat an id are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.llm.common import blocks, mix, word_hashes

ORDER = 3
ALPHA = 0.4
#: Bytes of text in a block, about.
BLOCK_TEXT = 16 << 20
_HASHED_BYTES = 1 << 20
_U = np.uint64


def _ngrams(texts: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at each word, by n; 0 where the text has too few words before. And offsets."""
    parts, sizes = [], []
    for block in blocks(texts, _HASHED_BYTES):
        hashes, bounds = word_hashes(block)
        parts.append(hashes)
        sizes.append(np.diff(bounds))
    words = np.concatenate(parts) if parts else np.zeros(0, _U)
    offsets = np.append(0, np.cumsum(np.concatenate(sizes) if sizes else []).astype(np.int64)).astype(np.int64)
    place = np.arange(len(words)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = [words]
    for n in range(2, order + 1):
        longer = np.zeros(len(words), _U)
        longer[1:] = mix(out[-1][:-1] * _U(0x9E3779B97F4A7C15) + words[1:])
        longer[place < n - 1] = 0
        out.append(longer)
    return out, offsets


def _ask(buckets: int, order: int):
    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        """A block's distinct n-grams with their counts in it, by bucket of the hash."""
        grams, _ = _ngrams(rows["text"].combine_chunks(), order)
        out = {"block": [], "n": [], "bucket": [], "grams": [], "counts": []}
        for n, g in enumerate(grams, 1):
            distinct, counts = np.unique(g, return_counts=True)
            which = ((distinct >> _U(32)) * _U(buckets)) >> _U(32)
            cuts = np.flatnonzero(np.append(True, which[1:] != which[:-1])) if len(which) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(which)).astype(int), strict=True):
                out["block"].append(key[0].as_py())
                out["n"].append(n)
                out["bucket"].append(int(which[a]))
                out["grams"].append(_low(distinct[a:b]))
                out["counts"].append(_squeezed(counts[a:b]))
        return pa.table(out, schema=_ASKED)

    return ask


_ASKED = pa.schema([
    ("block", pa.int64()), ("n", pa.int32()), ("bucket", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary()),
])
_ANSWERED = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("bucket", pa.int32()), ("sums", pa.binary())])


def _low(hashes: np.ndarray) -> bytes:
    """Six bytes of each hash: with the bucket enough to tell n-grams apart. By plane, as sorted ones squeeze well."""
    planes = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, 1:7].T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _from_low(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :6] = planes.T
    return wide.view(_U).reshape(-1)


def _squeezed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8")


def _answer(asked: pa.Table) -> pa.Table:
    """The count table of one bucket, as sums for each block that asked."""
    out = {"block": [], "n": [], "bucket": [], "sums": []}
    names = {c: asked[c].to_pylist() for c in asked.column_names}
    for n in set(names["n"]):
        rows = [i for i, m in enumerate(names["n"]) if m == n]
        lists = [_from_low(names["grams"][i]) for i in rows]
        distinct, at = np.unique(np.concatenate(lists), return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, at, np.concatenate([_counts(names["counts"][i]) for i in rows]))
        ends = np.cumsum([len(x) for x in lists])
        for i, a, b in zip(rows, np.append(0, ends[:-1]), ends, strict=True):
            out["block"].append(names["block"][i])
            out["n"].append(n)
            out["bucket"].append(names["bucket"][i])
            out["sums"].append(_squeezed(sums[at[a:b]]))
    return pa.table(out, schema=_ANSWERED)


def _scorer(order: int, alpha: float, total: int):
    def score(docs: pa.Table, sums: pa.Table) -> pa.Table:
        grams, offsets = _ngrams(docs["text"].combine_chunks(), order)
        sizes = np.diff(offsets)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        answers = sorted(zip(*(sums[c].to_pylist() for c in ("n", "bucket", "sums")), strict=True), key=lambda x: x[:2])
        rest = []  # of the n-gram that ends at each word: occurrences outside of the document
        for n, g in enumerate(grams, 1):
            _, at = np.unique(g, return_inverse=True)
            found = [_counts(s) for m, _, s in answers if m == n]
            everywhere = np.concatenate(found)[at] if found else np.zeros(0, np.int64)
            _, same, own = np.unique(owner * (len(g) + 1) + at, return_inverse=True, return_counts=True)
            counts = everywhere - own[same]
            counts[g == 0] = 0
            rest.append(counts)
        words = np.maximum(total - sizes[owner], 1)
        out = np.log10(np.where(rest[0] > 0, rest[0], alpha) / words)
        seen = np.ones(len(out), np.int64) * (rest[0] > 0)
        place = np.arange(len(out)) - offsets[:-1][owner]
        for n in range(2, order + 1):
            history = np.append(0, rest[n - 2][:-1])
            hit = rest[n - 1] > 0
            longer = np.log10(np.maximum(rest[n - 1], 1) / np.maximum(history, 1))
            out = np.where(hit, longer, out + np.where(place >= n - 1, np.log10(alpha), 0.0))
            seen[hit] = n
        scores = np.bincount(owner, out, len(sizes))
        lengths = np.bincount(owner, seen, len(sizes))
        some = np.maximum(sizes, 1)
        return pa.table({
            "doc_id": docs["doc_id"].cast(pa.int64()), "n_words": pa.array(sizes, pa.int64()), "score": pa.array(scores, pa.float64()),
            "mean_score": pa.array(scores / some, pa.float64()), "mean_order": pa.array(lengths / some, pa.float64()),
        })

    return score


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, score (sum of log10), mean_score, and mean_order (length of the n-grams found)."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.coalesce(
        F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))), F.lit(0))).first()
    n_blocks = max(1, -(-size[0] // BLOCK_TEXT))
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_blocks)
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("long"))
    asked = dealt.groupBy("block").applyInArrow(
        _ask(buckets, order), "block long, n int, bucket int, grams binary, counts binary"
    )
    answered = asked.groupBy("bucket").applyInArrow(_answer, "block long, n int, bucket int, sums binary")
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        _scorer(order, alpha, size[1]), "doc_id long, n_words long, score double, mean_score double, mean_order double"
    )
