"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary n-gram classifier weighs the hashed one, two and three
character grams of a text: the log ratio of their mean frequencies in the languages that have the bit and in those
that have not. The frequencies come from all rows to learn from, counted by Spark. Decoding is loss-weighted: the
logistic losses of a text's margins against a codeword are summed, each bit weighted by how often its classifier is
right for that language (on a bounded sample of those rows), and the nearest codeword wins. A text whose two nearest
codewords are almost equally near is flagged as ambiguous.

``und`` with score 0 is the answer for a null text, for one without a letter, and where nothing could be learned.
Rows without a language are not learned from. With one language, it is the answer for every text with a letter.
Repeated rows count as often as they occur. Equal texts get equal answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.llm.common import blocks, segment_sums, tidy

UNKNOWN = "und"
BUCKETS = 1 << 15
#: Expected number of rows, over all languages, on which the bits' classifiers are judged.
JUDGED_ROWS = 4000
#: Grams from which on more text adds no confidence.
FULL_EVIDENCE = 60
#: Scores of the two nearest languages that differ by less are ambiguous.
GAP = 0.2
_TEXT_BYTES = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Small letters of code points; 32 for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            small = chr(c).lower()
            out[c] = ord(small) if len(small) == 1 else c
    return out


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of texts, two blanks after each, and their first and last positions."""
    strings = texts.to_pylist()
    sizes = np.array([len(s) for s in strings], np.int64)
    points = np.frombuffer(("  ".join(strings) + "  ").encode("utf-32-le", "replace"), np.uint32)
    starts = np.append(0, np.cumsum(sizes + 2))[:-1]
    return _letters()[points], starts, starts + sizes


def _grams(letters: np.ndarray) -> list[np.ndarray]:
    """Buckets of the grams of one, two and three characters that begin at each position but the last two."""
    one = letters[:-2] * np.uint32(0x9E3779B1)
    two = (one ^ letters[1:-1]) * np.uint32(0x85EBCA6B)
    three = (two ^ letters[2:]) * np.uint32(0xC2B2AE35)
    return [(g >> np.uint32(17)).astype(np.int32) for g in (one, two, three)]


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: all splits of up to six, else the best of random dense codes."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= 6:
        splits = [s for k in range(1, languages) for s in combinations(range(1, languages), k)]
        code = np.ones((languages, len(splits)), np.int8)
        for j, s in enumerate(splits):
            code[list(s), j] = -1
        return code
    random = np.random.default_rng(0)
    bits = int(10 * np.ceil(np.log2(languages)))
    best, most = None, -1
    for _ in range(100):
        code = random.choice(np.array([-1, 1], np.int8), (languages, bits))
        apart = (bits - code.astype(int) @ code.T) // 2 + bits * np.eye(languages, dtype=int)
        if apart.min() > most and (np.abs(code.sum(0)) < languages).all():
            best, most = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x buckets
    trust: np.ndarray  # languages x bits; rows sum to 1

    def margins(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The bits' margins of every text of a block, and whether it has a letter."""
        letters, starts, ends = _points(texts)
        bounds = np.stack([starts, ends], 1).reshape(-1)
        bounds = np.append(bounds, ends[-1:])
        counts = ends - starts
        has = segment_sums((letters[:-2] != 32).astype(np.float32), bounds)[::2] > 0
        grams = _grams(letters)
        out = np.empty((len(counts), len(self.weights)))
        for j, w in enumerate(self.weights):
            per = w[grams[0]]
            per += w[grams[1]]
            per += w[grams[2]]
            out[:, j] = segment_sums(per, bounds)[::2]
        evidence = np.minimum(counts, FULL_EVIDENCE) / np.maximum(counts, 1) / 3
        return out * evidence[:, None], has

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of every text of a block."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        margins, has = self.margins(texts)
        losses = np.logaddexp(0, -margins[:, None, :] * self.code)
        nearness = -(losses * self.trust).sum(2) * 4
        odds = np.exp(nearness - nearness.max(1, keepdims=True))
        odds /= odds.sum(1, keepdims=True)
        best = odds.argmax(1)
        ranked = np.sort(odds, axis=1)
        gap = ranked[:, -1] - ranked[:, -2] if len(self.languages) > 1 else np.ones(len(texts))
        names = [self.languages[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
        return names, np.where(has, ranked[:, -1], 0.0), has & (gap < GAP)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, text): language, bucket and count, once for each task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        at = 0
        for block in blocks(batch.column(1), _TEXT_BYTES):
            langs = batch.column(0).slice(at, len(block)).dictionary_encode()
            letters, starts, ends = _points(block)
            which = np.repeat(
                np.stack([langs.indices.to_numpy(zero_copy_only=False), np.full(len(block), -1)], 1).reshape(-1),
                np.stack([ends - starts, np.full(len(block), 2)], 1).reshape(-1),
            )[: len(letters) - 2]
            grams = _grams(letters)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = which == k
                total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for g in grams:
                    total += np.bincount(g[own], minlength=BUCKETS)
            at += len(block)
    for lang, total in counts.items():
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(total[full], pa.int64())],
            names=["lang", "bucket", "n"],
        )
    tidy()


def train(rows: DataFrame, judged_rows: int = JUDGED_ROWS) -> Model:
    """A model from all rows (lang, text) with a language. The counts are at most languages x buckets numbers."""
    rows = rows.select("lang", "text").filter(F.col("lang").isNotNull())
    sums = rows.mapInArrow(_count_grams, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return Model([], np.ones((0, 1), np.int8), np.zeros((1, BUCKETS), np.float32), np.ones((0, 1)))
    at = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    np.add.at(counts, (np.array([at[x] for x in found["lang"].to_pylist()]), found["bucket"].to_numpy()), found["n"].to_numpy())
    often = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)
    code = codewords(len(languages))
    with np.errstate(invalid="ignore", divide="ignore"):
        weights = np.array([
            np.log(often[c > 0].mean(0)) - (np.log(often[c < 0].mean(0)) if (c < 0).any() else 0) for c in code.T
        ])
    if len(languages) == 1:
        weights = np.ones((1, BUCKETS))
    model = Model(languages, code, weights.astype(np.float32), np.full(code.shape, 1 / code.shape[1]))
    right = _bits_right(rows, model, judged_rows)
    model.trust = right / right.sum(1, keepdims=True)
    return model


def _bits_right(rows: DataFrame, model: Model, judged_rows: int) -> np.ndarray:
    """Languages x bits: the share of sampled rows of a language for which the bit's classifier is right."""
    share = min(1.0, judged_rows / max(1, rows.count()))
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(model.languages), model.code.shape[1] + 1))
        at = {lang: i for i, lang in enumerate(model.languages)}
        for batch in batches:
            done = 0
            for block in blocks(batch.column(1), _TEXT_BYTES):
                which = np.array([at[x] for x in batch.column(0).slice(done, len(block)).to_pylist()])
                margins, has = model.margins(block)
                np.add.at(total, which[has], np.append(np.ones((has.sum(), 1)), margins[has] * model.code[which[has]] > 0, 1))
                done += len(block)
        names = ["language", "rows", "bits"]
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(total)), pa.int32()), pa.array(total[:, 0]), pa.array(total[:, 1:].tolist(), pa.list_(pa.float64())),
        ], names=names)

    bits = model.code.shape[1]
    judged = sample.mapInArrow(judge, "language int, rows double, bits array<double>").groupBy("language").agg(
        F.sum("rows").alias("rows"), *[F.sum(F.col("bits")[j]).alias(f"b{j}") for j in range(bits)]
    )
    out = np.full(model.code.shape, 0.5)
    for r in judged.collect():  # a row for each language
        out[r["language"]] = [(r[f"b{j}"] + 0.5) / (r["rows"] + 1) for j in range(bits)]
    return out


_ANSWER = "lang string, score double, ambiguous boolean"


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """The rows with ``out``: language, score and ambiguity of the whole text. A column of that name is replaced."""
    def answers(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            names, scores, flags = [], [], []
            for block in blocks(batch, _TEXT_BYTES):
                n, s, f = model.predict(block)
                names, scores, flags = names + n, scores + s.tolist(), flags + f.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())],
                ["lang", "score", "ambiguous"],
            )
        tidy()

    return docs.withColumn(out, F.arrow_udf(answers, _ANSWER).asNondeterministic()(F.col(text)))
