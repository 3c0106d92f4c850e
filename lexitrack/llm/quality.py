"""Quality scores by positive-unlabelled learning.

The classifier is logistic on standardised measures of a text (shares of character classes, repeated words and lines,
word lengths) and hashed two-character grams. It minimises the non-negative unbiased risk: with class prior p,
p * loss(positives, 1) + max(0, loss(unlabelled, 0) - p * loss(positives, 0)); while the second part is negative, its
gradient is turned round, as in the published method. Positives are rows of a trusted label; unlabelled rows are web
text, whatever label they have; labels of 0 are used for nothing. Both are samples of at most ``POSITIVE_ROWS`` and
``UNLABELLED_ROWS`` rows by a hash of the id and the text, so copies and nulls are drawn row by row.

The class prior is estimated from the two samples: half of each fits a classifier of positives against unlabelled rows,
the other half is scored. Above any threshold the unlabelled rows hold at least the prior's share of what the positives
hold, and at the top little else, so the prior is the quotient of the two shares where its upper confidence bound is
lowest. It may also be given.

Nulls count as empty texts; every text gets a score, an empty one too. Without positives every score is the prior, and
that is ``NO_PRIOR``. Repeated labels of a document count once, the lowest of them. Equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.llm.common import blocks, segment_sums

#: Rows in the samples from which the classifier is fitted, at most.
POSITIVE_ROWS = 3000
UNLABELLED_ROWS = 6000
#: The prior where there is nothing to estimate it from.
NO_PRIOR = 0.5
GRAMS = 256
_CLASSES = 6  # small, capital, digit, blank, line end, other
_MEASURES = _CLASSES + 8
_TEXT_BYTES = 2 << 20


@cache
def _character_classes() -> np.ndarray:
    out = np.full(0x110000, 5, np.uint8)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            out[c] = 1 if s.isupper() else 0
        elif s.isdigit():
            out[c] = 2
        elif s.isspace():
            out[c] = 4 if s == "\n" else 3
    return out


def _of_words(text: str) -> list[float]:
    words, lines = text.split(), text.split("\n")
    n = len(words)
    distinct = len(set(words))
    return [
        np.log1p(n), distinct / max(n, 1), distinct / max(n, 1) ** 0.8, sum(map(eq, words, words[1:])) / max(n, 1),
        sum(map(eq, words, words[2:])) / max(n, 1), len(set(lines)) / len(lines), sum(map(len, words)) / max(n, 1) / 10,
        float(n > 0),
    ]


def features(texts: pa.Array) -> np.ndarray:
    """A row for each text of a block: its measures, then frequencies of grams."""
    strings = texts.to_pylist()
    sizes = np.array([len(s) for s in strings], np.int64)
    offsets = np.append(0, np.cumsum(sizes + 1))
    points = np.frombuffer(("\n".join(strings) + "\n").encode("utf-32-le", "replace"), np.uint32)
    kinds = _character_classes()[points]
    bounds = np.append(np.stack([offsets[:-1], offsets[:-1] + sizes], 1).reshape(-1), offsets[-1])
    shares = np.stack([segment_sums((kinds == k).astype(np.float32), bounds)[::2] for k in range(_CLASSES)], 1)
    grams = ((points[:-1] * np.uint32(0x9E3779B1) ^ points[1:]) * np.uint32(0x85EBCA6B)) >> np.uint32(24)
    rows = np.repeat(np.arange(len(strings)), np.maximum(sizes - 1, 0))
    inside = np.ones(len(points), bool)  # grams that begin and end in one text
    inside[offsets[1:] - 1] = False
    inside[(offsets[1:] - 2)[sizes > 0]] = False
    counts = np.bincount(rows * GRAMS + grams[inside[:-1]], minlength=len(strings) * GRAMS).reshape(-1, GRAMS)
    some = np.maximum(sizes, 1)[:, None]
    words = np.array([_of_words(s) for s in strings]).reshape(len(strings), _MEASURES - _CLASSES)
    return np.hstack([shares / some, words, np.sqrt(counts / some)]).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 1500, rate: float = 0.02) -> Model:
    """Minimise the non-negative risk by full-batch Adam; deterministic."""
    width = positives.shape[1]
    if not len(positives) or not len(unlabelled):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(prior / (1 - prior))))
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positives, unlabelled))
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) for x in (p, u))
        as_one = np.append(p.T @ (sp - 1), (sp - 1).sum()) / len(p)  # gradient of the positives' loss as 1
        as_zero = np.append(p.T @ sp, sp.sum()) / len(p)
        rest = np.append(u.T @ su, su.sum()) / len(u) - prior * as_zero
        risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        gradient = prior * as_one + rest if risk >= 0 else -rest
        gradient[:-1] += 1e-4 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(mean, scale, w, float(b))


def _standardised(unlabelled: np.ndarray, *samples: np.ndarray) -> list[np.ndarray]:
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    return [np.clip((x - mean) / scale, -6, 6) for x in samples]


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, rounds: int = 400, rate: float = 0.05) -> float:
    """The share of positives among unlabelled rows: the quotient of the shares above the threshold, of those that leave a
    tenth of the positives at least, where chance can have raised it least."""
    if len(positives) < 2 or len(unlabelled) < 2:
        return NO_PRIOR
    # Samples come sorted by features, so every second row is as good as any half.
    p, p_held, u, u_held = _standardised(unlabelled, positives[::2], positives[1::2], unlabelled[::2], unlabelled[1::2])
    w = np.zeros(p.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) for x in (p, u))
        gradient = np.append(p.T @ (sp - 1), (sp - 1).sum()) / len(p) + np.append(u.T @ su, su.sum()) / len(u)
        gradient[:-1] += 1e-2 * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    of_p, of_u = (np.sort(x @ w[:-1]) for x in (p_held, u_held))
    cuts = np.quantile(of_p, np.linspace(0, 0.9, 91), method="lower")
    shares = [1 - np.searchsorted(x, cuts) / len(x) for x in (of_u, of_p)]
    chance = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(of_u)) + 1 / np.sqrt(len(of_p)))
    best = np.argmin((shares[0] + chance) / shares[1])
    return float(np.clip(shares[0][best] / shares[1][best], 0.01, 0.99))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for block in blocks(batch.column(0), _TEXT_BYTES):
            x = pa.array([r.tobytes() for r in features(block)], pa.binary())
            yield pa.RecordBatch.from_arrays([x, batch.column(1).slice(at, len(block))], names=["x", "n"])
            at += len(block)


def _sampled(rows: DataFrame, bound: int) -> np.ndarray:
    """Features of ``bound`` rows, or of all if there are fewer: those of the smallest hashes of id, text and, among
    rows equal in both, number. So nulls and copies are drawn one by one."""
    key = ["doc_id", "text_hash", "text_crc"]
    value = F.coalesce("text", F.lit(""))
    keyed = rows.select("doc_id", F.xxhash64(value).alias("text_hash"), F.crc32(value).alias("text_crc"), value.alias("text"))
    each = keyed.groupBy(*key).count().select(*key, F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("i"))
    drawn = each.withColumn("draw", F.xxhash64(*key, "i")).orderBy("draw", *key, "i").limit(bound)
    times = F.broadcast(drawn.groupBy(*[F.col(c).alias(f"own_{c}") for c in key]).agg(F.count("*").alias("n")))
    chosen = keyed.join(times, [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in key])
    once = chosen.groupBy(*key, "n").agg(F.first("text").alias("text"))
    found = once.select("text", "n").mapInArrow(_feature_rows, "x binary, n long").toArrow().to_pylist()
    found = sorted(x for r in found for x in [r["x"]] * r["n"])
    return np.frombuffer(b"".join(found), np.float32).reshape(len(found), _MEASURES + GRAMS).astype(np.float64)


def train(
    rows: DataFrame, labels: DataFrame, prior: float | None = None,
    positive_rows: int = POSITIVE_ROWS, unlabelled_rows: int = UNLABELLED_ROWS,
) -> Model:
    """A model from rows (doc_id, text) and labels (doc_id, quality), both without held-out documents."""
    rows = rows.select("doc_id", "text")
    labels = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    positives = rows.join(labels.filter(F.col("quality") == 1), "doc_id", "left_semi")
    p, u = _sampled(positives, positive_rows), _sampled(rows, unlabelled_rows)
    return fit(p, u, min(max(estimate_prior(p, u) if prior is None else prior, 0.01), 0.99))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "quality_score") -> DataFrame:
    """The rows with ``out``: 0 to 1 for the whole text, higher the better. A column of that name is replaced."""
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [model.scores(features(block)) for block in blocks(batch, _TEXT_BYTES)]
            yield pa.array(np.concatenate(found) if found else [], pa.float64())

    return docs.withColumn(out, F.arrow_udf(scores, "double").asNondeterministic()(F.col(text)))
