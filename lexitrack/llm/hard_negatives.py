"""Hard negatives by exact search over stored blocks of vectors, read only where their zone maps allow a hit.

Vectors are ordered by label and by their place on a Hilbert curve, and packed into Parquet blocks of consecutive rows
with the least and the largest value of every dimension beside them. For an anchor, interval arithmetic over such a zone
map gives the least and the largest inner product that any row of the block can have. A block is read for an anchor only
if that interval meets what the anchor still looks for: for positives, products that can beat the fifth best that some
block is sure to hold; for negatives, the windows of the anchor's positives. What is read is compared exactly.

Rows that are equal in id, label and vector count once; rows that share only an id are rows of their own. A null id takes
part and stands behind all ids. Rows with a null label, a null vector or a null or non-finite component take no part. A
shorter vector counts as filled with zeros. Empty tables give no rows. Products beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexitrack.operators.numbering import numbered, placed
from lexitrack.session import shared_dir

BLOCK = 1024  # rows of a block of candidates, and of a slice of anchors
PAGE = 64  # blocks whose zone maps are looked at together, and that one task compares with a slice
BITS = 2  # per dimension, on the curve
NO_ID = (1 << 63) - 1  # stands for a null id inside blocks
_EXACT = float(1 << 53)

_PACKED = "ids binary, labels binary, matrix binary, n int, label_lo long, label_hi long, low array<long>, high array<long>"


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component, as double; null where a component is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


# The curve

def hilbert_keys(levels: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on a Hilbert curve, as big-endian byte strings, of points with ``bits`` bits in every column.

    The transform of axes (Skilling 2004) on whole columns at once.
    """
    x = [levels[:, i].astype(np.uint8) for i in range(levels.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = np.uint8(q - 1)
        for i in range(len(x)):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p).astype(np.uint8)
            x[0] = x[0] ^ np.where(set_, p, 0).astype(np.uint8) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(levels), np.uint8)
    q = top
    while q > 1:
        turn ^= np.where(x[-1] & q, np.uint8(q - 1), 0).astype(np.uint8)
        q >>= 1
    columns = [((c ^ turn) >> b) & 1 for b in range(bits - 1, -1, -1) for c in x]
    return np.packbits(np.stack(columns, axis=1), axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, shorter lists filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _spread(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every dimension, for the steps of the curve. One row per dimension is collected."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(width), np.zeros(width)
        for b in batches:
            m = _matrix(b.column(0), width).astype(np.float64)
            n, s, q = n + len(m), s + m.sum(0), q + (m * m).sum(0)
        dims = np.arange(width, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(np.full(width, float(n))), pa.array(s), pa.array(q)], ["d", "n", "s", "q"])

    found = rows.select("vector").mapInArrow(sums, "d int, n double, s double, q double")
    total = sorted(found.groupBy("d").agg(F.sum("n"), F.sum("s"), F.sum("q")).collect())
    n, s, q = (np.array([r[k] for r in total]) for k in (1, 2, 3))
    n = np.maximum(n, 1)
    mean = s / n
    return mean, np.sqrt(np.maximum(q / n - mean * mean, 0))


def _with_keys(rows: DataFrame, width: int) -> DataFrame:
    mean, deviation = _spread(rows, width)
    steps = mean + np.array([[-0.6745], [0.0], [0.6745]]) * deviation  # quarters of a normal spread

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("vector"), width)
            levels = sum((m > s).astype(np.uint8) for s in steps)
            own = hilbert_keys(levels) if width else np.zeros((len(m), 1), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("vector"), pa.array([r.tobytes() for r in own], pa.binary())],
                ["id", "label", "vector", "key"],
            )

    return rows.mapInArrow(keys, "id long, label long, vector array<long>, key binary")


# Blocks

def _pack(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Runs of ``size`` rows of every partition as one row each, with their zone map."""

    def packed(ids: np.ndarray, labels: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")  # of equal products the smaller id comes first
        ids, labels, m = ids[order], labels[order], np.ascontiguousarray(m[order])
        return pa.RecordBatch.from_arrays([
            pa.array([ids.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()),
            pa.array([len(ids)], pa.int32()), pa.array([int(labels.min())]), pa.array([int(labels.max())]),
            pa.array([m.min(0).tolist()], pa.list_(pa.int64())), pa.array([m.max(0).tolist()], pa.list_(pa.int64())),
        ], ["ids", "labels", "matrix", "n", "label_lo", "label_hi", "low", "high"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for b in batches:
            ids = b.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            waiting.append((ids, b.column("label").to_numpy(zero_copy_only=False), _matrix(b.column("vector"), width)))
            if sum(len(w[0]) for w in waiting) >= size:
                whole = [np.concatenate(part) for part in zip(*waiting, strict=True)]
                full = len(whole[0]) // size * size
                for at in range(0, full, size):
                    yield packed(*[w[at : at + size] for w in whole])
                waiting = [tuple(w[full:] for w in whole)]
        if waiting and sum(len(w[0]) for w in waiting):
            yield packed(*[np.concatenate(part) for part in zip(*waiting, strict=True)])

    ordered = rows.repartitionByRange("label", "key", "id").sortWithinPartitions("label", "key", "id")
    return ordered.mapInArrow(pack, _PACKED)


def _unpacked(row: dict, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels, matrix of a block."""
    n = row["n"]
    return (
        np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64),
        np.frombuffer(row["matrix"], np.int64).reshape(n, width),
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact: by doubles where all sums stay below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if exact.size and max(abs(exact.max()), abs(exact.min())) >= 1 << 63:
        raise OverflowError("an inner product does not fit 64 bits")
    return exact.astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest inner product of each row of ``a`` with any vector between a block's low and high.

    A little is added for rounding, so that no block is ruled out wrongly.
    """
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    slack = 1e-12 * (np.abs(up) @ np.maximum(np.abs(low), np.abs(high)).T + np.abs(down) @ np.maximum(np.abs(low), np.abs(high)).T)
    return least - slack, most + slack


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's first k allowed scores, higher first, ties by column."""
    floor = np.iinfo(np.int64).min
    masked = np.where(allowed, scores, floor)
    if masked.shape[1] > k:
        kth = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        rows, cols = np.nonzero(allowed & (masked >= kth[:, None]))
    else:
        rows, cols = np.nonzero(allowed)
    order = np.lexsort((cols, -scores[rows, cols].astype(np.float64), -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], cols[place < k]


# The search

class Index:
    """Stored blocks of all vectors, numbered densely, and their zone maps by pages."""

    def __init__(self, vectors: DataFrame, folder: str, block: int = BLOCK):
        """``vectors``: id, label, vector (array<long>, without nulls)."""
        self.spark, self.folder, self.block = vectors.sparkSession, folder, block
        vectors.dropDuplicates(["id", "label", "vector"]).write.parquet(f"{folder}/vectors")
        stored = self.spark.read.parquet(f"{folder}/vectors")
        self.width = stored.agg(F.max(F.size("vector"))).first()[0] or 0
        _with_keys(stored, self.width).write.parquet(f"{folder}/keyed")
        self.keyed = self.spark.read.parquet(f"{folder}/keyed")
        self.blocks = self._stored(self.keyed, "blocks", "block").withColumn("page", F.floor(F.col("block") / PAGE))
        self.pages = self.blocks.agg(F.coalesce(F.max("page") + 1, F.lit(0))).first()[0]

    def _stored(self, rows: DataFrame, name: str, number: str) -> DataFrame:
        placed(_pack(rows, self.width, self.block)).write.parquet(f"{self.folder}/{name}")
        return numbered(self.spark.read.parquet(f"{self.folder}/{name}"), number)

    def anchors(self, chosen: Column) -> DataFrame:
        """Slices of the chosen rows: along the same curve, so anchors of a slice need much the same blocks."""
        return self._stored(self.keyed.filter(chosen), "anchors", "slice").drop("low", "high", "label_lo", "label_hi")

    def zones(self) -> DataFrame:
        """The zone maps of a page's blocks as one row; no matrix is read."""
        zone = F.struct("block", "n", "label_lo", "label_hi", "low", "high")
        return self.blocks.groupBy("page").agg(F.array_sort(F.collect_list(zone)).alias("zones"))

    def choose(self, slices: DataFrame, look, schema: str) -> DataFrame:
        """``look(slice row, zones)`` of every slice and page. The slices are the query set, in blocks."""
        if not self.pages:
            return self.spark.createDataFrame([], schema)
        paired = slices.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.pages - 1)))).join(self.zones(), "page")

        target = _arrow(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_pylist([r for row in b.to_pylist() for r in look(row)], schema=target)

        return paired.mapInArrow(run, schema)

    def search(self, slices: DataFrame, wanted: DataFrame, compare, schema: str) -> DataFrame:
        """``compare(slice row, block row, anchors)`` of every wanted (slice, page, block, anchors), by slice and page.

        A group is one slice and at most a page of blocks.
        """
        blocks = wanted.join(self.blocks.select("block", "n", "ids", "labels", "matrix"), "block")
        own = wanted.select("slice", "page").distinct().join(slices, "slice").withColumnsRenamed({"slice": "of", "page": "at"})

        target = _arrow(schema)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = [r for s in left.to_pylist() for b in right.to_pylist() for r in compare(s, b)]
            return pa.Table.from_pylist(out, schema=target)

        return own.groupBy("of", "at").cogroup(blocks.groupBy("slice", "page")).applyInArrow(run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (f.split() for f in schema.split(", "))])


def _first(rows: DataFrame, key: list[str], k: int, name: str, score: str, id_: str) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1. A key has at most ``k`` rows a page before."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), id_))
    return rows.withColumn(name, place).filter(F.col(name) <= k)


_WANTED = "slice long, page long, block long, anchors binary"


def mine(
    vectors: DataFrame, anchors: Column, folder: str | None = None, positives: int = 5, negatives: int = 5,
    least_percent: int = 80, block: int = BLOCK, read: list | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` holds for.

    ``vectors``: id, label, vector of integers. An anchor's positives are its first other rows of its label; each
    positive's negatives the first rows of other labels with least_percent / 100 * positive <= negative <= positive.
    ``read``, if given, gets the wanted pairs of both searches, for tests.
    """
    spark = vectors.sparkSession
    folder = folder or shared_dir(spark, "hard-negatives")
    index = Index(vectors.filter("label IS NOT NULL AND vector IS NOT NULL").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector"), folder, block)
    width = index.width
    slices = index.anchors(anchors)

    def zone_bounds(row: dict) -> tuple:
        ids, labels, a = _unpacked(row, width)
        zones = row["zones"]
        low, high = (np.array([z[k] for z in zones], np.int64).reshape(len(zones), width) for k in ("low", "high"))
        least, most = bounds(a, low, high)
        lo, hi = (np.array([z[k] for z in zones]) for k in ("label_lo", "label_hi"))
        own = (lo <= labels[:, None]) & (labels[:, None] <= hi)
        only = (lo == labels[:, None]) & (hi == labels[:, None])
        return labels, zones, least, most, own, only

    def want(row: dict, zones: list, needed: np.ndarray) -> Iterator[dict]:
        for k in np.flatnonzero(needed.any(0)):
            yield {"slice": row["slice"], "page": row["page"], "block": zones[k]["block"], "anchors": needed[:, k].tobytes()}

    # What some block of the anchor's label is sure to hold: enough rows, none below its least product.
    def sure(row: dict) -> Iterator[dict]:
        _, zones, least, _, _, only = zone_bounds(row)
        enough = only & (np.array([z["n"] for z in zones]) > positives)
        best = np.where(enough, least, -np.inf).max(1)
        yield from ({"slice": row["slice"], "i": i, "sure": float(v)} for i, v in enumerate(best))

    floors = index.choose(slices, sure, "slice long, i int, sure double").groupBy("slice", "i").agg(F.max("sure").alias("sure"))
    floors = floors.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("i", "sure"))).alias("floors"))

    def can_hold(row: dict) -> Iterator[dict]:
        _, zones, _, most, own, _ = zone_bounds(row)
        floor = np.array([f["sure"] for f in row["floors"]])
        yield from want(row, zones, own & (most >= floor[:, None]))

    index.choose(slices.join(floors, "slice"), can_hold, _WANTED).write.parquet(f"{folder}/for-positives")
    near = spark.read.parquet(f"{folder}/for-positives")

    def compared(s: dict, b: dict) -> tuple:
        """The anchors of a slice that need a block, and their products with it."""
        ids, labels, a = _unpacked(s, width)
        other, other_labels, m = _unpacked(b, width)
        at = np.flatnonzero(np.frombuffer(b["anchors"], bool))
        return at, ids[at], labels[at], other, other_labels, products(a[at], m), a[at], m

    def same_label(s: dict, b: dict) -> Iterator[dict]:
        at, ids, labels, other, other_labels, scores, a, m = compared(s, b)
        allowed = labels[:, None] == other_labels
        for r, c in zip(*np.nonzero(allowed & (ids[:, None] == other)), strict=True):
            allowed[r, c] = not np.array_equal(a[r], m[c])  # the anchor itself
        for r, c in zip(*_best(scores, allowed, positives), strict=True):
            yield {"slice": s["of"], "i": int(at[r]), "anchor_id": int(ids[r]), "positive_id": int(other[c]), "positive_score": int(scores[r, c])}

    found = index.search(slices, near, same_label, "slice long, i int, anchor_id long, positive_id long, positive_score long")
    _first(found, ["slice", "i"], positives, "j", "positive_score", "positive_id").write.parquet(f"{folder}/positives")
    chosen = spark.read.parquet(f"{folder}/positives")
    windows = chosen.groupBy("slice").agg(F.collect_list(F.struct("i", "j", "positive_score")).alias("windows"))

    def meets(row: dict) -> Iterator[dict]:
        _, zones, least, most, _, only = zone_bounds(row)
        needed = np.zeros(least.shape, bool)
        for w in row["windows"]:
            p = float(w["positive_score"])
            needed[w["i"]] |= (most[w["i"]] >= p * least_percent / 100 - 1) & (least[w["i"]] <= p)
        yield from want(row, zones, needed & ~only)

    index.choose(slices.join(windows, "slice"), meets, _WANTED).write.parquet(f"{folder}/for-negatives")
    far = spark.read.parquet(f"{folder}/for-negatives")
    if read is not None:
        read += [near, far]

    def in_windows(s: dict, b: dict) -> Iterator[dict]:
        at, ids, labels, other, other_labels, scores, _, _ = compared(s, b)
        differs = labels[:, None] != other_labels
        place = {int(i): r for r, i in enumerate(at)}
        own = [w for w in s["windows"] if w["i"] in place]
        for j in sorted({w["j"] for w in own}):
            of_j = [w for w in own if w["j"] == j]
            r = np.array([place[w["i"]] for w in of_j])
            positive = [w["positive_score"] for w in of_j]  # Python integers: a hundred of them need not fit 64 bits
            lo = np.array([-(-least_percent * p // 100) for p in positive])[:, None]
            hi = np.array(positive)[:, None]
            allowed = differs[r] & (scores[r] >= lo) & (scores[r] <= hi)
            for q, c in zip(*_best(scores[r], allowed, negatives), strict=True):
                yield {"slice": s["of"], "i": int(of_j[q]["i"]), "j": int(j), "negative_id": int(other[c]), "negative_score": int(scores[r[q], c])}

    hits = index.search(
        slices.join(windows, "slice"), far, in_windows, "slice long, i int, j int, negative_id long, negative_score long"
    )
    ranked = _first(hits, ["slice", "i", "j"], negatives, "rank", "negative_score", "negative_id")

    def id_(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)

    return ranked.join(chosen, ["slice", "i", "j"]).select(
        id_("anchor_id"), id_("positive_id"), F.col("rank").cast("int").alias("rank"), id_("negative_id"), "positive_score", "negative_score"
    )
