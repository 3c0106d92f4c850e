"""Records of text files whose quoted parts may hold line breaks, read by many tasks a file.

Spark deals a file out in splits of whole lines. Whether a line begins inside a quoted text depends on all quotes before
it, so every split first computes, for either start, whether quotes are open behind it and how many records begin in it.
Put together in the order of the splits (one small row each), that tells each split how it begins; records are then cut
outside quotes only. A record that runs over the end of a split is joined from its pieces.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SUMMARY = "file long, start long, after0 int, after1 int, n0 long, n1 long"
_PIECE = "file long, number long, start long, whole boolean, record string"

#: Which lines, outside quotes, begin a record.
Begins = Callable[[pa.Array], np.ndarray]


def every_line(lines: pa.Array) -> np.ndarray:
    return np.ones(len(lines), bool)


#: Bytes of text that a task works on at once.
SLICE_BYTES = 1 << 20


def slicer(limit: int = SLICE_BYTES) -> Callable[[pa.RecordBatch, str], Iterator[pa.RecordBatch]]:
    """A function for tasks: slices of a batch with about ``limit`` bytes of a text column, at least one row each."""

    def slices(b: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(b):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield b.slice(at, to - at)
            at = to

    return slices


def _scanner(quote: str | None, comment: str | None, begins: Begins):
    """Functions that run in tasks. They are closures, so that a task needs nothing but numpy and pyarrow."""
    slices = slicer()

    def split_by(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
        """Runs of lines of one split, in order."""
        for b in (own for whole in batches for own in slices(whole, "value")):
            file, start = (b.column(c).to_numpy(zero_copy_only=False) for c in ("file", "start"))
            new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
            cuts = [0, *new.tolist(), len(file)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi > lo:
                    yield (int(file[lo]), int(start[lo])), b.column("value").slice(lo, hi - lo)

    def quotes_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per line: quotes up to and with it, and the last line so far that closes whatever was open, or -1.

        A comment line outside quotes has no quotes; inside a text it is text, and an odd number of quotes ends that.
        """
        if quote is None:
            return np.zeros(len(lines), np.int64), np.full(len(lines), -1)
        odd = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False).astype(np.int64) % 2
        closes = np.zeros(len(lines), bool)
        if comment is not None:
            closes = pc.starts_with(lines, comment).to_numpy(zero_copy_only=False) & (odd == 1)
            odd[closes] = 0
        return np.cumsum(odd), np.maximum.accumulate(np.where(closes, np.arange(len(lines)), -1))

    def states(lines: pa.Array, open_: int) -> np.ndarray:
        """Whether quotes are open in front of each line and behind the last: n + 1 values."""
        count, closed = quotes_of(lines)
        behind = np.where(closed < 0, open_ + count, count - count[closed])
        return np.concatenate([[open_], behind % 2])

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        for key, lines in split_by(batches):
            known = found.setdefault(key, [0, 1, 0, 0])
            first = begins(lines)
            for start in (0, 1):
                s = states(lines, known[start])
                known[2 + start] += int((first & (s[:-1] == 0)).sum())
                known[start] = int(s[-1])
        rows = [(*k, *v) for k, v in found.items()]
        names = ["file", "start", "after0", "after1", "n0", "n1"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def cutter(start_of: Callable[[tuple[int, int]], tuple[int, int]], lone: bool):
        """``start_of`` a split: (whether it begins inside a text, records before). ``lone``: no file has two splits."""

        def batch(key, numbers, whole, texts) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(n, key[0])), pa.array(numbers, pa.int64()), pa.array(np.full(n, key[1])), pa.array(np.full(n, whole)),
                texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()),
            ], ["file", "number", "start", "whole", "record"])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, open_, number, pending, head = None, 0, 0, [], True

            def ended() -> Iterator[pa.RecordBatch]:
                """The record that the end of a split may have cut."""
                if pending:
                    yield batch(key, [number - 1], lone, ["\n".join(pending)])

            for own, lines in split_by(batches):
                if own != key:
                    yield from ended()
                    key, pending, head = own, [], True
                    open_, number = start_of(own)
                s = states(lines, open_)
                at = np.flatnonzero(begins(lines) & (s[:-1] == 0))
                open_ = int(s[-1])
                if not len(at):
                    pending += lines.to_pylist()
                    continue
                pending += lines.slice(0, at[0]).to_pylist()
                if pending:
                    yield batch(key, [number - 1], lone or not head, ["\n".join(pending)])
                head = False
                if len(at) > 1:
                    empty, end = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
                    ended_lines = pc.binary_join_element_wise(lines.slice(0, at[-1]).cast(pa.large_string()), empty, end)
                    offsets = np.frombuffer(ended_lines.buffers()[1], np.int64)
                    bounds = pa.py_buffer(offsets[at].copy())
                    texts = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, bounds, ended_lines.buffers()[2]])
                    yield batch(key, np.arange(number, number + len(at) - 1), True, pc.utf8_rtrim(texts, "\n").cast(pa.string()))
                number += len(at)
                pending = lines.slice(at[-1]).to_pylist()
            yield from ended()

        return cut

    return summaries, cutter


def records(
    spark: SparkSession, path: str, quote: str | None = '"', comment: str | None = None, begins: Begins = every_line
) -> DataFrame:
    """(file, number, record): the records of every file and their number in it, from 0.

    ``begins`` says which lines begin a record where no quote is open; lines of a record are joined by line feeds. Texts
    may hold any characters, quotes doubled. Lines that begin with ``comment`` outside quotes have no quotes. Without
    ``quote`` every line is a record; its number is then its place in the split, so only those of a file's first split
    are the file's. ``file`` is a hash of the file's path.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    summaries, cutter = _scanner(quote, comment, begins)
    starts: dict[tuple[int, int], tuple[int, int]] = {}
    if quote is None:
        # Behind the first split numbers start far above any title line.
        rest = F.when(F.col("start") > 0, F.lit(1 << 40)).otherwise(0)
        cut = lines.mapInArrow(cutter(lambda split: (0, 0), True), _PIECE)
        return cut.select("file", (F.col("number") + rest).alias("number"), "record")
    by_file: dict[int, list] = defaultdict(list)
    for r in lines.mapInArrow(summaries, _SUMMARY).collect():  # one row a split
        by_file[r["file"]].append(r)
    for file, splits in by_file.items():
        open_, before = 0, 0
        for r in sorted(splits, key=lambda r: r["start"]):
            starts[file, r["start"]] = (open_, before)
            open_, before = (r["after1"], before + r["n1"]) if open_ else (r["after0"], before + r["n0"])
    if all(len(splits) == 1 for splits in by_file.values()):
        return lines.mapInArrow(cutter(lambda split: (0, 0), True), _PIECE).select("file", "number", "record")
    shared = spark.sparkContext.broadcast(starts)
    pieces = lines.mapInArrow(cutter(lambda split: shared.value[split], False), _PIECE)
    joined = pieces.filter("NOT whole").groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts")
    ).select("file", "number", F.array_join("parts.record", "\n").alias("record"))
    return pieces.filter("whole").select("file", "number", "record").unionByName(joined)
