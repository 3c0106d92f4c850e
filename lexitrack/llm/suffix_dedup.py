"""Repeated substrings by distributed prefix doubling over sampled suffixes; removes every byte of a string of ``LENGTH``
bytes that also starts anywhere else.

The suffixes that are ranked start at anchors: places whose 8 bytes have the least hash for ``REACH`` bytes to either
side. Equal strings have equal anchors inside, so a repeated string of ``LENGTH`` bytes is a repeated run of anchors with
a few bytes before and behind. Spark counts and sorts the pairs (rank here, rank so many anchors on), numbers the pairs
that occur more than once, and joins the numbers back: 3 anchors, 6, 12. A suffix whose pair is unique is dropped.

A last pair of overlapping ranks covers, for a whole interval between anchors, every string of ``LENGTH`` bytes that
starts in it: if it occurs again, the interval is settled. Single bytes are looked at only at the edges of repeats, where the
anchors inside a string occur again but those around it do not: there the string's own hash joins the rank. Of settled
intervals one of a kind takes part, where a rank at an edge meets it. Neighbouring places are looked for together first, by
the bytes that their strings have in common: where those occur once, so do the strings. So nothing is lost: what is compared
last is the string of ``LENGTH`` bytes at every place that can still be repeated. Strings are compared by 64-bit hashes of
their whole and of their first half.

Texts are UTF-8 bytes, null is empty; equal texts are ranked once and, from ``LENGTH`` bytes on, removed whole. Texts are
told apart by two 64-bit hashes. Repeated rows, null ids and ids that stand for several texts each get their own result row.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.llm.common import BLOCK_BYTES, binary_array, blocks, byte_codes, mix, power, raw, suffix_sums, tidy
from lexitrack.operators.numbering import numbered, placed
from lexitrack.session import remove, shared_dir

LENGTH = 400
GRAM = 8  # bytes that decide on an anchor
REACH = 16  # bytes to either side in which an anchor's hash is the least
LEVELS = (3, 6, 12)  # anchors that a rank covers
_EMIT = 1 << 18  # rows of a batch
_STEP = 1 << 16  # bytes whose anchors are found at once, so that their hashes stay in a core's cache
_NEAR = REACH + GRAM  # bytes behind an anchor that decide on it
CELL = 16  # places whose strings are looked for together first
WINDOW = 128  # places of which one gives a string without ranked anchors its cell


# Bytes

def anchors_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The anchors of the texts of a block: places whose 8 bytes hash below all up to REACH before, and to no more than
    all up to REACH behind, all of it inside the text."""
    found, step = [np.zeros(0, np.int64)], min(_STEP, BLOCK_BYTES)
    for begin in range(0, len(data), step):  # parts share their edges
        lo, hi = max(0, begin - REACH), min(len(data), begin + step + _NEAR)
        at = _local_anchors(data[lo:hi]) + lo
        found.append(at[(at >= begin) & (at < begin + step)])
    at = np.concatenate(found)
    text = np.searchsorted(offsets, at, side="right") - 1
    return at[(at - REACH >= offsets[text]) & (at + _NEAR <= offsets[text + 1])]


def _local_anchors(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    if n < 2 * REACH + 1:
        return np.zeros(0, np.int64)
    grams = np.ndarray((n,), "<u8", np.ascontiguousarray(data), strides=(1,))  # the GRAM bytes from each place on
    hashes = mix(grams + np.uint64(1))
    least, width = hashes, 1
    while width < REACH:  # the least of REACH neighbours, by windows of doubled width
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    own = hashes[REACH : n - REACH]
    return np.flatnonzero((own < least[: len(own)]) & (own <= least[REACH + 1 : REACH + 1 + len(own)])) + REACH


_ANCHORED = "doc_id long, a long, b long, n_bytes int, places array<int>, names array<long>"


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's anchors, and the hash of the bytes from an anchor to the third on."""
    first = LEVELS[0]
    for batch in batches:
        done = 0
        for texts in blocks(batch.column("text")):
            data, offsets = raw(texts)
            places = anchors_of(data, offsets)
            cuts = np.searchsorted(places, offsets)
            sums = suffix_sums(data, places, byte_codes())
            lengths = places[first:] - places[:-first] if len(places) > first else np.zeros(0, np.int64)
            names = mix(sums[: len(lengths)] - power(lengths) * sums[len(places) - len(lengths) :] + lengths.astype(np.uint64))
            text = np.repeat(np.arange(len(texts)), np.diff(cuts))
            own = text[: len(lengths)] == text[len(places) - len(lengths) :]  # both ends in one text
            named = np.concatenate([[0], np.cumsum(np.bincount(text[: len(lengths)][own], minlength=len(texts)))])
            rows = batch.slice(done, len(texts))
            done += len(texts)
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("a"), rows.column("b"), pa.array(np.diff(offsets).astype(np.int32)),
                _list(places - offsets[text], cuts, np.int32), _list(names[own].view(np.int64), named, np.int64),
            ], ["doc_id", "a", "b", "n_bytes", "places", "names"])
    tidy()


def _list(values: np.ndarray, offsets: np.ndarray, kind: type) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(kind)))


# Ranks

@contextmanager
def _cleaning(spark: SparkSession):
    """Shuffle files go when the job that wrote them is done; every step here ends in a stored table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


def rerank(pairs: DataFrame, key: list[str], folder: str) -> DataFrame:
    """(text, idx, rank) of the suffixes whose key occurs more than once: keys are counted, those left sorted, and a
    key's place in the order is its rank. Counting comes before the shuffle and the sort has one row a key, so a key that
    very many suffixes share is no hot group; the join that brings the ranks back can be split by AQE."""
    spark = pairs.sparkSession
    # Stored before they are sorted: a sort reads its input twice, once for the bounds of its ranges.
    pairs.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key).write.parquet(f"{folder}/again")
    found = spark.read.parquet(f"{folder}/again").orderBy(*key)
    found.withColumn("rank", F.monotonically_increasing_id()).write.parquet(f"{folder}/keys")
    ranks = spark.read.parquet(f"{folder}/keys")
    pairs.join(ranks, key).select("text", "idx", "rank").write.parquet(f"{folder}/ranks")
    return spark.read.parquet(f"{folder}/ranks")


def doubled(ranks: DataFrame, by: int, folder: str) -> DataFrame:
    """Ranks of twice as many anchors, from the pairs (rank, rank ``by`` anchors on)."""
    behind = ranks.select("text", (F.col("idx") - by).alias("idx"), F.col("rank").alias("behind"))
    pairs = ranks.join(behind, ["text", "idx"]).select("text", "idx", F.col("rank").alias("here"), "behind")
    pairs.write.parquet(f"{folder}/pairs")
    return rerank(ranks.sparkSession.read.parquet(f"{folder}/pairs"), ["here", "behind"], folder)


# The ranks of a batch of texts, as arrays by anchor. Texts stand one behind the other, LENGTH bytes apart, so that no
# string of one touches the next.

def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after the other, and how many each row has; null is empty."""
    return column.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)


_RANKS = [f"r{k}" for k in range(len(LEVELS))]


class _Texts:
    """places: of all anchors; text: the row of each; levels: per level its rank or -1."""

    def __init__(self, b: pa.RecordBatch):
        n_bytes = b.column("n_bytes").to_numpy(zero_copy_only=False).astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(n_bytes + LENGTH)])[:-1]
        self.end = self.base + n_bytes - LENGTH + 1  # behind the last place of a text
        local, count = _flat(b.column("places"))
        self.text = np.repeat(np.arange(len(b)), count)
        self.first = np.cumsum(count) - count
        self.places = local.astype(np.int64) + self.base[self.text]
        self.levels = []
        if "idx" in b.schema.names:
            at = self.at(b.column("idx"))
            for name in _RANKS:
                level = np.full(len(self.places), -1, np.int64)
                level[at] = _flat(b.column(name))[0]
                self.levels.append(level)

    def near_repeats(self) -> np.ndarray:
        """Anchors that bound the places of strings which can be repeated: those near a ranked anchor, and those where a
        string holds few anchors. Behind a ranked anchor a string ends within as many anchors as fit in it."""
        n, inside = len(self.places), LENGTH - REACH - _NEAR
        few = LEVELS[0] + 1
        marked = self.levels[0] >= 0
        k = np.flatnonzero((self.text[few:] == self.text[:-few]) & (self.places[few:] - self.places[:-few] >= inside))
        marked[(k[:, None] + np.arange(few + 1)).reshape(-1)] = True
        count = np.diff(np.append(self.first, n))
        some = np.arange(few)
        sparse = np.flatnonzero(count < few)
        marked[np.isin(self.text, sparse)] = True
        full = np.flatnonzero(count >= few)
        opens = full[self.places[self.first[full] + few - 1] - self.base[full] >= inside]
        closes = full[self.end[full] + LENGTH - self.places[self.first[full] + count[full] - few] >= inside]
        marked[(self.first[opens][:, None] + some).reshape(-1)] = True
        marked[((self.first[closes] + count[closes])[:, None] - 1 - some).reshape(-1)] = True
        change = np.zeros(n + 1, np.int64)
        k = np.flatnonzero(marked)
        np.add.at(change, np.maximum(k - 2, 0), 1)
        np.add.at(change, np.minimum(k + LENGTH // REACH + 3, n), -1)
        return np.flatnonzero(np.cumsum(change[:n]) > 0)

    def at(self, idx: pa.Array) -> np.ndarray:
        """The anchors of a list column of numbers in their text."""
        values, count = _flat(idx)
        return values.astype(np.int64) + np.repeat(self.first, count)


#: What two intervals of one kind share: ranks, anchors covered, bytes covered, and bytes to the next anchor.
_KIND = ["here", "behind", "size", "span", "gap"]
_COVERED = "text long, idx int, here long, behind long, size int, span int, gap int"


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For intervals between anchors: two ranks that together cover every string that starts in them, where both repeat."""
    for b in batches:
        t = _Texts(b)
        n = len(t.places)
        k = np.flatnonzero(t.text[:-1] == t.text[1:])
        to = np.searchsorted(t.places, t.places[k + 1] + LENGTH - 1)  # the first anchor at or behind the end of the last string
        inside = to < n
        inside[inside] = t.text[to[inside]] == t.text[k[inside]]
        k, to = k[inside], to[inside]
        size = to - k
        here, behind = np.full(len(k), -1, np.int64), np.full(len(k), -1, np.int64)
        for w, level in zip(LEVELS, t.levels, strict=True):
            fits = np.flatnonzero((size >= w) & (size <= 2 * w))
            here[fits], behind[fits] = level[k[fits]], level[to[fits] - w]
        kept = np.flatnonzero((here >= 0) & (behind >= 0))
        k, to = k[kept], to[kept]
        texts = b.column("text").to_numpy(zero_copy_only=False)
        columns = [
            texts[t.text[k]], (k - t.first[t.text[k]]).astype(np.int32), here[kept], behind[kept], (to - k).astype(np.int32),
            (t.places[to] - t.places[k]).astype(np.int32), (t.places[k + 1] - t.places[k]).astype(np.int32),
        ]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["text", "idx", *_KIND])


#: What the ranges of places with equal strings share, besides their distances to the first anchor inside.
_INSIDE = ["here", "behind", "size", "span"]
_RANGED = "text long, start int, end int, ahead int, rank long, here long, behind long, size int, span int, open boolean"


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose string can be repeated: with few anchors inside (rank -1), or where the anchors inside occur elsewhere.

    ``rank`` is the rank of the first three intervals inside, ``here`` and ``behind`` are ranks that together cover all
    ``size`` intervals of ``span`` bytes, ``ahead`` the bytes from the start to the first anchor; equal strings agree in all
    of them. Not open are places of a settled interval that stands for its kind."""
    for b in batches:
        t = _Texts(b)
        state = np.zeros(len(t.places), np.int8)  # of the interval behind an anchor
        state[t.at(b.column("settled"))] = 1 + _flat(b.column("stands"))[0].astype(np.int8)
        # Cut where the interval, the first anchor inside a string or the last one changes.
        near = t.near_repeats()
        lo, hi, places = t.base[t.text[near]], t.end[t.text[near]], t.places[near]
        cuts = [t.base, t.end, *(np.clip(places + move, lo, hi) for move in (0, 1 - REACH, _NEAR - LENGTH))]
        cuts = np.sort(np.concatenate(cuts))  # np.unique would hash them first
        cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])]
        start, end = cuts[:-1], cuts[1:]
        text = np.searchsorted(t.base, start, side="right") - 1
        own = np.flatnonzero(start < t.end[text])
        start, end, text = start[own], end[own], text[own]
        first = np.searchsorted(t.places, start + REACH)
        final = np.searchsorted(t.places, start + LENGTH - _NEAR, side="right") - 1
        size = final - first
        rank, ahead, span = np.full(len(start), -2, np.int64), np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        here, behind = np.full(len(start), -1, np.int64), np.full(len(start), -1, np.int64)
        rank[size < LEVELS[0]] = -1
        for k, (w, level) in enumerate(zip(LEVELS, t.levels, strict=True)):
            most = LEVELS[k + 1] if k + 1 < len(LEVELS) else 1 << 60
            fits = np.flatnonzero((size >= w) & (size < most))
            fits = fits[(level[first[fits]] >= 0) & (level[final[fits] - w] >= 0)]
            rank[fits], here[fits], behind[fits] = t.levels[0][first[fits]], level[first[fits]], level[final[fits] - w]
            ahead[fits], span[fits] = t.places[first[fits]] - start[fits], t.places[final[fits]] - t.places[first[fits]]
        before = np.searchsorted(t.places, start, side="right") - 1
        found = np.zeros(len(start), np.int8)
        inside = np.flatnonzero(before >= 0)
        inside = inside[t.text[before[inside]] == text[inside]]
        found[inside] = state[before[inside]]
        kept = np.flatnonzero((rank >= -1) & (found != 1))
        text = text[kept]
        texts = b.column("text").to_numpy(zero_copy_only=False)
        columns = [
            texts[text], (start[kept] - t.base[text]).astype(np.int32), (end[kept] - t.base[text]).astype(np.int32),
            ahead[kept].astype(np.int32), rank[kept], here[kept], behind[kept], size[kept].astype(np.int32),
            span[kept].astype(np.int32), found[kept] == 0,
        ]
        yield pa.RecordBatch.from_arrays(
            list(map(pa.array, columns)), ["text", "start", "end", "ahead", "rank", *_INSIDE, "open"]
        )


_HASHED = "text long, at int, to int, rank long, core long, places binary"
_PLACE = np.dtype([("at", "<i4"), ("whole", "<i8"), ("half", "<i8")])  # a place and its string's hashes, as bytes


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the strings at all places of a text's ranges, by cells. Of those that repeat right here only one goes
    on; the places of all of them are known to be repeated and come out as intervals, without hashes.

    A cell has the places whose distances to a mark lie in one of CELL in a row, counted from 0 on. The mark is the first
    anchor inside, or else the place of the least hash near the string's start. ``core`` is the hash of the bytes that all
    strings of the cell have in common and ``at`` where those start: equal strings are in cells of equal core, and if they
    start at two places of a text, so do the cores."""
    powers = power(np.array([LENGTH, LENGTH // 2, LENGTH - CELL + 1]))
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(zero_copy_only=False).astype(np.int64))
        row = 0
        while row < len(batch):
            done = sizes[row - 1] if row else 0
            to = max(row + 1, int(np.searchsorted(sizes, done + BLOCK_BYTES, side="right")))
            b = batch.slice(row, to - row)
            row = to
            data = np.frombuffer(b"".join(b.column("bytes").to_pylist()), np.uint8)
            base = np.concatenate([[0], sizes[to - len(b) : to] - done])
            (begin, count), (end, _), (anchor, _), (rank, _) = (_flat(b.column(c)) for c in ("start", "end", "anchor", "rank"))
            text = np.repeat(np.arange(len(b)), count)
            begin, anchor = begin + base[text], anchor + base[text]
            size = end + base[text] - begin
            texts = b.column("text").to_numpy(zero_copy_only=False)
            for part in np.array_split(np.arange(len(begin)), max(1, -(-int(size.sum()) // _EMIT))):
                own = size[part]
                at = np.repeat(begin[part] - np.cumsum(own) + own, own) + np.arange(own.sum())
                of, ranks, marks = (np.repeat(v[part], own) for v in (text, rank, anchor))
                bare = part[rank[part] < 0]
                marks[ranks < 0] = _least(data, begin[bare], size[bare])
                core = marks - (marks - at) // CELL * CELL
                lo, hi = at.min(), at.max() + LENGTH
                bounds = np.stack([at, at + LENGTH, at + LENGTH // 2, core, core + LENGTH - CELL + 1]) - lo
                asked = np.zeros(hi - lo + 1, bool)
                asked[bounds] = True
                sums = suffix_sums(data[lo:hi], np.flatnonzero(asked), byte_codes())
                here, behind, middle, first, last = sums[(np.cumsum(asked) - 1)[bounds]]
                whole, half = mix(here - powers[0] * behind).view(np.int64), mix(here - powers[1] * middle).view(np.int64)
                cores = mix(first - powers[2] * last).view(np.int64)
                order = np.argsort(whole)
                same = np.all([v[order][1:] == v[order][:-1] for v in (ranks, whole, half)], axis=0)
                again = np.zeros(len(at), bool)  # like the one before it, in order
                again[order[1:]] = same
                known = again.copy()
                known[order[:-1]] |= same
                names = ["text", "at", "to", "rank", "core", "places"]
                one = np.flatnonzero(~again)
                if len(one):
                    places = np.empty(len(one), _PLACE)
                    places["at"], places["whole"], places["half"] = (at - base[of])[one], whole[one], half[one]
                    new = np.any([v[one][1:] != v[one][:-1] for v in (of, core, ranks)], axis=0)
                    cell = np.concatenate([[0], np.flatnonzero(new) + 1])
                    bounds = np.append(cell, len(one)) * _PLACE.itemsize
                    cell = one[cell]
                    starts = (core - base[of])[cell].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        *map(pa.array, (texts[of[cell]], starts, starts + 1, ranks[cell], cores[cell])), binary_array(places.view(np.uint8), bounds),
                    ], names)
                k = np.flatnonzero(known)
                if len(k):
                    # Texts stand LENGTH bytes apart, so intervals of two never touch.
                    lo, hi = merged(at[k] + LENGTH * of[k], at[k] + LENGTH * of[k] + 1)
                    in_text = np.searchsorted(base + LENGTH * np.arange(len(base)), lo, side="right") - 1
                    shift = base[in_text] + LENGTH * in_text
                    none = pa.nulls(len(lo), pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(texts[in_text]), pa.array((lo - shift).astype(np.int32)), pa.array((hi - shift).astype(np.int32)), none, none,
                        pa.nulls(len(lo), pa.binary()),
                    ], names)
    tidy()


def _least(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For ``size`` places from each ``begin`` on, the first place of the least hash of GRAM bytes among the WINDOW from it on."""
    if not len(begin):
        return np.zeros(0, np.int64)
    own = size + WINDOW - 1
    ends = np.cumsum(own)
    at = np.repeat(begin - ends + own, own) + np.arange(ends[-1])
    grams = np.ndarray((len(data) - GRAM + 1,), "<u8", data, strides=(1,))
    least, place, width = mix(grams[at] + np.uint64(1)), at, 1
    while width < WINDOW:
        later = least[width:] < least[:-width]
        least, place = np.where(later, least[width:], least[:-width]), np.where(later, place[width:], place[:-width])
        width *= 2
    return place[np.repeat(ends - own - np.cumsum(size) + size, size) + np.arange(size.sum())]


_BY_PLACE = "text long, rank long, at int, whole long, half long"


def _by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each place of a cell."""
    for b in batches:
        cells = b.column("places")
        count = pc.binary_length(cells).to_numpy(zero_copy_only=False) // _PLACE.itemsize
        places = np.frombuffer(b"".join(cells.to_pylist()), _PLACE)
        text, rank = (np.repeat(b.column(c).to_numpy(zero_copy_only=False), count) for c in ("text", "rank"))
        columns = [text, rank, *(np.ascontiguousarray(places[c]) for c in _PLACE.names)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["text", "rank", *_PLACE.names])


# The operator

def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"),
    )


def repeats(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(a, b, copies, starts) of the texts, by their two hashes, with places from which a string of LENGTH bytes is
    repeated: ``starts`` holds intervals [from, to) of such places. Texts without any and without copies are not listed,
    nor are those below LENGTH bytes."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "suffixes")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def forget(*names: str) -> None:
        """Tables that no later step reads."""
        for name in names:
            remove(spark, f"{folder}/{name}")

    with _cleaning(spark):
        long_enough = _named(docs).filter(F.octet_length("text") >= LENGTH)
        found = long_enough.mapInArrow(_anchored, _ANCHORED)
        once = found.groupBy("a", "b").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"),
            F.first("places").alias("places"), F.first("names").alias("names"),
        )
        texts = numbered(stored(placed(once), "texts"), "text")

        suffixes = texts.select("text", F.posexplode("names").alias("idx", "name"))
        ranks = [rerank(suffixes, ["name"], f"{folder}/rank-{LEVELS[0]}")]
        for w in LEVELS[:-1]:
            ranks.append(doubled(ranks[-1], w, f"{folder}/rank-{2 * w}"))
        joined = ranks[0].withColumnRenamed("rank", "r0")
        for k, r in enumerate(ranks[1:], 1):
            joined = joined.join(r.withColumnRenamed("rank", f"r{k}"), ["text", "idx"], "left")
        none = [F.coalesce(r, F.lit(-1).cast("long")).alias(r) for r in _RANKS]
        of_text = joined.groupBy("text").agg(F.collect_list(F.struct("idx", *none)).alias("s"))
        state = stored(
            texts.select("text", "n_bytes", "places").join(of_text, "text", "left")
            .select("text", "n_bytes", "places", "s.idx", *[f"s.{r}" for r in _RANKS]), "state"
        )
        forget(*[f"rank-{LEVELS[0] << k}" for k in range(len(LEVELS))])

        covers = stored(state.filter("idx IS NOT NULL").mapInArrow(_covers, _COVERED), "covers")
        again = covers.groupBy(*_KIND).agg(F.count("*").alias("n"), F.min(_one("idx")).alias("one")).filter("n > 1")
        settled = covers.join(again.select(*_KIND, "one"), _KIND).groupBy("text").agg(
            F.collect_list(F.struct("idx", (_one("idx") == F.col("one")).alias("stands"))).alias("s")
        )
        settled = stored(settled.select("text", F.col("s.idx").alias("settled"), "s.stands"), "settled")
        forget("covers")

        ranges = stored(state.join(settled, "text", "left").mapInArrow(_possible, _RANGED), "ranges")
        # Where three intervals are inside, places go on whose inside some other anchor has too, an open place's among
        # them; of the places that stand for others those as far from the first anchor as open ones.
        ranges = ranges.withColumn("anchor", F.col("start") + F.col("ahead"))
        ranked = ranges.filter("rank >= 0")
        nearest = F.col("ahead") - F.col("end") + F.col("start") + 1
        asked = ranked.groupBy(*_INSIDE).agg(
            F.min(F.when(F.col("open"), nearest)).alias("lo"), F.max(F.when(F.col("open"), F.col("ahead"))).alias("hi"),
            F.min(_one("anchor")).alias("one"), F.max(_one("anchor")).alias("other"),
        ).filter("lo IS NOT NULL AND one < other").drop("one", "other")
        # An open place lies between its group's bounds, so they cut nothing from it.
        needed = ranked.join(asked, _INSIDE).select(
            "text", F.greatest("start", F.col("anchor") - F.col("hi")).alias("start"),
            F.least("end", F.col("anchor") - F.col("lo") + 1).alias("end"), "anchor", "rank",
        ).filter("start < end").unionByName(ranges.filter("rank < 0").select("text", "start", "end", "anchor", "rank"))
        needed = needed.groupBy("text").agg(F.collect_list(F.struct("start", "end", "anchor", "rank")).alias("s"))
        named = texts.select("text", F.col("doc_id").alias("id"), "a", "b").join(needed, "text")
        own = long_enough.select(
            F.col("doc_id").alias("own_id"), F.col("a").alias("own_a"), F.col("b").alias("own_b"), F.encode("text", "UTF-8").alias("bytes")
        )
        same = (F.col("a") == F.col("own_a")) & (F.col("b") == F.col("own_b")) & F.col("id").eqNullSafe(F.col("own_id"))
        strings = own.join(named, same).select("text", "s.start", "s.end", "s.anchor", "s.rank", "bytes").mapInArrow(_strings, _HASHED)
        strings = stored(strings, "strings")
        forget("ranges")
        # Least and greatest place, for a repeated row of documents hashes its places again.
        least, greatest = F.min(_one("at")).alias("lo"), F.max(_one("at")).alias("hi")
        cells, key = strings.filter("core IS NOT NULL"), ["rank", "core"]
        met = cells.groupBy(*key).agg(least, greatest).filter("lo < hi")
        hashed = cells.join(met.select(*key), key).select("text", "rank", "places").mapInArrow(_by_place, _BY_PLACE)
        hashed, key = stored(hashed, "places"), ["rank", "whole", "half"]
        hit = hashed.groupBy(*key).agg(least, greatest).filter("lo < hi")
        hits = hashed.join(stored(hit.select(*key), "hit"), key).select("text", "at", (F.col("at") + 1).alias("to")).unionByName(
            strings.filter("core IS NULL").select("text", "at", "to")
        ).groupBy("text").agg(F.collect_list(F.struct("at", "to")).alias("s")).select("text", F.col("s.at").alias("hits"), "s.to")
        starts = (
            state.select("text", "n_bytes", "places").join(settled, "text", "left").join(hits, "text", "left")
            .filter("hits IS NOT NULL OR settled IS NOT NULL")
            .mapInArrow(_intervals, "text long, starts array<struct<lo:int,hi:int>>")
        )
        found = texts.select("text", "a", "b", "copies").join(starts, "text", "left")
        found = stored(found.filter("copies > 1 OR starts IS NOT NULL").drop("text"), "found")
        forget("texts", "state", "settled", "strings", "places", "hit")
        return found


def _one(place: str) -> Column:
    """A text and a place in it as one number."""
    return F.shiftleft("text", 31).bitwiseOR(F.col(place).cast("long"))


_SPAN = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled intervals and single places as joined intervals of places."""
    for b in batches:
        t = _Texts(b)
        k = t.at(b.column("settled"))
        (at, count), (to, _) = _flat(b.column("hits")), _flat(b.column("to"))
        base = np.repeat(t.base, count)
        lo, hi = merged(np.concatenate([t.places[k], at + base]), np.concatenate([t.places[k + 1], to + base]))
        text = np.searchsorted(t.base, lo, side="right") - 1
        bounds = [pa.array((v - t.base[text]).astype(np.int32)) for v in (lo, hi)]
        offsets = np.searchsorted(text, np.arange(len(b) + 1))
        spans = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(bounds, ["lo", "hi"]))
        yield pa.RecordBatch.from_arrays([b.column("text"), spans], ["text", "starts"])


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that touch or overlap as one."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(hi) - 1]])]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, and its spans."""
    for b in batches:
        kept, spans, n = [], [], []
        for text, copies, starts in zip(b.column("bytes"), b.column("copies").to_pylist(), b.column("starts").to_pylist(), strict=True):
            data = text.as_buffer()
            n.append(data.size)
            if (copies or 0) > 1:
                own = [(0, data.size)]
            else:
                lo, hi = (np.array([s[k] for s in starts or ()], np.int64) for k in ("lo", "hi"))
                lo, hi = merged(lo, hi + LENGTH - 1)
                own = list(zip(lo.tolist(), hi.tolist(), strict=True))
            whole, at, parts = memoryview(data), 0, []
            for lo, hi in own:
                parts.append(whole[at:lo])
                at = hi
            kept.append(b"".join([*parts, whole[at:]]))
            spans.append([{"lo": lo, "hi": hi} for lo, hi in own])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, _SPAN), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def cut(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed runs of bytes, and the bytes that are left."""
    named = _named(docs)
    found = repeats(docs, folder).withColumnsRenamed({"a": "found_a", "b": "found_b"})
    rows = named.select("doc_id", "a", "b", F.encode("text", "UTF-8").alias("bytes"))
    same = (F.col("a") == F.col("found_a")) & (F.col("b") == F.col("found_b"))
    joined = rows.join(found, same, "left").select("doc_id", "bytes", "copies", "starts")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<lo:int,hi:int>>, kept binary")


def dedup(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["hi"] - s["lo"]))
    return cut(docs, folder).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
