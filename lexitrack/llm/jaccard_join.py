"""Jaccard join of word-shingle sets by universe partitioning.

Two sets of sizes a and b are linked if they share at least 80 % of their union, so they differ in at most
(a + b) / 9 elements. Sizes are cut into bands; a band's table holds the sets of its sizes and the larger ones that
can be linked with them, and H is the most by which linked sets of the table differ. Elements are hashed into the
table's segments. A segment has a budget of one (its exact subset is a key) or two (also its subset without each one
element is), chosen for the table by a cost model of keys and chance partners, in all more than H. By the pigeonhole
two linked sets share a key of a segment, provided that the segments which hold enough elements have a budget of more
than H; a set for which they don't is keyed again by another hash, until they do. Of two linked sets, the one that
needs fewer hashes is sure to meet the other.

Keys travel packed by hash bucket. Sets that share a key form a group; every group's smallest set is compared with the
others (stars, not all pairs), by sizes and parity sketches, which rule out most pairs for sure, then exactly, components are computed, and only where a group then holds several components
are the pairs between these compared: the nearest ones of every two components by sketch first, then more, until none
is left that could be linked. A group too large for a task is divided by the keys of another hash, which linked sets
share too. Nothing is capped. Equal sets are one set from the start.

Words stand between ASCII white space, A-Z made small. A set has the distinct shingles of five words, or the whole
sequence as one where there are fewer; a null text, or one without words, has none and links with nothing. Sets are
compared as sets of 64-bit hashes and named by a 64-bit hash of all of them. Rows that repeat a doc_id are in one
component each by their text: a set's text is found by the id and two hashes of the text of one row that has it, an id of
null as any other. A null doc_id is the smallest only if there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitrack.llm.common import blocks, mix as _mix, tidy, word_hashes
from lexitrack.session import shared_dir

SHINGLE = 5
#: Sets of a group whose sketches are compared in one task; a larger group is divided.
GROUP_SETS = 32_768
#: Pairs of two components in a group that are compared in the first round; each round takes so many times more.
ROUND_PAIRS = 32
ROUND_GROWTH = 1024
#: Sets compared with one other in a task.
STAR = 64
#: Keys in a bucket, about.
BUCKET_KEYS = 250_000
#: Up to so many ids are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: What names a row: its id, which may be null or repeated, and two hashes of its text.
ROW = ["doc_id", "text_hash", "text_crc"]
_BLOCK = 8 << 20
_TEXT_BYTES = 1 << 20
_U = np.uint64


# Sets

def sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct hashes of every text's shingles."""
    words, bounds = word_hashes(texts)
    weights = [_U(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64)) for j in range(SHINGLE)]
    grams = np.zeros(max(0, len(words) - SHINGLE + 1), _U)
    for j, weight in enumerate(weights):
        grams += words[j : j + len(grams)] * weight
    grams = _mix(grams)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(grams[a : b - SHINGLE + 1]))
        else:
            few = (words[a:b] * np.array(weights, _U)[: b - a]).sum(dtype=_U, keepdims=True) + _U(b - a)
            out.append(_mix(few[: b - a]))
    return out


def name(elements: np.ndarray) -> int:
    """A set's 64-bit name, as a signed number."""
    sums = np.stack([_mix(elements + _U(1)).sum(dtype=_U), _mix(elements ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U) * _U(3)])
    return int(_mix(np.array([sums[0] + sums[1] + _U(len(elements))], _U)).view(np.int64)[0])


def sketch(elements: np.ndarray) -> bytes:
    """Parities of the numbers of elements by hash, in as many bits as the set has elements or up to twice as many.

    An element in one of two sets alone changes one parity, so sets differ in at least as many elements as parities.
    """
    bits = 1 << max(6, len(elements).bit_length())
    counts = np.bincount((_mix(elements ^ _U(0x5851F42D4C957F2D)) & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """The least number of elements in one of two sets alone, by their sketches."""
    if len(a) > len(b):
        a, b = b, a
    x, y, width = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while width > 8 * len(a):  # parities of fewer bits
        width //= 2
        y = (y >> width) ^ (y & ((1 << width) - 1))
    return (x ^ y).bit_count()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= 80 * (len(a) + len(b) - common) > 0


# Tables

@cache
def table_of_band(lo: int, hi: int) -> tuple[int, int, int]:
    """For sets of lo to hi elements and their larger partners: H, segments of budget one, segments of budget two."""
    most = (hi + hi * 5 // 4) // 9
    if not most:
        return 0, 0, 0
    size = (lo + hi) / 2

    def cost(two: int) -> float:
        one = max(0, most + 1 - 2 * two)
        held = size / (one + two)
        keys = one + two * (1 + held)
        return keys * (1 + 10 * 0.3**held)  # a key's chance partners fall with the elements of its segment

    two = min(range((most + 2) // 2 + 1), key=cost)
    one = least = max(0, most + 1 - 2 * two)
    while True:  # as many more as are likely lost to segments with too few elements
        held = lo / (one + two)
        lost = one * exp(-held) + 2 * two * (1 + held) * exp(-held) if one + two > 1 else 0
        if one - least >= lost + sqrt(lost) or one - least > least + two + 4:
            return most, one, two
        one += 1


@cache
def bands_of(size: int) -> list[tuple[int, int, int]]:
    """The tables for a set: number, lo and hi of the band; sets of up to three elements link with equal ones only."""
    out, number, lo = [], 0, 4
    while lo <= size:
        hi = lo * 3 // 2
        if lo <= size <= hi * 5 // 4:
            out.append((number, lo, hi))
        number, lo = number + 1, hi + 1
    return out


def _keys_once(elements: np.ndarray, code: int, most: int, one: int, two: int) -> tuple[np.ndarray, bool]:
    """Keys of a set by one hash, and whether they are sure to meet every linked set's."""
    m = one + two
    seed = _mix(np.array([code], _U))[0]
    segment = ((_mix(elements ^ seed) >> _U(32)) * _U(m)) >> _U(32)
    order = np.argsort(segment, kind="stable")
    segment, values = segment[order], _mix(elements + seed)[order]
    starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
    counts = np.diff(np.append(starts, len(segment)))
    subsets, own = np.add.reduceat(values, starts), segment[starts]
    double = own < two
    budget = (~double).sum() + 2 * (double & (counts > 1)).sum()
    at, sums = [own], [subsets]
    if two:
        more = np.repeat(double & (counts > 1), counts)
        at.append(segment[more])
        sums.append(np.repeat(subsets, counts)[more] - values[more])
    return _mix(np.concatenate(sums) + _mix(np.concatenate(at) + seed)), bool(budget > most)


def keys(elements: np.ndarray, salt: int = 0, level: int = 0) -> np.ndarray:
    """All keys of a set. Linked sets share at least one; for another salt or level they are unrelated."""
    out = []
    for number, lo, hi in bands_of(len(elements)):
        most, one, two = table_of_band(lo, hi)
        if not most:
            continue
        for attempt in range(64):
            code = (number << 16 | level << 8 | attempt) + 1
            found, sure = _keys_once(elements, code, most, one, two)
            out.append(found)
            if sure:
                break
        else:  # a key that all such sets of the table have
            out.append(_mix(np.array([number], _U)))
    found = np.unique(np.concatenate(out)) if out else np.zeros(0, _U)
    return _mix(found ^ _U(salt & 0xFFFFFFFFFFFFFFFF)) if salt else found


# Spark jobs

def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (text, *ROW): the name of the row, and size, name and sketch of the set."""
    for batch in batches:
        rows = [
            (len(s), name(s), sketch(s)) for block in blocks(batch.column(0), _TEXT_BYTES) for s in sets(block)
        ]
        size, node, bits = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(bits, pa.binary())],
            names=[*ROW, "n_shingles", "node", "bits"],
        )
    tidy()


def _packer(buckets: int, level: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows (text, salt): buckets with the sorted keys in them and the sets that have them."""
        held, size = [], 0
        for batch in batches:
            at = 0
            for block in blocks(batch.column(0), _TEXT_BYTES):
                salts = batch.column(1).slice(at, len(block)).to_pylist()
                at += len(block)
                held += zip(salts, sets(block), strict=True)
                size += block.nbytes
                if size >= _BLOCK:
                    yield from _packed(held, buckets, level)
                    held, size = [], 0
        yield from _packed(held, buckets, level)
        tidy()

    return pack


def _packed(held: list[tuple[int, np.ndarray]], buckets: int, level: int) -> Iterator[pa.RecordBatch]:
    distinct = {(salt, name(s)): s for salt, s in held if len(s)}  # copies meet here
    all_keys = [keys(s, salt, level) for (salt, _), s in distinct.items()]
    if not all_keys or not (total := np.concatenate(all_keys)).size:
        return
    nodes = np.repeat(np.array([n for _, n in distinct], np.int64), [len(k) for k in all_keys])
    order = np.argsort(total)
    total, nodes = total[order], nodes[order]
    which = ((total >> _U(32)) * _U(buckets)) >> _U(32)
    cuts = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    ends = np.append(cuts[1:], len(which))
    low = np.ascontiguousarray(total.view(np.uint8).reshape(-1, 8)[:, :5])  # with the bucket enough of a key
    yield pa.RecordBatch.from_arrays([
        pa.array(which[cuts].astype(np.int32)), pa.array([low[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
        pa.array([nodes[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
    ], names=["bucket", "keys", "nodes"])


_GROUP = pa.schema([("group", pa.int64()), ("members", pa.list_(pa.int64()))])


def _grouped(packed: pa.Table) -> pa.Table:
    """Distinct groups of at least two sets that share a key of the bucket; members in order."""
    low = np.frombuffer(b"".join(packed["keys"].to_pylist()), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(low), 8), np.uint8)
    wide[:, :5] = low
    key = wide.view(_U).reshape(-1)
    node = np.frombuffer(b"".join(packed["nodes"].to_pylist()), np.int64)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    kept = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))
    key, node = key[kept], node[kept]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    ends = np.append(starts[1:], len(key))
    several = ends - starts > 1
    starts, ends = starts[several], ends[several]
    if not len(starts):
        return _GROUP.empty_table()
    names = np.add.reduceat(_mix(node.view(_U)), np.stack([starts, ends], 1).reshape(-1)[: None if ends[-1] < len(node) else -1])[::2]
    names, chosen = np.unique(_mix(names + (ends - starts).astype(_U)), return_index=True)
    members = [node[starts[i] : ends[i]] for i in chosen]
    found = pa.table([pa.array(names.view(np.int64)), pa.array(members, pa.list_(pa.int64()))], schema=_GROUP)
    del low, wide, key, node, order, kept, members
    tidy()
    return found


def groups(texts: DataFrame, level: int, total_keys: int) -> DataFrame:
    """Groups of sets that share a key, from rows (text, salt)."""
    buckets = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total_keys // BUCKET_KEYS))
    packed = texts.select("text", "salt").mapInArrow(_packer(buckets, level), "bucket int, keys binary, nodes binary")
    found = packed.groupBy("bucket").applyInArrow(_grouped, "group long, members array<long>")
    return found.dropDuplicates(["group"])


def _compared(key: tuple, rows: pa.Table) -> pa.Table:
    """Of one set (other is null) and others: the links between it and them."""
    texts = rows["text"].combine_chunks()
    others = rows["other"].to_pylist()
    found = [s for block in blocks(texts, _TEXT_BYTES) for s in sets(block)]
    hub = next((s for s, o in zip(found, others, strict=True) if o is None), None)
    ok = [o for s, o in zip(found, others, strict=True) if o is not None and hub is not None and linked(hub, s)]
    one = key[0].as_py()
    return pa.table({"a": pa.array([one] * len(ok), pa.int64()), "b": pa.array(ok, pa.int64())})


def _near(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for a, b, most in columns:
        rows = zip(a.to_pylist(), b.to_pylist(), most.to_pylist(), strict=True)
        yield pa.array([apart(x, y) <= m for x, y, m in rows], pa.bool_())


def likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) but those whose sizes or sketches show that they are not linked."""
    for side in "ab":
        own = sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)
    sizes = 10 * F.least("n_a", "n_b") >= 8 * F.greatest("n_a", "n_b")
    most = F.floor((F.col("n_a") + F.col("n_b")) / 9).cast("long")
    near = F.arrow_udf(_near, "boolean")(F.col("bits_a"), F.col("bits_b"), most)
    return pairs.filter(sizes).filter(near).select("a", "b")


def _of_rows(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Columns of nodes, and the text of the row that each names, as often as the row is there."""
    named = nodes.select(*nodes.columns, *[F.col(c).alias(f"own_{c}") for c in ROW]).drop(*ROW)
    same = [F.col(ROW[0]).eqNullSafe(F.col(f"own_{ROW[0]}")), *(F.col(c) == F.col(f"own_{c}") for c in ROW[1:])]
    return docs.join(named, same).drop(*ROW, *(f"own_{c}" for c in ROW))


def _texts(pairs: DataFrame, owners: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """(node, text) of the sets in pairs, from one document of each."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(owners, "node")
    if nodes.count() <= BROADCAST_ROWS:
        nodes = F.broadcast(nodes)
    texts = _of_rows(nodes, docs).select("node", "text")
    return texts.dropDuplicates(["node"]) if repeated else texts


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The linked ones of distinct pairs (a, b). A set with very many partners is compared in several tasks."""
    spread = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    dealt = pairs.join(spread, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    b = texts.select(F.col("node").alias("b"), "text")
    a = texts.select(F.col("node").alias("a"), "text")
    others = dealt.join(b, "b").select("a", "part", F.col("b").alias("other"), "text")
    hubs = dealt.select("a", "part").distinct().join(a, "a").select("a", "part", F.lit(None).cast("long").alias("other"), "text")
    return others.unionByName(hubs).groupBy("a", "part").applyInArrow(_compared, "a long, b long")


def components(links: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """(node, label): the smallest node that links reach, for each node with a link.

    Every node takes the smallest label of its neighbours, and the label of its label, until nothing changes; each
    round is written to the shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    turn = 0
    while True:
        path = f"{folder}/labels-{turn}"
        labels.write.parquet(path)
        labels, turn = spark.read.parquet(path), turn + 1
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        least = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = labels.join(least, "node", "left").join(jump, "label", "left").select(
            "node", F.least("label", "near", "far").alias("new"), "label"
        )
        if moved.filter(F.col("new") != F.col("label")).isEmpty():
            return labels
        labels = moved.select("node", F.col("new").alias("label"))


def _between(limit: int):
    def pairs(rows: pa.Table) -> pa.Table:
        """Of the groups with one smallest set: for every two components the pairs that sketches don't rule out,
        nearest first, up to the limit; and whether there are more. A pair of several of these groups counts once."""
        rows = rows.sort_by("group")
        group = rows["group"].to_numpy()
        cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        found: tuple[list, ...] = ([], [], [], [], [])
        for start, end in zip(cuts, np.append(cuts[1:], len(group)), strict=True):
            own = rows.slice(start, end - start)
            of_group = _unlike(own["node"].to_numpy(), own["label"].to_numpy(), own["n"].to_numpy(), own["bits"].to_pylist())
            for x, y in zip(found, of_group, strict=True):
                x += y
        a, b, one, other, far = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
        _, once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1, return_index=True)
        a, b, one, other, far = a[once], b[once], one[once], other[once], far[once]
        low, high = np.minimum(one, other), np.maximum(one, other)
        order = np.lexsort((far, high, low))
        a, b, low, high = a[order], b[order], low[order], high[order]
        fresh = np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1]))[: len(a)]
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(fresh, np.arange(len(a)), 0)) if len(a) else a
        kept = rank < limit
        more = pa.array([not kept.all()] * int(kept.sum()), pa.bool_())
        return pa.table({"a": np.minimum(a, b)[kept], "b": np.maximum(a, b)[kept], "more": more})

    return pairs


def _unlike(node: np.ndarray, label: np.ndarray, n: np.ndarray, bits: list[bytes]) -> tuple[list, ...]:
    """Pairs with different labels that sizes and sketches allow: nodes, labels, and how far they are at least."""
    order = np.argsort(n, kind="stable")
    node, label, n, bits = node[order], label[order], n[order], [bits[i] for i in order]
    widths = np.array([len(x) for x in bits])
    out: tuple[list, ...] = ([], [], [], [], [])
    for width in np.unique(widths):
        # Sizes of linked sets differ by a quarter at most, so a partner's sketch has this width or twice as much.
        at = np.flatnonzero(widths == width)
        wide = np.flatnonzero(widths == 2 * width)
        own = np.frombuffer(b"".join(bits[i] for i in at), np.uint64).reshape(len(at), -1)
        folded = np.frombuffer(b"".join(bits[i] for i in wide), np.uint64).reshape(len(wide), 2, own.shape[1])
        every, partner = np.concatenate([at, wide]), np.concatenate([own, folded[:, 0] ^ folded[:, 1]])
        ends = np.searchsorted(n[every], n[at] * 5 // 4, side="right")
        for k, i in enumerate(at.tolist()):
            later = slice(k + 1, int(ends[k]))
            js = every[later]
            differ = label[js] != label[i]
            js = js[differ]
            if not len(js):
                continue
            far = np.bitwise_count(partner[later][differ] ^ own[k]).sum(1, dtype=np.int64)
            near = far <= (n[js] + n[i]) // 9
            js, far = js[near], far[near]
            for x, y in zip(out, (np.full(len(js), node[i]), node[js], np.full(len(js), label[i]), label[js], far), strict=True):
                x.append(y)
    return out


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _mixed(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups that hold several components: size and members with labels."""
    named = found.select("group", F.explode("members").alias("node")).join(labels, "node", "left")
    named = named.select("group", "node", F.coalesce("label", "node").alias("label"))
    several = named.groupBy("group").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter(F.col("x") != F.col("y"))
    return named.join(several, "group", "left_semi").groupBy("group").agg(
        F.collect_list(F.struct("node", "label")).alias("m"), F.count("*").alias("size"), F.min("node").alias("hub")
    )


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; the component is named by its smallest doc_id."""
    return components_of(docs, doc_id, text).select("doc_id", "n_shingles", "component_id")


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """The columns ``ROW`` of a row."""
    value = F.coalesce(text, F.lit(""))
    return [doc_id.cast("long").alias(ROW[0]), F.xxhash64(value).alias(ROW[1]), F.crc32(value).alias(ROW[2])]


def components_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``join`` gives, with the columns ``ROW``, and ``first``: whether a row, or its like, is the first of its
    component, by ids, then texts. Rows without a set are first."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "jaccard")
    docs = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), *row_key(F.col(doc_id), F.col(text)))
    schema = "doc_id long, text_hash long, text_crc long, n_shingles long, node long, bits binary"
    named = _written(docs.mapInArrow(_names, schema), f"{folder}/names")
    full = named.filter(F.col("n_shingles") > 0)
    # Of the rows of a set the one of the smallest id; nulls come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), *ROW))
    owners = full.groupBy("node").agg(first.alias("own")).select("node", *[f"own.{c}" for c in ROW])
    repeated = not full.groupBy(*ROW).count().filter(F.col("count") > 1).isEmpty()
    sketches = full.select("node", F.col("n_shingles").alias("n"), "bits").dropDuplicates(["node"])
    total = named.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0] // 2
    rows, links, level = docs.withColumn("salt", F.lit(0).cast("long")), None, 0
    while True:
        found = _written(groups(rows, level, total), f"{folder}/groups-{level}")
        stars = found.select(F.col("members")[0].alias("a"), F.explode(F.slice("members", 2, F.size("members"))).alias("b"))
        links = _more(links, _links(likely(stars.distinct(), sketches), owners, docs, repeated, f"{folder}/stars-{level}"))
        limit, more = ROUND_PAIRS, True
        while more:
            turn = f"{level}-{limit}"
            mixed = _mixed(found, components(links, spark, f"{folder}/labels-{turn}"))
            mixed = _written(mixed, f"{folder}/mixed-{turn}")
            of_sets = mixed.filter(F.col("size") <= GROUP_SETS).select("group", "hub", F.explode("m").alias("m")).select("group", "hub", "m.*")
            pairs = of_sets.join(sketches, "node").groupBy("hub").applyInArrow(_between(limit), "a long, b long, more boolean")
            pairs = _written(pairs.groupBy("a", "b").agg(F.max("more").alias("more")), f"{folder}/pairs-{turn}")
            more = not pairs.filter("more").isEmpty()
            links = _more(links, _links(pairs.select("a", "b"), owners, docs, repeated, f"{folder}/others-{turn}"))
            limit *= ROUND_GROWTH
        large = mixed.filter(F.col("size") > GROUP_SETS)
        if large.isEmpty():
            break
        level += 1
        again = large.select(F.col("group").alias("salt"), F.explode("m.node").alias("node"))
        rows = _of_rows(again.join(owners, "node"), docs).select("text", "salt")
        total = 0
    labels = components(links, spark, f"{folder}/labels")
    owner = owners.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), *ROW)
    least = owner.groupBy("label").agg(first.alias("least"))
    of_nodes = owner.join(least, "label").select("node", "least")
    own = F.struct(F.col("doc_id").isNull().alias("none"), *ROW)
    return named.join(of_nodes, "node", "left").select(
        *ROW, "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n_shingles") == 0) | own.eqNullSafe(F.col("least"))).alias("first"),
    )


def _links(pairs: DataFrame, owners: DataFrame, docs: DataFrame, repeated: bool, path: str) -> DataFrame:
    """The linked ones of distinct pairs that sketches don't rule out, by the sets of one text each."""
    pairs = _written(pairs, f"{path}-pairs")
    texts = _written(_texts(pairs, owners, docs, repeated), f"{path}-texts")
    return _written(compare(pairs, texts), f"{path}-links")


def _more(links: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if links is None else links.unionByName(new)
