"""Token ids as bit-plane shuffled blocks: encode, write in document order, read back.

A stored set of ids is two Parquet tables under one folder. ``blocks`` has one row for each block of at most 65,536
ids: its part and number, and its planes. A block's ids are transposed, so that the first plane holds the lowest byte
(or bit) of every id, the next one the second lowest, and so on up to the highest that any id uses; each plane is
compressed with zstandard. Beside them stand the pieces of documents in the block. ``index`` is the chunk index: part,
block, position of its first id among all ids, count, and the bytes of each plane. A reader of some positions needs
the index and the blocks that it names.

Documents are ordered by range partitioning on (doc_id, hash of the text), so no task sees more than its part, and the
position of a part is a running sum over one row for each part. Spark's writers store the files: a task that is run
again replaces its own output.

Nulls count as empty texts, which have the end id alone. Rows with one doc_id stay separate documents, in the order
of their hashes. A null doc_id sorts first. An empty table gives an empty set.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexitrack.llm.common import SliceCache, binary_array, blocks, raw, tokenizer_path
from lexitrack.session import shared_dir

VOCABULARY = "word_bpe_49k.json"
TEXT_BYTES = 8 << 20
BLOCK_IDS = 1 << 16
#: Rows of an index, of three numbers each, that are broadcast.
BROADCAST_BLOCKS = 1_000_000
END_ID = 1
LEVEL = 1

_PIECE = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("n", pa.int64())])
_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
    ("planes", pa.list_(pa.binary())), ("pieces", pa.list_(_PIECE)),
])
_BLOCK_DDL = (
    "part int, block long, first long, n long, planes array<binary>, "
    "pieces array<struct<row: bigint, doc_id: bigint, piece: bigint, n: bigint>>"
)


# Encoding: white space separates words for this kind of tokenizer, so each distinct word is encoded once.

#: Small letters that NFC, lower-casing and the split into runs of letters leave as they are.
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
_KNOWN_STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]


@cache
def _coder(path: str) -> SliceCache:
    """A cache of encoded words. Words of plain letters skip the normaliser and the split, which don't change them
    in a tokenizer of the known steps."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    with open(path) as file:
        settings = json.load(file)
    steps = [
        s["type"] for part, items in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
        for s in (settings[part] or {}).get(items, [])
    ]
    bare = tokenizer
    if steps == _KNOWN_STEPS:
        bare = Tokenizer(tokenizer.model)
        bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def lists(coder, words: list[str]) -> list[list[int]]:
        return [e.ids for e in coder.encode_batch_fast(words, add_special_tokens=False)]

    def encode(words: list[bytes]) -> tuple[list[int], list[int]]:
        texts = [w.decode() for w in words]
        plain = [_PLAIN(t) is not None for t in texts]
        short = iter(lists(bare, [t for t, p in zip(texts, plain, strict=True) if p]))
        full = iter(lists(tokenizer, [t for t, p in zip(texts, plain, strict=True) if not p]))
        found = [next(short if p else full) for p in plain]
        return [i for ids in found for i in ids], [len(ids) for ids in found]

    return SliceCache(encode)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that end at blanks: their bytes together, n + 1 offsets, and the n + 1 offsets of texts.

    To meet fewer distinct words, A-Z become small (the tokenizer does so; not before a combining accent, with which
    only the small letter may compose, nor where marks of special tokens occur), and a full stop or comma after a
    small letter at the end of a word is a word of its own.
    """
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    follows = np.append(data[1:], 0)
    if b"<|" not in data.tobytes():
        large = (data >= 0x41) & (data <= 0x5A) & (follows != 0xCC) & (follows != 0xCD)
        data = data + 32 * large.astype(np.uint8)
    first = ~blank
    first[1:] &= blank[:-1]
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[text_starts] = ~blank[text_starts]
    ends = np.append(blank[1:], True)
    ends[text_starts[1:] - 1] = True
    first[1:] |= (((data == 0x2E) | (data == 0x2C)) & ends)[1:] & (data[:-1] >= 0x61) & (data[:-1] <= 0x7A)
    kept = np.append(0, np.cumsum(~blank))
    starts = kept[:-1][first]
    texts = np.searchsorted(np.flatnonzero(first), offsets)
    return data[~blank], np.append(starts, kept[-1]), texts


def encode_block(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of texts, the end id after each, and the n + 1 offsets."""
    data, at, bounds = words(*raw(texts))
    ids, offsets = _coder(path).lookup(binary_array(data, at))
    ends = offsets[bounds[1:]]
    with_ends = np.insert(ids, ends, END_ID)
    return with_ends, np.append(0, ends + np.arange(1, len(ends) + 1))


# Planes

def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Transposed and compressed ids; no plane above the highest that an id uses, at least one."""
    high = int(ids.max(initial=0)).bit_length()
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "bit":
        bits = np.unpackbits(np.ascontiguousarray(planes[: -(-high // 8) or 1]), axis=1, bitorder="little")
        bits = bits.reshape(len(bits), len(ids), 8).transpose(0, 2, 1).reshape(8 * len(bits), len(ids))
        planes = np.packbits(bits[: high or 1], axis=1, bitorder="little")
    else:
        planes = planes[: -(-high // 8) or 1]
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    return [squeeze(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    """The ids of a block."""
    expand = zstandard.ZstdDecompressor().decompress
    rows = np.array([np.frombuffer(expand(p), np.uint8) for p in planes])
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        rows = np.concatenate([rows, np.zeros((-len(rows) % 8, n), np.uint8)]).reshape(-1, 8, n)
        rows = np.packbits(rows, axis=1, bitorder="little").reshape(-1, n)
    out = np.zeros((n, 4), np.uint8)
    out[:, : len(rows)] = rows.T
    return out.reshape(-1).view("<u4")


# Writing and reading

def _batch(part: int, number: int, first: int, ids: np.ndarray, pieces: list[tuple], kind: str) -> pa.RecordBatch:
    named = [dict(zip(("row", "doc_id", "piece", "n"), p, strict=True)) for p in pieces]
    values = [[part], [number], [first], [len(ids)], [to_planes(ids, kind)], [named]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)


def _writer(path: str, kind: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first, row = TaskContext.get().partitionId(), 0, 0, 0
        held, size, pieces = [], 0, []
        for batch in batches:
            at = 0
            for block in blocks(batch.column(1), TEXT_BYTES):
                ids, offsets = encode_block(block, path)
                for doc_id, a, b in zip(
                    batch.column(0).slice(at, len(block)).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True
                ):
                    piece = 0
                    while a < b:
                        take = min(b - a, BLOCK_IDS - size)
                        held.append(ids[a : a + take])
                        pieces.append((row, doc_id, piece, take))
                        a, size, piece = a + take, size + take, piece + 1
                        if size == BLOCK_IDS:
                            yield _batch(part, number, first, np.concatenate(held), pieces, kind)
                            number, first = number + 1, first + size
                            held, size, pieces = [], 0, []
                    row += 1
                at += len(block)
        if size:
            yield _batch(part, number, first, np.concatenate(held), pieces, kind)

    return write


def write_ids(docs: DataFrame, folder: str, path: str | None = None, kind: str = "byte") -> None:
    """Encode ``docs`` (doc_id, text) and store the ids in ascending order of doc_id. ``kind``: byte or bit planes."""
    path = path or tokenizer_path(VOCABULARY)
    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(_writer(path, kind), _BLOCK_DDL).write.option("compression", "none").parquet(f"{folder}/blocks")
    stored = docs.sparkSession.read.parquet(f"{folder}/blocks")
    sizes = stored.select("part", "block", "first", "n", F.transform("planes", F.length).alias("plane_bytes"))
    parts = stored.groupBy("part").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    index = sizes.join(parts, "part").select(
        "part", "block", (F.col("before") + F.col("first")).alias("start"), "n", "plane_bytes"
    )
    index.write.parquet(f"{folder}/index")


def _reader(kind: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part, start, n, planes, pieces in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packed, at = from_planes(planes, n, kind).tobytes(), 0
                for p in pieces:
                    to = at + p["n"]
                    out.append((part, p["row"], p["doc_id"], p["piece"], start + at, p["n"], zlib.crc32(packed[4 * at : 4 * to])))
                    at = to
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), _READ_TYPES, strict=True)], names=_READ_NAMES
            ) if out else pa.RecordBatch.from_arrays([pa.array([], t) for t in _READ_TYPES], names=_READ_NAMES)

    return read


_READ_NAMES = ["part", "row", "doc_id", "piece", "start", "n", "crc"]
_READ_TYPES = [pa.int32(), *[pa.int64()] * 6]


def _joined_crc(pieces: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The checksum of a document from those of its pieces in order."""
    for lists in pieces:
        out = []
        for row in lists.to_pylist():
            crc = row[0]["crc"]
            for p in row[1:]:
                zeros = bytes(4 * p["n"])
                crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ p["crc"]
            out.append(crc)
        yield pa.array(out, pa.int64())


def read_documents(spark: SparkSession, folder: str, kind: str = "byte") -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. Blocks are read in any order.

    An index of up to ``BROADCAST_BLOCKS`` rows goes to the blocks, which stay where they are read.
    """
    stored = spark.read.parquet(f"{folder}/blocks").select("part", "block", "n", "planes", "pieces")
    index = spark.read.parquet(f"{folder}/index").select("part", "block", "start")
    if index.count() <= BROADCAST_BLOCKS:
        index = F.broadcast(index)
    pieces = stored.join(index, ["part", "block"]).select("part", "start", "n", "planes", "pieces").mapInArrow(
        _reader(kind), "part int, row long, doc_id long, piece long, start long, n long, crc long"
    )
    whole = pieces.groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("pieces"),
    )
    crc = F.arrow_udf(_joined_crc, "long")(F.col("pieces"))
    return whole.select("doc_id", "start", "n_tokens", crc.alias("ids_crc32"))


def store_and_read(docs: DataFrame, path: str | None = None, kind: str = "byte") -> DataFrame:
    """Write the ids under the shared folder and read the documents back from the files."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "ids")
    write_ids(docs, folder, path, kind)
    return read_documents(spark, folder, kind)
