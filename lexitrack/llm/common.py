"""What several operators of this package share: reading, the held-out split, and blocks of text inside tasks."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once.
BLOCK_BYTES = 4 << 20


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package. On a cluster it is installed or sent along."""
    if spark.sparkContext.master.startswith("local"):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        known = [p for p in spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *(p for p in known if p != root)])


def tidy() -> None:
    """Give freed memory back to the machine: workers live on between tasks and share it with the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim  # glibc
except (AttributeError, OSError):
    _trim = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id; a missing id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers, below ``TOKENIZERS_DIR`` if that is set."""
    root = os.environ.get("TOKENIZERS_DIR")
    if root:
        return os.path.join(root, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of a text column of about ``limit`` bytes, at least one row each; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield texts.slice(at, to - at)
        at = to


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a block without nulls, and the n + 1 offsets of its texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def code_points(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes as an array of code points."""
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)


def ragged_take(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``rows`` of a ragged array one after the other, and the n + 1 offsets of the result."""
    lengths = offsets[rows + 1] - offsets[rows]
    out = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return values[np.repeat(offsets[rows] - out[:-1], lengths) + np.arange(out[-1])], out


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i + 1]], 0 for an empty segment. Equal segments give equal sums."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


class SliceCache:
    """Token ids of byte strings met before, as one ragged array; ``encode`` gives those of new ones.

    Strings are known by two 64-bit hashes, so a known string takes some forty bytes. With more than ``limit`` strings those
    that were not met again since the last time are forgotten, so a worker's memory stays bounded.
    """

    def __init__(self, encode, limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self._keep(np.zeros(0, np.int64))

    def _keep(self, kept: np.ndarray) -> None:
        """Forget all but the entries ``kept``, in the order of their keys."""
        if not len(kept):
            self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            self.at, self.met = np.zeros(0, np.int64), np.zeros(0, bool)
            self.ids, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)
            return
        self.key, self.check = self.key[kept], self.check[kept]
        self.ids, self.offsets = ragged_take(self.ids, self.offsets, self.at[kept])
        self.at, self.met = np.arange(len(kept)), np.zeros(len(kept), bool)

    def _find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys among the known ones, and whether they are known."""
        place = np.searchsorted(self.key, key)
        near = np.minimum(place, len(self.key) - 1)
        known = (self.key[near] == key) & (self.check[near] == check) if len(self.key) else np.zeros(len(key), bool)
        return place, known

    def lookup(self, slices: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices one after the other, and the n + 1 offsets."""
        coded = slices.dictionary_encode()
        words = coded.dictionary
        key, check = string_hashes(words)
        place, known = self._find(key, check)
        if len(self.key) + int((~known).sum()) > self.limit:
            self.met[place[known]] = True
            met = np.flatnonzero(self.met)
            self._keep(met if 2 * len(met) <= self.limit else met[:0])
            place, known = self._find(key, check)
        self.met[place[known]] = True
        number = np.empty(len(key), np.int64)
        number[known] = self.at[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(key[new], kind="stable")]
            ids, lengths = self.encode(byte_strings(words.take(pa.array(new))))
            number[new] = len(self.offsets) - 1 + np.arange(len(new))
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths, dtype=np.int64)])
            self.ids = np.concatenate([self.ids, np.asarray(ids, np.uint32)])
            at = place[new]
            self.key, self.check = np.insert(self.key, at, key[new]), np.insert(self.check, at, check[new])
            self.at, self.met = np.insert(self.at, at, number[new]), np.insert(self.met, at, False)
        return ragged_take(self.ids, self.offsets, number[coded.indices.to_numpy(zero_copy_only=False)])


def byte_strings(strings: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls."""
    ends = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].tolist()
    data = strings.buffers()[2].to_pybytes() if strings.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Byte strings data[offsets[i]:offsets[i + 1]] without a copy."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


# Hashed strings

def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_PIECE = 1 << 16  # bytes summed at once


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for one piece."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(_PIECE + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, out=p))
    return tuple(out)


def power(n: np.ndarray) -> np.ndarray:
    """base^n, modulo 2^64."""
    up, _ = _powers()
    if not len(n) or n.max() < _PIECE:
        return up[n]
    high = n // _PIECE
    big = np.array([pow(_BASE, _PIECE * k, 1 << 64) for k in range(int(high.max()) + 1)], np.uint64)
    return up[n % _PIECE] * big[high]


@cache
def byte_codes(seed: int = 1, small: bool = False) -> np.ndarray:
    """A number for each byte; ``small``: A-Z as a-z."""
    codes = mix(np.arange(seed, seed + 256, dtype=np.uint64) * np.uint64(_BASE))
    if small:
        codes[65:91] = codes[97:123]
    return codes


def suffix_sums(data: np.ndarray, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """s(i) = sum over j >= i of code(j) * base^(j - i), modulo 2^64, at the ascending places ``at`` of up to len(data).

    A substring's hash is s(start) - base^length * s(end). Pieces are summed from the end, so a very long text takes no
    more memory than its places.
    """
    up, down = _powers()
    out = np.zeros(len(at), np.uint64)
    carry = np.zeros(1, np.uint64)
    for end in range(len(data), 0, -_PIECE):
        start = max(0, end - _PIECE)
        m = end - start
        total = np.cumsum((codes[data[start:end]] * up[:m])[::-1])[::-1]
        own = slice(*np.searchsorted(at, [start, end]))
        k = at[own] - start
        out[own] = total[k] * down[k] + carry * up[m - k]
        carry = total[:1] + carry * up[m]
    return out


def string_hashes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every value of a binary array without nulls."""
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8)[: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    out = []
    for seed in (1, 1000):
        sums = suffix_sums(data, offsets, byte_codes(seed))
        out.append(mix(sums[:-1] - power(lengths) * sums[1:] + lengths.astype(np.uint64)))
    return out[0], out[1]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, A-Z as a-z, cut at ASCII white space; and the n + 1 offsets of texts in them."""
    data, offsets = raw(texts)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first = ~blank
    first[1:] &= blank[:-1]
    first[text_starts] = ~blank[text_starts]
    last = ~blank
    last[:-1] &= blank[1:]
    last[text_starts[1:] - 1] = ~blank[text_starts[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = suffix_sums(data, np.stack([starts, ends], 1).reshape(-1), byte_codes(small=True)).reshape(-1, 2)
    lengths = ends - starts
    words = mix(sums[:, 0] - power(lengths) * sums[:, 1] + lengths.astype(np.uint64))
    bounds = np.searchsorted(starts, offsets)
    return words, bounds
