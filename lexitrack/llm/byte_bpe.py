"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

No regular expression runs. Every code point gets a class symbol; each symbol is a function from scan state to scan
state, and the functions of a block are composed by an associative scan (within short rows step by step for all rows
at once, then over the rows by doubling), which gives the state before every character and so where slices begin.
The slices feed a cache; those not met before are merged pair by pair, all of a block at once. The byte offsets of
the slices and the ids of each are kept, so ids decode to bytes by a table lookup.

Nulls count as empty texts; an empty text has no ids. Equal texts give equal ids wherever they stand. The length of a
text is bounded by Spark's two gigabytes; memory holds one block (or one text, if that is longer).
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexitrack.llm.common import (
    SliceCache, binary_array, blocks, code_points, ragged_take, raw, tidy, tokenizer_path,
)

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# White space, and the letters and numbers that Unicode 16 added.
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
_NUMBERS_16 = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

# Symbols: other, letter, number, a blank or other space before text, a space before a space or the end,
# apostrophe, one-letter and two-letter contraction; the same again as the first of a text; and one that does nothing.
O, L, N, SP, WL, WM, A, C1, C2, FIRST = range(10)
_IDENTITY = 2 * FIRST
# States: a slice has just ended, or which slice is open.
END, LETTERS, NUMBERS, OTHERS, BLANK, APOSTROPHE, PAIR, SPACES = range(8)
_ROW = 64
#: Texts, and bytes of text, that are encoded at once; their ids go on before the next ones.
_TEXTS, _BLOCK = 1 << 10, 1 << 20


@cache
def _classes() -> np.ndarray:
    """The class of every code point: O, L, N, WM (white space), A, C1."""
    kinds = np.full(0x110000, O, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major in "LN":
            kinds[c] = L if major == "L" else N
    for kind, ranges in ((L, _LETTERS_16), (N, _NUMBERS_16)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[_SPACES] = WM
    kinds[ord("'")] = A
    kinds[[ord(c) for c in "stmd"]] = C1
    return kinds


@cache
def _machine() -> tuple[np.ndarray, np.ndarray]:
    """For symbol * 8 + state: the next state, and whether a slice begins at the symbol."""
    opens = {O: OTHERS, L: LETTERS, N: NUMBERS, SP: BLANK, WL: END, WM: SPACES, A: APOSTROPHE, C1: LETTERS, C2: LETTERS}
    goes_on = {
        LETTERS: {L: LETTERS, C1: LETTERS, C2: LETTERS},
        NUMBERS: {N: NUMBERS},
        OTHERS: {O: OTHERS, A: OTHERS},
        BLANK: {L: LETTERS, C1: LETTERS, C2: LETTERS, N: NUMBERS, O: OTHERS, A: OTHERS},
        APOSTROPHE: {C1: END, C2: PAIR, O: OTHERS, A: OTHERS},
        PAIR: {L: END, C1: END, C2: END},
        SPACES: {WM: SPACES},
        END: {},
    }
    after, begins = np.zeros((19, 8), np.uint8), np.zeros((19, 8), bool)
    for symbol, opened in opens.items():
        for state in range(8):
            stays = goes_on[state].get(symbol)
            after[symbol, state], begins[symbol, state] = (opened, True) if stays is None else (stays, False)
        after[symbol + FIRST], begins[symbol + FIRST] = opened, True
    after[_IDENTITY] = range(8)
    return after.reshape(-1), begins.reshape(-1)


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The symbol of every character; ``firsts`` marks the first ones of texts."""
    kinds = _classes()[points]
    last = np.append(firsts[1:], True)
    space = kinds == WM
    before_text = space & ~last & ~np.append(space[1:], True)
    out = kinds.copy()
    out[before_text] = np.where(points[before_text] == 0x20, SP, WL)
    follows = np.append(points[1:], 0)
    follows[last] = 0
    for pair in ("re", "ve", "ll"):
        out[(points == ord(pair[0])) & (follows == ord(pair[1]))] = C2
    return out + FIRST * firsts.astype(np.uint8)


def slice_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Whether a slice begins at each character."""
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    after, begins = _machine()
    rows = -(-n // _ROW)
    padded = np.full(rows * _ROW, _IDENTITY, np.intp)
    padded[:n] = symbols(points, firsts)
    steps = np.ascontiguousarray(padded.reshape(rows, _ROW).T) * 8
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))  # each row's function: state before -> state after
    for step in steps:
        whole = after[step[:, None] + whole]
    reach = 1
    while reach < rows:  # compose with the functions of the rows before, twice as many each time
        earlier, own = whole[:-reach], whole[reach:]
        whole = np.concatenate([whole[:reach], np.take_along_axis(own, earlier.astype(np.intp), axis=1)])
        reach *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = whole[:-1, END]
    out = np.empty((_ROW, rows), bool)
    for j, step in enumerate(steps):
        at = step + state
        out[j], state = begins[at], after[at]
    return out.T.reshape(-1)[:n]


class Vocabulary:
    """Ranks of byte strings: merges, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        size = max(self.ranks.values()) + 1
        strings = [b""] * size
        for token, rank in self.ranks.items():
            strings[rank] = token
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        self.single = np.array([self.ranks.get(bytes([i]), 0) for i in range(256)], np.int64)
        pairs = {}
        get = self.ranks.get
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], _NONE)

    def encode(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices one after the other, and their counts."""
        long = {i: self.merge_long(s) for i, s in enumerate(slices) if len(s) > _LONG}
        ids, counts = self.merge_all([b"" if i in long else s for i, s in enumerate(slices)])
        if long:
            ends = np.cumsum(counts)
            parts = [long.get(i, ids[e - c : e]) for i, (e, c) in enumerate(zip(ends, counts, strict=True))]
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts

    def merge_all(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pair merging of many slices at once: each round merges the first lowest-ranked pair of every slice."""
        lengths = np.array([len(s) for s in slices], np.int64)
        tokens = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        rows = np.repeat(np.arange(len(slices)), lengths)
        done_rows, done_tokens = [], []
        ranks = np.full(len(tokens), _NONE)
        joined = np.flatnonzero(rows[1:] == rows[:-1])
        ranks[joined] = self.pair_ranks(tokens[joined], tokens[joined + 1])
        while len(tokens):
            starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            sizes = np.diff(np.append(starts, len(rows)))
            lowest = np.minimum.reduceat(ranks, starts)
            open_ = np.repeat(lowest < _NONE, sizes)
            if not open_.all():
                done_rows.append(rows[~open_])
                done_tokens.append(tokens[~open_])
                lowest, sizes = lowest[lowest < _NONE], sizes[lowest < _NONE]
                tokens, rows, ranks = tokens[open_], rows[open_], ranks[open_]
                if not len(tokens):
                    break
            hits = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            hits = hits[np.append(True, rows[hits[1:]] != rows[hits[:-1]])]
            tokens[hits] = ranks[hits]
            kept = np.ones(len(tokens), bool)
            kept[hits + 1] = False
            ranks[hits] = ranks[hits + 1]  # a pair with the next token, or none
            hits -= np.arange(len(hits))
            tokens, rows, ranks = tokens[kept], rows[kept], ranks[kept]
            again = hits[ranks[hits] < _NONE]  # stale ranks of known pairs
            near = np.concatenate([hits, hits - 1])
            near = near[(near >= 0) & (near + 1 < len(tokens))]
            near = near[rows[near] == rows[near + 1]]
            ranks[again] = _NONE
            ranks[near] = self.pair_ranks(tokens[near], tokens[near + 1])
        if not done_rows:
            return np.zeros(0, np.uint32), lengths
        rows, tokens = np.concatenate(done_rows), np.concatenate(done_tokens)
        order = np.argsort(rows, kind="stable")
        return tokens[order].astype(np.uint32), np.bincount(rows, minlength=len(slices))

    def merge_long(self, text: bytes) -> np.ndarray:
        """Pair merging of one long slice with a heap of pairs, in n log n."""
        tokens = self.single[np.frombuffer(text, np.uint8)]
        ranks = self.pair_ranks(tokens[:-1], tokens[1:])
        heap = [(int(ranks[i]), int(i)) for i in np.flatnonzero(ranks < _NONE)]
        heapq.heapify(heap)
        table = self._pair_table()
        n = len(tokens)
        ids = tokens.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or table.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := table.get(rank << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := table.get(ids[h] << 32 | rank)) is not None:
                heapq.heappush(heap, (new, h))
        return np.array([t for t in ids if t >= 0], np.uint32)

    @cache  # noqa: B019 one vocabulary for the life of a worker
    def _pair_table(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))


_NONE = np.int64(1 << 40)
_LONG = 200


@cache
def _coder(path: str) -> tuple[Vocabulary, SliceCache]:
    vocabulary = Vocabulary(path)
    return vocabulary, SliceCache(vocabulary.encode)


def encode_block(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: the ids, the n + 1 offsets of texts in them, and for each slice its first byte and id."""
    _, known = _coder(path)
    data, offsets = raw(texts)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    firsts = np.zeros(len(leads), bool)
    firsts[np.searchsorted(leads, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
    starts = leads[slice_starts(code_points(data), firsts)]
    ids, at = known.lookup(binary_array(data, np.append(starts, len(data))))
    return ids, at[np.searchsorted(starts, offsets)], starts, at[:-1]


def decode(ids: np.ndarray, offsets: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of lists of ids, and the n + 1 offsets of the lists in them."""
    vocabulary, _ = _coder(path)
    data, at = ragged_take(vocabulary.bytes, vocabulary.offsets, ids.astype(np.int64))
    return data, at[offsets]


def id_lists(batches: Iterator[pa.Array], path: str) -> Iterator[pa.Array]:
    """The ids of every text, block by block: no batch's ids are held together."""
    for batch in batches:
        for begin in range(0, len(batch), _TEXTS):
            for block in blocks(batch.slice(begin, _TEXTS), _BLOCK):
                ids, at, _, _ = encode_block(block, path)
                yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
        tidy()


def encode(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """The rows with ``out``: array of ids of the text. A column of that name is replaced."""
    path = path or tokenizer_path(VOCABULARY)

    def arrays(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from id_lists(texts, path)

    return docs.withColumn(out, F.arrow_udf(arrays, "array<int>").asNondeterministic()(F.col(text)))


def decode_ids(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with ``out``: the bytes that a column of id arrays stands for; a null has none."""
    path = path or tokenizer_path(VOCABULARY)

    def strings(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in columns:
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            data, at = decode(flat, offsets, path)
            yield binary_array(data, at)

    return rows.withColumn(out, F.arrow_udf(strings, "binary").asNondeterministic()(F.col(ids)))


_DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "bpe") -> DataFrame:
    """The rows with ``out``: how many ids the text has, and digests of the ids and of the bytes they decode to.

    Encoding and decoding happen in one pass; the ids of a block never leave the task.
    """
    path = path or tokenizer_path(VOCABULARY)

    def digests(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            counts, ids_sha, text_sha = [], [], []
            for block in blocks(batch):
                ids, at, _, _ = encode_block(block, path)
                packed, ids_at = ids.astype("<u4").tobytes(), (at * 4).tolist()
                data, data_at = decode(ids, at, path)
                decoded, data_at = data.tobytes(), data_at.tolist()
                counts += np.diff(at).tolist()
                for i in range(len(block)):
                    ids_sha.append(hashlib.sha256(packed[ids_at[i] : ids_at[i + 1]]).hexdigest())
                    text_sha.append(hashlib.sha256(decoded[data_at[i] : data_at[i + 1]]).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.withColumn(out, F.arrow_udf(digests, _DIGEST).asNondeterministic()(F.col(text)))
