"""Encoding texts with a public byte-level BPE vocabulary.

A text is split by the vocabulary's pattern, and each distinct piece is encoded once per worker while it stays in a
bounded cache.  A piece's bytes are the leaves of a segment tree that holds, for each stretch of positions, the smallest
``rank << bits | position``: its root is the leftmost pair of lowest rank.  A merge changes the leaves of the pair and of
its two live neighbours, and their ancestors, so a piece of n bytes takes O(n log n).  Pieces of up to 64 bytes go
through the tree many at a time, one merge each per step; longer ones one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary files are; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a text is split into pieces.  Fixed value: the pattern that the vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a worker's cache holds before it is emptied, and the longest piece that is kept there.
CACHED, CACHED_CHARS = 200_000, 64
#: Characters that are split and encoded together.
AT_ONCE = 400_000

_NONE = np.int64(1 << 62)
_WIDTHS = (8, 16, 32, 64)


class Vocabulary:
    """Byte and pair ranks of a byte-level BPE; a pair's rank is the id of the merged token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << 24 | b] = rank
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        self._bits = max(4, int(len(keys) * 3).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, -1, np.int64)
        values = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        slot = self._slot(keys)
        while len(keys):  # open addressing, all keys a round
            free = self._keys[slot] == -1
            self._keys[slot[free]] = keys[free]
            placed = self._keys[slot] == keys
            self._ranks[slot[placed]] = values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or -1."""
        keys = a << 24 | b
        slot = self._slot(keys)
        out = np.where(self._keys[slot] == keys, self._ranks[slot], -1)
        open_ = np.flatnonzero((self._keys[slot] != keys) & (self._keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self._bits) - 1)
            got = self._keys[slot[open_]]
            hit = got == keys[open_]
            out[open_[hit]] = self._ranks[slot[open_[hit]]]
            open_ = open_[~hit & (got != -1)]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece of any length."""
        n = len(piece)
        ids = [int(self.byte_ids[b]) for b in piece]
        if n < 2:
            return ids
        size = 1 << (n - 1).bit_length()
        bits, none, pairs = size.bit_length(), int(_NONE), self.pairs
        tree = [none] * (2 * size)
        for i in range(n - 1):
            r = pairs.get(ids[i] << 24 | ids[i + 1])
            if r is not None:
                tree[size + i] = r << bits | i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(i: int, v: int) -> None:
            i += size
            tree[i] = v
            i >>= 1
            while i:
                least = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == least:
                    return
                tree[i] = least
                i >>= 1

        while tree[1] != none:
            at, rank = tree[1] & ((1 << bits) - 1), tree[1] >> bits
            gone = after[at]
            ids[at] = rank
            after[at] = far = after[gone]
            put(gone, none)
            if far < n:
                before[far] = at
                r = pairs.get(rank << 24 | ids[far])
                put(at, none if r is None else r << bits | at)
            else:
                put(at, none)
            prior = before[at]
            if prior >= 0:
                r = pairs.get(ids[prior] << 24 | rank)
                put(prior, none if r is None else r << bits | prior)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of many pieces: one tree each, all trees together as the columns of one array."""
        out: list[list[int] | None] = [None] * len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(length > _WIDTHS[-1]).tolist():
            out[i] = self.encode_piece(pieces[i])
        least = 0
        for width in _WIDTHS:
            which = np.flatnonzero((length > least) & (length <= width))
            least = width
            if len(which):
                for i, ids in zip(which.tolist(), self._together([pieces[i] for i in which.tolist()], width), strict=True):
                    out[i] = ids
        return [x if x is not None else [] for x in out]

    def _together(self, pieces: list[bytes], width: int) -> list[list[int]]:
        m, bits = len(pieces), width.bit_length()
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width).T
        size = np.fromiter(map(len, pieces), np.int64, m)
        col = np.arange(m)
        # Row ``width`` stands for "no neighbour" at either side.
        ids = np.concatenate([self.byte_ids[raw], np.zeros((1, m), np.int64)])
        position = np.arange(width)[:, None]
        after = np.concatenate([np.where(position + 1 < size, position + 1, width), np.full((1, m), width)])
        before = np.concatenate([np.where(position > 0, position - 1, width) + np.zeros((1, m), np.int64), np.full((1, m), width)])
        tree = np.full((2 * width, m), _NONE)
        rank = self.pair_ranks(ids[: width - 1].ravel(), ids[1:width].ravel()).reshape(width - 1, m)
        here = position[: width - 1]
        tree[width : 2 * width - 1] = np.where((rank >= 0) & (here + 1 < size), rank << bits | here, _NONE)
        for i in range(width - 1, 0, -1):
            np.minimum(tree[2 * i], tree[2 * i + 1], out=tree[i])

        def put(at: np.ndarray, c: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[node, c] = value
            node = node >> 1
            while len(node) and node[0]:
                tree[node, c] = np.minimum(tree[2 * node, c], tree[2 * node + 1, c])
                node = node >> 1

        while True:
            root = tree[1]
            c = col[root < _NONE]
            if not len(c):
                break
            at, new = root[c] & ((1 << bits) - 1), root[c] >> bits
            gone = after[at, c]
            far, prior = after[gone, c], before[at, c]
            ids[at, c], after[at, c], before[far, c] = new, far, at
            after[gone, c] = -1  # gone for good
            none = np.full(len(c), _NONE)
            put(gone, c, none)
            r = self.pair_ranks(new, ids[far, c])
            put(at, c, np.where((far < width) & (r >= 0), r << bits | at, none))
            some = prior < width
            p, cs = prior[some], c[some]
            r = self.pair_ranks(ids[p, cs], new[some])
            put(p, cs, np.where(r >= 0, r << bits | p, _NONE))
        live = (after[:width] >= 0) & (position < size)
        flat, counts = ids[:width].T[live.T].tolist(), live.sum(axis=0).tolist()
        out, i = [], 0
        for n in counts:
            out.append(flat[i : i + n])
            i += n
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


class Encoder:
    """Texts to ids, with a bounded cache of pieces."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        self.vocabulary = vocabulary(path)
        self.split = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def _learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        ranks, out, rest = self.vocabulary.ranks, {}, []
        for p in pieces:
            b = p.encode("utf-8", "surrogatepass")
            r = ranks.get(b)
            if r is None:
                rest.append((p, b))
            else:
                out[p] = (r,)
        for (p, _), ids in zip(rest, self.vocabulary.encode_pieces([b for _, b in rest]), strict=True):
            out[p] = tuple(ids)
        return out

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        """One list per text, in order; an empty or null text gives an empty list."""
        at, n = 0, 0
        for i, t in enumerate(texts):
            n += len(t or "")
            if n >= AT_ONCE or i == len(texts) - 1:
                yield from self._encode(texts[at : i + 1])
                at, n = i + 1, 0

    def _encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        split = [self.split(t) if t else [] for t in texts]
        if len(self.cache) > CACHED:
            self.cache.clear()
        new = set().union(*split).difference(self.cache)
        learnt = self._learn(new)
        long = {p: v for p, v in learnt.items() if len(p) > CACHED_CHARS}
        self.cache.update(learnt)
        get = self.cache.__getitem__
        for pieces in split:
            yield list(chain.from_iterable(map(get, pieces)))
        for p in long:
            del self.cache[p]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode_corpus(docs: DataFrame, key: str, text: str, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Columns ``key`` and ids (array of int) of every row of ``docs``, without special tokens.

    Strings that name special tokens are ordinary text.  An empty or null text gives an empty list; repeated and null
    keys stay as they are; other columns aren't read.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            flat: list[int] = []
            offsets = [0]
            rows = 0
            keys = b.column(0)

            def out(upto: int, n: int, flat: list[int], offsets: list[int], keys=keys) -> pa.RecordBatch:
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(flat, np.int32)))
                return pa.RecordBatch.from_arrays([keys.slice(upto - n, n), ids], names=["key", "ids"])

            for ids in enc.encode(b.column(1).to_pylist()):
                flat += ids
                offsets.append(len(flat))
                rows += 1
                if len(flat) > 2_000_000:
                    yield out(rows, len(offsets) - 1, flat, offsets)
                    flat, offsets = [], [0]
            yield out(rows, len(offsets) - 1, flat, offsets)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
