"""Evaluation texts leaking into a corpus.

Both sides are winnowed: of each ``WINDOW`` consecutive hashes of ``GRAM`` words the smallest is kept, so any ``WORDS``
words in common hold a hash that both sides kept.  Hashes that meet are joined, and each meeting point is extended to
both sides over the words themselves; only stretches of ``WORDS`` or more count.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.hashing import gram_hashes, window_minima

WORDS, GRAM = 12, 8
WINDOW = WORDS - GRAM + 1
#: Characters of evaluation text up to which its fingerprints go to every task; more are joined by a shuffle.
SENT_CHARS = 16 << 20
#: Words whose hashes a worker remembers.
CACHED = 400_000
AT_ONCE = 400_000

_WORD = re.compile(r"[^\W_]+").findall


def words_of(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, after NFKC and without case."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return _WORD(text)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHED:
            self.clear()
        v = self[word] = xxhash.xxh64_intdigest(word)
        return v


_HASHES = _Hashes()


def _hash_words(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def common_words(a: list[str], i: int, b: list[str], j: int, enough: int) -> bool:
    """Whether the stretch that goes through a[i] and b[j] has ``enough`` words in common."""
    if a[i] != b[j]:
        return False
    n, x, y = 1, i + 1, j + 1
    while n < enough and x < len(a) and y < len(b) and a[x] == b[y]:
        n, x, y = n + 1, x + 1, y + 1
    x, y = i - 1, j - 1
    while n < enough and x >= 0 and y >= 0 and a[x] == b[y]:
        n, x, y = n + 1, x - 1, y - 1
    return n >= enough


def fingerprints(words: list[str], gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions."""
    h = gram_hashes(_hash_words(words), gram)
    at = window_minima(h, window)
    return h[at], at


class _Items:
    """The evaluation items with an index of their fingerprints."""

    def __init__(self, items: list[tuple], gram: int, window: int):
        self.words, self.at = [], defaultdict(list)
        self.ids = [k for k, _ in items]
        for n, (_, text) in enumerate(items):
            w = words_of(text)
            self.words.append(w)
            if len(w) >= gram + window - 1:
                for h, p in zip(*(x.tolist() for x in fingerprints(w, gram, window)), strict=True):
                    self.at[h].append((n, p))
        self.hashes = np.sort(np.fromiter(self.at, np.uint64, len(self.at)))

    def hits(self, words: list[str], hashes: np.ndarray, positions: np.ndarray, enough: int) -> set[int]:
        found: set[int] = set()
        for h, i in zip(hashes.tolist(), positions.tolist(), strict=True):
            for n, j in self.at[h]:
                if n not in found and common_words(words, i, self.words[n], j, enough):
                    found.add(n)
        return found


def _scan(items: list[tuple], gram: int, window: int):
    enough = gram + window - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Items(items, gram, window)
        ids = pa.array(known.ids)
        for b in batches:
            docs, found = [], []
            texts = b.column(1).to_pylist()
            at, n = 0, 0
            for i, t in enumerate(texts):
                n += len(t or "")
                if n < AT_ONCE and i < len(texts) - 1:
                    continue
                split = [words_of(x) for x in texts[at : i + 1]]
                whole = [w for ws in split for w in ws]
                # Grams over the border of two texts do no harm: what meets is compared word by word within one text.
                h, p = fingerprints(whole, gram, window)
                if len(known.hashes):
                    k = np.minimum(np.searchsorted(known.hashes, h), len(known.hashes) - 1)
                    hit = np.flatnonzero(known.hashes[k] == h)
                    ends = np.cumsum([len(ws) for ws in split])
                    doc = np.searchsorted(ends, p[hit], "right")
                    for d in np.unique(doc).tolist():
                        mine = hit[doc == d]
                        start = int(ends[d]) - len(split[d])
                        for x in known.hits(split[d], h[mine], p[mine] - start, enough):
                            docs.append(at + d)
                            found.append(x)
                at, n = i + 1, 0
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(docs, pa.int64())), ids.take(pa.array(found, pa.int64()))], names=["d", "i"])

    return run


def _prints(gram: int, window: int):
    """(key, text's digest, text) to (key, digest, hash), each kept hash once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, hashes = [], []
            for n, t in enumerate(b.column(2).to_pylist()):
                w = words_of(t)
                if len(w) >= gram + window - 1:
                    h = np.unique(fingerprints(w, gram, window)[0])
                    rows += [n] * len(h)
                    hashes.append(h.view(np.int64))
            h = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(h)], names=["k", "x", "h"])

    return run


def _verify(gram: int, window: int):
    """Rows (d, i, times, a, b) whose texts a and b have the words in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for n, (t, x) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                one = _Items([(0, x)], gram, window)
                w = words_of(t)
                h, p = fingerprints(w, gram, window)
                mine = np.isin(h, one.hashes)
                if one.hits(w, h[mine], p[mine], gram + window - 1):
                    keep.append(n)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([c.take(at) for c in b.columns[:3]], names=["d", "i", "times"])

    return run


def _joined(d: DataFrame, i: DataFrame, d_kind: str, i_kind: str, gram: int, window: int) -> DataFrame:
    """The same where the items are too many to be sent: fingerprints meet in a join.

    A row is known by its key (within a struct, so that a null is a key like others) and its text's digest; rows that
    agree in both agree in what leaks, and are counted.  Only texts with a fingerprint in common are read again.
    """

    def side(t: DataFrame, key: str) -> DataFrame:
        return t.select(F.struct(F.col(key).alias("v")).alias("k"), F.md5("t").alias("x"), "t").filter("t is not null")

    left, right = side(d, "d"), side(i, "i")
    shape = "k struct<v:{}>, x string, h bigint"
    right_prints = right.mapInArrow(_prints(gram, window), shape.format(i_kind)).distinct()
    pairs = left.mapInArrow(_prints(gram, window), shape.format(d_kind)).join(right_prints.withColumnsRenamed({"k": "ik", "x": "ix"}), "h")
    pairs = pairs.select("k", "x", "ik", "ix").distinct()

    def texts(t: DataFrame, key: str, digest: str) -> DataFrame:
        near = pairs.select(F.col(key).alias("k"), F.col(digest).alias("x")).distinct()
        return t.join(near, ["k", "x"], "left_semi").groupBy("k", "x").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t"))

    items = texts(right, "ik", "ix").withColumnsRenamed({"k": "ik", "x": "ix", "n": "m", "t": "b"})
    both = pairs.join(texts(left, "k", "x").withColumnRenamed("t", "a"), ["k", "x"]).join(items, ["ik", "ix"])
    both = both.select(F.col("k.v").alias("d"), F.col("ik.v").alias("i"), (F.col("n") * F.col("m")).alias("times"), "a", "b")
    found = both.mapInArrow(_verify(gram, window), f"d {d_kind}, i {i_kind}, times bigint")
    return found.withColumn("again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select("d", "i")


def leaked(docs: DataFrame, items: DataFrame, doc: str, item: str, text: str = "text", words: int = WORDS, gram: int = GRAM, sent_chars: int = SENT_CHARS) -> DataFrame:
    """Columns ``doc`` and ``item``: each document and item whose texts have at least ``words`` words in a row in common.

    Null and empty texts, and texts of fewer words, have none.  Rows are judged one by one, whatever their keys: a pair
    comes out once for each row of ``docs`` and each of ``items``, keys may be null or come again.  An empty table on
    either side gives no rows; other columns aren't read.  The items' size is measured: up to ``sent_chars`` they are
    sent to the tasks, beyond that they are joined by a shuffle, with the same result.
    """
    window = words - gram + 1
    d_kind, i_kind = docs.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    d = docs.select(F.col(doc).alias("d"), F.col(text).alias("t"))
    i = items.select(F.col(item).alias("i"), F.col(text).alias("t")).filter("t is not null")
    chars = i.agg(F.sum(F.length("t"))).first()[0] or 0
    if chars > sent_chars:
        return _joined(d, i, d_kind, i_kind, gram, window).select(F.col("d").alias(doc), F.col("i").alias(item))
    held = [tuple(r) for r in i.collect()]
    if not held:
        return d.join(i.drop("t"), F.lit(False)).select(F.col("d").alias(doc), F.col("i").alias(item))
    out = d.mapInArrow(_scan(held, gram, window), f"d {d_kind}, i {i_kind}")
    return out.select(F.col("d").alias(doc), F.col("i").alias(item))
