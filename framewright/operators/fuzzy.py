"""Misspelling reports over distinct labels.

Labels are first made distinct, so a frequent label costs as much as a rare one.  Pieces of labels are found by an
equi-join; scores are compared block by block, where the lengths and letters of two labels allow a score that counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def token_sort(c: Column) -> Column:
    """Lower case, anything but letters and digits a blank, words in order."""
    words = F.split(F.trim(F.regexp_replace(F.lower(c), "[^\\p{L}\\p{N}]+", " ")), " ")
    return F.array_join(F.array_sort(words), " ")


def contained_pairs(df: DataFrame, label: str) -> DataFrame:
    """Pairs of distinct labels one of whose sorted words hold the other's as a piece: columns first_label, second_label.

    The shorter one's longest word is a piece of some word of the longer one, so they meet in an equi-join of that
    word's first three letters with the pieces of up to three letters of the longer one.
    """
    base = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("x")).distinct().withColumn("s", token_sort(F.col("x"))).filter("s <> ''")
    word = F.element_at(F.array_sort(F.transform(F.split("s", " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))), -1)
    short = base.select("x", "s", F.substring(word["w"], 1, 3).alias("k"))
    starts = F.sequence(F.lit(1), F.length("s"))
    pieces = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.substring(F.col("s"), i, n)))))
    long = base.select(F.col("x").alias("y"), F.col("s").alias("t"), F.explode(pieces).alias("k"))
    hit = short.join(long, "k").filter("x <> y and length(s) <= length(t) and contains(t, s)")
    return hit.select(F.least("x", "y").alias("first_label"), F.greatest("x", "y").alias("second_label")).distinct()


def _label_blocks(block: int):
    """Rows (label), shortest first, to one row per ``block``: shortest and longest length, and the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels: list[str] = []
        for b in batches:
            labels += b.column(0).to_pylist()
        cuts = [labels[i : i + block] for i in range(0, len(labels), block)]
        sizes = [[len(x) for x in c] for c in cuts]
        cols = [pa.array([min(n) for n in sizes], pa.int64()), pa.array([max(n) for n in sizes], pa.int64()), pa.array(cuts, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(cols, names=["lo", "hi", "labels"])

    return run


def _letters(labels: list[str]) -> np.ndarray:
    """How often each of 64 classes of characters stands in each label."""
    row = np.repeat(np.arange(len(labels)), [len(x) for x in labels])
    code = np.array([ord(c) & 63 for x in labels for c in x], np.int64)
    return np.bincount(row * 64 + code, minlength=len(labels) * 64).reshape(-1, 64)


def _closest(least: float):
    """Of each label of the first block the best other one in the second that scores more than ``least``.

    No label can score more than the letters that both hold allow; so the others are tried in the order of that bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from difflib import SequenceMatcher

        for b in batches:
            rows = []
            for xs, ys in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held, sizes = _letters(ys), np.array([len(y) for y in ys])
                m = SequenceMatcher(autojunk=False)
                for x, mine in zip(xs, _letters(xs), strict=True):
                    # A hundredth more than the bound, as scores are rounded.
                    bound = 200.0 * np.minimum(held, mine).sum(1) / (sizes + len(x)) + 0.01
                    best: tuple[float, str] | None = None
                    near = np.flatnonzero(bound > least)
                    m.set_seq2(x)
                    for i in near[np.argsort(-bound[near], kind="stable")]:
                        if best is not None and bound[i] < -best[0]:
                            break
                        if ys[i] == x:
                            continue
                        m.set_seq1(ys[i])
                        score = round(m.ratio() * 100, 3)
                        if score > least and (best is None or (-score, ys[i]) < best):
                            best = (-score, ys[i])
                    if best is not None:
                        rows.append((x, best[1], -best[0]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.float64()), strict=True)], names=["x", "y", "score"])

    return run


def clean_label(c: Column) -> Column:
    """Without digits, underscores and double blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[0-9_]+", ""), " {2,}", " "))


def likely_misspellings(df: DataFrame, label: str, apart: float, block: int = 2048) -> DataFrame:
    """Labels whose two best scores among all labels differ by more than 0 and less than ``apart``.

    A label's best is itself, with 100; the second is the best of all others, the smaller one where they tie.  Labels
    that are alike once they are cleaned are one.  Exact: labels are packed into blocks by length, and each block meets
    each block whose lengths allow such a score.  Columns label, best, second, best_score, second_score.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = df.filter(F.col(label).isNotNull()).select(clean_label(F.col(label)).alias("x")).filter("x <> ''").distinct()
    sized = base.repartitionByRange(n, F.length("x"), "x").sortWithinPartitions(F.length("x"), "x")
    blocks = sized.mapInArrow(_label_blocks(block), "lo bigint, hi bigint, labels array<string>")
    other = blocks.withColumnsRenamed({"lo": "lo2", "hi": "hi2", "labels": "labels2"})
    least = 100 - apart
    near = (200 * F.col("hi") >= least * (F.col("hi") + F.col("lo2"))) & (200 * F.col("hi2") >= least * (F.col("hi2") + F.col("lo")))
    scored = blocks.crossJoin(other).filter(near).select("labels", "labels2").repartition(n).mapInArrow(_closest(least), "x string, y string, score double")
    top = scored.groupBy("x").agg(F.min(F.struct((-F.col("score")).alias("s"), "y")).alias("t")).filter("t.s > -100")
    return top.select(F.col("x").alias("label"), F.col("x").alias("best"), F.col("t.y").alias("second"), F.lit(100.0).alias("best_score"), (-F.col("t.s")).alias("second_score"))
