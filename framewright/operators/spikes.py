"""Spikes, stuck and impossible readings per source.

Each source's readings in time order go through an undecimated Haar wavelet.  Runs whose finest detail is zero are
stuck; details beyond the source's own robust scale mark the readings that may be spikes.  Level and spread are the mean
and the standard deviation of what is left without far-off details, and of the marked readings those are spikes that lie
more than ``spread`` of them away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators.ordered import changed, ordered_chunks
from framewright.session import store

#: Levels of the wavelet; the widest filter spans 2 ** LEVELS readings.
LEVELS = 3
#: Robust standard deviations of a detail, and of a reading, beyond which a reading doesn't count as normal.
DETAIL_SIGMAS, LEVEL_SIGMAS = 4.0, 5.0
#: Robust standard deviations of a detail from which a reading in its reach may be a spike: a spike of six stands out by
#: as much even where its neighbours lean its way by four.
MAY_BE = 1.0
#: A normal distribution's median absolute value, in standard deviations.
_MAD = 0.674489750196


def _details(x: np.ndarray, source: np.ndarray, levels: int) -> np.ndarray:
    """Undecimated Haar details of neighbouring sources' readings, one row per level; none goes over a source's ends."""
    n = len(x)
    out = np.full((levels, n), np.nan)
    first, behind = np.searchsorted(source, source, "left"), np.searchsorted(source, source, "right")
    at = np.arange(n)
    for j in range(levels):
        w = 1 << j
        i = np.flatnonzero((at - w >= first) & (at + w <= behind))
        out[j, i] = sum(x[i + k] - x[i - 1 - k] for k in range(w)) / np.sqrt(2 * w)
    return out


def haar_details(x: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Undecimated Haar details, one row per level, each scaled so that white noise keeps its spread.

    ``out[j, i]`` compares the 2**j values from i on with the 2**j before i; where fewer stand on a side it is NaN.
    """
    return _details(x, np.zeros(len(x), np.int64), levels)


def stuck_runs(finest: np.ndarray, at_least: int) -> np.ndarray:
    """True where ``at_least`` or more readings in a row are equal: between them the finest details are all zero."""
    n = len(finest)
    begin = np.flatnonzero(~(finest == 0))
    size = np.diff(np.append(begin, n))
    return np.repeat(size >= at_least, size)


def _judged(x: np.ndarray, source: np.ndarray, lower: float, upper: float, at_least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of different readings in order: impossible, stuck, details per level, and the largest detail that reaches each."""
    with np.errstate(invalid="ignore"):
        bad = ~((x >= lower) & (x <= upper))
        stuck = stuck_runs(_details(x, source, 1)[0], at_least) & ~bad
    fine = np.flatnonzero(~bad)
    detail, reach = np.full((LEVELS, len(x)), np.nan), np.zeros((LEVELS, len(x)))
    detail[:, fine] = _details(x[fine], source[fine], LEVELS)
    for j in range(LEVELS):
        w, d = 1 << j, np.abs(np.nan_to_num(detail[j, fine]))
        padded = np.pad(d, (w - 1, w))
        if len(d):
            reach[j, fine] = np.max([padded[k : k + len(d)] for k in range(2 * w)], axis=0)
    return bad, stuck, detail, reach


def _scan(around: dict, keys: list[str], lower: float, upper: float, at_least: int):
    same_reading = [*keys, "at", "value"]
    halo = max(at_least, 1 << (LEVELS + 1))

    def piece(t: pa.Table, left: list[float], right: list[float]) -> pa.RecordBatch:
        """``left`` are readings of the first source before the rows, ``right`` of the last source behind them."""
        once = changed(t, same_reading)
        at = np.flatnonzero(once)
        source = np.cumsum(changed(t, keys))[at]
        x = np.concatenate([left, t["value"].to_numpy()[at], right]).astype(float)
        source = np.concatenate([[source[0]] * len(left), source, [source[-1]] * len(right)])
        own = slice(len(left), len(x) - len(right))
        of = np.cumsum(once) - 1
        bad, stuck, detail, reach = _judged(x, source, lower, upper, at_least)
        cols = [pa.array(once), pa.array(bad[own][of]), pa.array(stuck[own][of])]
        for j in range(LEVELS):
            d = np.abs(detail[j, own][of])
            cols += [pa.array(d, mask=np.isnan(d)), pa.array(reach[j, own][of])]
        names = ["once", "bad", "stuck", *(f"{c}{j}" for j in range(LEVELS) for c in "dr")]
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in t.columns), *cols], names=[*t.column_names, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, behind = around.get(TaskContext.get().partitionId(), ([], []))

        def of_source(rows: list[dict], t: pa.Table, i: int) -> list[float]:
            key = tuple(t[k][i].as_py() for k in keys)
            return [r["value"] for r in rows if tuple(r[k] for k in keys) == key]

        # A source may go over many batches: only what its neighbours can still reach is kept of it.
        pending: pa.Table | None = None
        left: list[float] | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if pending is None else pa.concat_tables([pending, t])
            if left is None:
                left = of_source(before, t, 0)
            s = int(np.flatnonzero(changed(t, keys))[-1])
            if s:
                yield piece(t.slice(0, s), left, [])
                left, t = [], t.slice(s)
            new = np.flatnonzero(changed(t, same_reading))
            done = len(new) - halo
            if done > halo:
                x = t["value"].to_numpy()[new]
                yield piece(t.slice(0, int(new[done])), left, x[done:].tolist())
                left, t = [*left, *x[:done].tolist()][-halo:], t.slice(int(new[done]))
            pending = t
        if pending is not None:
            yield piece(pending, left, of_source(behind, pending, pending.num_rows - 1))

    return run


def flag_readings(
    df: DataFrame,
    keys: list[str],
    time: str,
    value: str,
    row: str,
    lower: float = 0.0,
    upper: float = 23.026,
    spread: float = 6.0,
    at_least: int = 6,
) -> DataFrame:
    """Columns ``row`` and kind of each faulty reading: the first of impossible, stuck, spike that holds.

    Null readings are skipped.  NaN and infinite readings are impossible.  Rows with the same source, time and value are
    one reading, and each such row is reported.  A null in ``keys`` is a source of its own; readings without a time
    stand first.  Readings at one time are ordered by value.  A source too short or too constant to show a spread has
    no spikes, but any reading that differs from an otherwise constant source is one.
    """
    ks = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(time).alias("at"), F.col(value).cast("double").alias("value"), F.col(row).alias("_row")).filter("value is not null")
    held, around = ordered_chunks(rows, [*ks, "at", "value"], max(at_least, 1 << (LEVELS + 1)))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", once boolean, bad boolean, stuck boolean"
    shape += "".join(f", d{j} double, r{j} double" for j in range(LEVELS))
    # Written down: it is read for the scale, for level and spread, and for the kinds.  Structs are equal where their
    # nulls stand in the same places.
    seen = store(held.mapInArrow(_scan(around, ks, lower, upper, at_least), shape).select(F.struct(*ks).alias("src"), "value", "_row", "once", "bad", "stuck", *(f"{c}{j}" for j in range(LEVELS) for c in "dr")))

    fine = seen.filter("not bad and not stuck")
    robust = [F.percentile_approx(f"d{j}", 0.5, 10000).alias(f"m{j}") for j in range(LEVELS)]
    scale = fine.filter("once").groupBy("src").agg(*robust, F.percentile_approx("value", 0.5, 10000).alias("mid"))

    def beyond(sigmas: float):
        return [F.coalesce(F.col(f"r{j}") > sigmas / _MAD * F.col(f"m{j}"), F.lit(False)) for j in range(LEVELS)]

    # White noise keeps its spread in every detail: the finest one's scale is the readings' own.
    far_off = F.coalesce(F.abs(F.col("value") - F.col("mid")) > LEVEL_SIGMAS / _MAD * F.col("m0"), F.lit(False))
    odd = (F.array_contains(F.array(*beyond(DETAIL_SIGMAS)), True) & F.coalesce(F.col("m0") > 0, F.lit(False))) | far_off
    normal = fine.filter("once").join(scale, "src").filter(~odd)
    stats = scale.join(normal.groupBy("src").agg(F.avg("value").alias("level"), F.stddev_pop("value").alias("sd")), "src", "left")
    may_be = F.array_contains(F.array(*beyond(MAY_BE)), True) | far_off
    off = F.coalesce(F.abs(F.col("value") - F.col("level")) > spread * F.col("sd") + 1e-9, F.lit(False))
    spikes = fine.join(stats, "src").filter(may_be & off).select("_row", F.lit("spike").alias("kind"))
    others = seen.filter("bad or stuck").select("_row", F.when(F.col("bad"), "impossible").otherwise("stuck").alias("kind"))
    return others.unionByName(spikes).select(F.col("_row").alias(row), "kind")
