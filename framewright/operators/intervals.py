"""Continuous periods and gaps of intervals per entity.

An ordered map of disjoint intervals per entity takes the intervals in any order: each insertion finds its overlaps by
binary search and merges them.  The union is associative, so the map runs twice: once where the rows are read (the
smaller result is what gets shuffled), once per entity and stretch of ``BUCKET`` positions.  Intervals are cut at the
bucket borders, so that no task holds more than one bucket of one entity at a time however many rows an entity has; the
few pieces that touch a border are joined again by a window over one row per bucket.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Positions per bucket: a map then holds at most half as many intervals.
BUCKET = 1 << 15
#: Intervals that the maps of one read task hold before they are passed on.
HELD = 200_000


class IntervalMap:
    """Disjoint closed intervals of integers in order; touching ones are one interval."""

    __slots__ = ("ends", "starts")

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []

    def __len__(self) -> int:
        return len(self.starts)

    def add(self, first: int, last: int) -> int:
        """Insert [first, last]; returns by how many intervals the map grew (negative where it shrank)."""
        starts, ends = self.starts, self.ends
        lo = bisect_left(ends, first - 1)  # the first interval that reaches the new one
        hi = bisect_right(starts, last + 1, lo)  # behind the last one that the new one reaches
        if lo == hi:
            starts.insert(lo, first)
            ends.insert(lo, last)
            return 1
        if starts[lo] < first:
            first = starts[lo]
        if ends[hi - 1] > last:
            last = ends[hi - 1]
        starts[lo:hi] = [first]
        ends[lo:hi] = [last]
        return 1 - (hi - lo)

    def gaps(self) -> list[tuple[int, int]]:
        return [(e + 1, s - 1) for e, s in zip(self.ends, self.starts[1:], strict=False)]


def _schema(keys: list[pa.Field]) -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([*keys, pa.field("bucket", pa.int64()), pa.field("starts", longs), pa.field("ends", longs)])


def _emit(maps: dict, schema: pa.Schema) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in schema]
    for key, held in maps.items():
        for c, v in zip(cols, key, strict=False):
            c.append(v)
        cols[-2].append(held.starts)
        cols[-1].append(held.ends)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _read_side(bucket: int, held_most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[tuple, IntervalMap] = {}
        held, schema = 0, None
        for batch in batches:
            schema = schema or _schema([f for f in batch.schema][:-2])
            *keys, firsts, lasts = (c.to_pylist() for c in batch.columns)
            for *key, first, last in zip(*keys, firsts, lasts, strict=True):
                while True:
                    b = first // bucket
                    stop = last if last < (b + 1) * bucket else (b + 1) * bucket - 1
                    at = (*key, b)
                    m = maps.get(at)
                    if m is None:
                        m = maps[at] = IntervalMap()
                    held += m.add(first, stop)
                    if stop == last:
                        break
                    first = stop + 1
                    if held > held_most:
                        yield _emit(maps, schema)
                        maps, held = {}, 0
            if held > held_most:
                yield _emit(maps, schema)
                maps, held = {}, 0
        if maps:
            yield _emit(maps, schema)

    return run


def _merge_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by entity and bucket: one map at a time is held."""
    now, held, schema, done = None, None, None, {}
    for batch in batches:
        schema = schema or batch.schema
        *keys, starts, ends = (c.to_pylist() for c in batch.columns)
        for *key, ss, es in zip(*keys, starts, ends, strict=True):
            at = tuple(key)
            if at != now:
                if now is not None:
                    done[now] = held
                now, held = at, IntervalMap()
                held.starts, held.ends = ss, es
                continue
            for s, e in zip(ss, es, strict=True):
                held.add(s, e)
        if len(done) > 5000:
            yield _emit(done, schema)
            done = {}
    if now is not None:
        done[now] = held
        yield _emit(done, schema)


def periods_and_gaps(df: DataFrame, keys: list[str], first: str, last: str, bucket: int = BUCKET, held: int = HELD) -> DataFrame:
    """Columns ``keys``, kind (``period`` or ``gap``), first, last: both ends inclusive.

    A period is a maximal run of positions each covered by a row of the entity; a gap lies between two neighbouring
    periods.  Left out: rows with a null key, a null end, or ``last < first``.  Repeated, nested and touching rows add
    nothing; an entity with one period has no gap; an empty input gives no rows.  Other columns of ``df`` are not read.
    """
    slim = df.select(*[F.col(k) for k in keys], F.col(first).cast("bigint").alias("_first"), F.col(last).cast("bigint").alias("_last"))
    slim = slim.dropna().filter("_last >= _first")
    fields = ", ".join(f"`{k}` {slim.schema[k].dataType.simpleString()}" for k in keys)
    shape = f"{fields}, bucket bigint, starts array<bigint>, ends array<bigint>"
    entity = [F.col(k) for k in keys]
    local = slim.mapInArrow(_read_side(bucket, held), shape)
    merged = local.repartition(*entity, "bucket").sortWithinPartitions(*keys, "bucket").mapInArrow(_merge_side, shape)

    w = Window.partitionBy(*keys).orderBy("bucket")
    before_end = F.lag(F.element_at("ends", -1)).over(w)
    after_start = F.lead(F.element_at("starts", 1)).over(w)
    rows = merged.withColumns({"before": before_end, "after": after_start})
    joined = F.coalesce(F.col("before") == F.element_at("starts", 1) - 1, F.lit(False))
    goes_on = F.coalesce(F.col("after") == F.element_at("ends", -1) + 1, F.lit(False))
    rows = rows.withColumns({"joined": joined, "goes_on": goes_on})
    # Where the period that is open at the bucket's end began; null while a whole bucket only carries it on.
    tail = F.when(F.col("joined") & (F.size("starts") == 1), None).otherwise(F.element_at("starts", -1))
    rows = rows.withColumn("tail", F.last(tail, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("open_from", F.lag("tail").over(w))

    at = F.posexplode(F.arrays_zip("starts", "ends")).alias("i", "x")
    flat = rows.select(*entity, "before", "joined", "goes_on", "open_from", F.size("starts").alias("n"), F.col("ends").alias("all_ends"), at)
    begin = F.when((F.col("i") == 0) & F.col("joined"), F.col("open_from")).otherwise(F.col("x.starts"))
    prior = F.when(F.col("i") == 0, F.col("before")).otherwise(F.get("all_ends", F.col("i") - 1))
    is_period = ~((F.col("i") == F.col("n") - 1) & F.col("goes_on"))
    is_gap = prior.isNotNull() & (prior + 1 < F.col("x.starts"))

    def row(kind: str, a, b):
        return F.struct(F.lit(kind).alias("kind"), a.cast("bigint").alias("first"), b.cast("bigint").alias("last"))

    both = F.array(F.when(is_period, row("period", begin, F.col("x.ends"))), F.when(is_gap, row("gap", prior + 1, F.col("x.starts") - 1)))
    return flat.select(*entity, F.explode(F.array_compact(both)).alias("r")).select(*entity, "r.kind", "r.first", "r.last")
