"""Operators on one long order, without one task per key.

``ordered_chunks`` sorts the rows over range partitions (a key with very many rows simply spans several), writes them to
the checkpoint folder so that the partitions are fixed, and fetches the first and last rows of each partition.  What an
operator has to know of its neighbours' rows is then at most ``2 * halo`` rows per partition, whatever the data's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.session import cut


def changed(batch: pa.RecordBatch | pa.Table, by: list[str]) -> np.ndarray:
    """True where a row differs from the one before it in one of the columns; nulls, and NaNs, are equal."""
    n = batch.num_rows
    out = np.ones(n, bool)
    if n < 2:
        return out
    out[1:] = False
    for c in by:
        col = batch.column(c)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        if pa.types.is_struct(col.type):
            out[1:] |= changed(pa.RecordBatch.from_arrays([f for f in col.flatten()], names=[str(i) for i in range(col.type.num_fields)]), [str(i) for i in range(col.type.num_fields)])[1:]
            continue
        a, b = col.slice(0, n - 1), col.slice(1)
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null(nan_is_null=True).to_numpy(zero_copy_only=False) & b.is_null(nan_is_null=True).to_numpy(zero_copy_only=False))
        out[1:] |= ~same
    return out


def _edges(by: list[str], halo: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = tail = schema = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).select(by)
            t = t.filter(pa.array(changed(t, by)))
            schema = t.schema
            if head is None or head.num_rows < halo:
                head = t if head is None else pa.concat_tables([head, t.slice(0, halo + 1)])
                head = head.filter(pa.array(changed(head, by))).slice(0, halo)
            t = t.slice(max(0, t.num_rows - halo))
            tail = t if tail is None else pa.concat_tables([tail, t])
            tail = tail.filter(pa.array(changed(tail, by)))
            tail = tail.slice(max(0, tail.num_rows - halo))
        if head is not None:
            pid = TaskContext.get().partitionId()
            for side, part in ((0, head), (1, tail)):
                part = part.combine_chunks()
                marks = [pa.array([pid] * part.num_rows, pa.int32()), pa.array([side] * part.num_rows, pa.int32()), pa.array(range(part.num_rows), pa.int32())]
                cols = [*marks, *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in part.columns)]
                yield pa.RecordBatch.from_arrays(cols, names=["_pid", "_side", "_at", *schema.names])

    return run


def ordered_chunks(df: DataFrame, by: list[str], halo: int) -> tuple[DataFrame, dict[int, tuple[list[dict], list[dict]]]]:
    """``df`` in range partitions sorted by ``by``, and per partition id the columns ``by`` of what is before and behind.

    Before a partition are the last ``halo`` different rows of all earlier partitions, behind it the first ``halo`` of
    all later ones.  Rows that agree in ``by`` are one, and always in one partition.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = cut(df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in by]).sortWithinPartitions(*by))
    shape = "_pid int, _side int, _at int, " + ", ".join(f"`{c}` {held.schema[c].dataType.simpleString()}" for c in by)
    rows = [r.asDict() for r in held.mapInArrow(_edges(by, halo), shape).collect()]
    rows.sort(key=lambda r: (r["_pid"], r["_side"], r["_at"]))
    pids = sorted({r["_pid"] for r in rows})
    heads = {p: [r for r in rows if r["_pid"] == p and r["_side"] == 0] for p in pids}
    tails = {p: [r for r in rows if r["_pid"] == p and r["_side"] == 1] for p in pids}
    around: dict[int, tuple[list[dict], list[dict]]] = {}
    carry: list[dict] = []
    for p in pids:
        around[p] = (carry, [])
        carry = (carry + tails[p])[-halo:]
    carry = []
    for p in reversed(pids):
        around[p] = (around[p][0], carry)
        carry = (heads[p] + carry)[:halo]
    return held, around


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = sum(b.num_rows for b in batches)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], names=["pid", "n"])


def global_rank(df: DataFrame, by: list[str], name: str, start: int = 1) -> DataFrame:
    """Column ``name``: each row's place in the order ``by`` over the whole table, in as many tasks as there are parts.

    Rows that ``by`` doesn't tell apart are numbered in no particular order; nulls come first.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = cut(df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in by]).sortWithinPartitions(*by))
    before, at = {}, start
    for r in sorted(held.mapInArrow(_count, "pid int, n bigint").collect()):
        before[r.pid] = at
        at += r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), start)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(range(at, at + b.num_rows), pa.int64())], names=[*b.schema.names, name])
            at += b.num_rows

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return held.mapInArrow(run, f"{shape}, `{name}` bigint")


def _group_ends(by: list[str]):
    """Of a partition: rows, its first and last group, how many rows the last one has, and whether it is the only one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n = open_ = groups = 0
        for b in batches:
            if not b.num_rows:
                continue
            starts = np.flatnonzero(changed(b, by))
            key = lambda i: tuple(b.column(c)[int(i)].as_py() for c in by)  # noqa: B023, E731
            goes_on = last is not None and key(0) == last
            groups += len(starts) - goes_on
            open_ = (open_ if goes_on and len(starts) == 1 else 0) + b.num_rows - int(starts[-1])
            first, last, n = first or key(0), key(b.num_rows - 1), n + b.num_rows
        if n:
            ends = [pa.array([repr(x)], pa.string()) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), *ends, pa.array([open_], pa.int64()), pa.array([groups == 1])], names=["pid", "first", "last", "open", "one"])

    return run


def rank_in_group(df: DataFrame, by: list[str], order: list[str], name: str, start: int = 1) -> DataFrame:
    """Column ``name``: each row's place in its group in the order ``order``, however many rows a group has.

    Groups lie side by side in range partitions; how much of a group stands before a partition follows from one row per
    partition.  A null in ``by`` is a group of its own; nulls come first; rows that ``order`` doesn't tell apart are
    numbered in no particular order.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = [*by, *order]
    held = cut(df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in every]).sortWithinPartitions(*every))
    before: dict[int, int] = {}
    last, open_ = None, 0
    for r in sorted(held.mapInArrow(_group_ends(by), "pid int, first string, last string, open bigint, one boolean").collect()):
        before[r.pid] = open_ if r.first == last else 0
        last, open_ = r.last, r.open + (before[r.pid] if r.one else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, key = before.get(TaskContext.get().partitionId(), 0), None
        for b in batches:
            if not b.num_rows:
                continue
            new = changed(b, by)
            now = tuple(b.column(c)[0].as_py() for c in by)
            if key is not None and now != key:
                seen = 0
            at = np.arange(b.num_rows)
            new[0] = False
            begin = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(begin < 0, at + seen, at - begin)
            seen, key = int(place[-1]) + 1, tuple(b.column(c)[b.num_rows - 1].as_py() for c in by)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place + start, pa.int64())], names=[*b.schema.names, name])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return held.mapInArrow(run, f"{shape}, `{name}` bigint")
