"""Consolidating very many small sorted pieces into few well-sized files.

Every piece becomes sorted runs, cut at key-range borders.  All runs of one key range meet in one task, in the order of
their first frames, and a heap merges those that are open k ways: a run is opened when the merge reaches it and dropped
when it is used up.  What repeats is dropped.  A key range is a stretch of frames of one video, so a video of any size is
spread over as many tasks as it has ranges.  Files are then packed from neighbouring ranges, over the borders of videos,
up to their bytes; only a range above them is cut.  Spark's own writer commits them to whatever file system the path
names, in place of all that stood there.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import schemas
from framewright.session import cut, store

#: Frames per key range.
RANGE = 1 << 14
#: Key ranges of a video's records without a frame.
UNPLACED = 64
#: Bytes after which an output file is full.
TARGET_BYTES = 128 << 20

_LAST_DIGITS = re.compile(r"([0-9]+)[^0-9]*\Z")
_MAX = (1 << 63) - 1
#: Columns of a written file, and rows that a merging task hands on at once.
_KEPT = ["video", "frame_no", "brand", "location", "duration"]
_AT_ONCE = 20_000
Record = tuple[int, str, str, int]  # frame, brand, location, duration; -1 for a frame or duration that isn't there


def parse_piece(content: str | None) -> list[Record]:
    """The records of one piece in the order they stand.

    Header, empty and blank lines hold no record, nor does a line without the four columns.  A frame text without
    digits gives frame -1; a duration that is no whole number gives -1.
    """
    out: list[Record] = []
    for line in re.split(r"\r\n|\n|\r", content or ""):
        f = line.split("\t")
        if len(f) < 4 or tuple(f[:4]) == schemas.PIECE_HEADER:
            continue
        m = _LAST_DIGITS.search(f[3])
        frame = int(m[1]) if m else -1
        d = f[2].strip()
        dur = int(d) if d.isascii() and d.isdigit() else -1
        out.append((frame if frame <= _MAX else -1, f[0], f[1], dur if dur <= _MAX else -1))
    return out


def sorted_runs(records: list[Record]) -> Iterator[list[Record]]:
    """The maximal ascending stretches: a piece that is sorted already is one run."""
    run: list[Record] = []
    for r in records:
        if run and r < run[-1]:
            yield run
            run = []
        run.append(r)
    if run:
        yield run


def merge_runs(runs: Iterable[Iterable[Record]]) -> Iterator[Record]:
    """K-way merge of runs that come in the order of their first frames.

    A run is opened when the merge has come to its first frame, and only open runs are held.  Of records with the same
    frame, brand and location the one with the longest duration stays.
    """
    heap: list[tuple[Record, int, Iterator[Record]]] = []
    last: Record | None = None

    def upto(frame: int | None) -> Iterator[Record]:
        nonlocal last
        while heap and (frame is None or heap[0][0][0] < frame):
            r, k, rest = heap[0]
            behind = next(rest, None)
            if behind is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (behind, k, rest))
            if last is not None and r[:3] != last[:3]:
                yield last
            last = r

    for k, run in enumerate(runs):
        rest = iter(run)
        first = next(rest, None)
        if first is not None:
            yield from upto(first[0])
            heapq.heappush(heap, (first, k, rest))
    yield from upto(None)
    if last is not None:
        yield last


_RUN = "video string, part bigint, head bigint, frames array<bigint>, brands array<string>, locations array<string>, durations array<bigint>"
_OUT = "video string, part bigint, roll bigint, frame_no bigint, brand string, location string, duration bigint"


def _part(r: Record, width: int) -> int:
    """The key range of a record: records without a frame are spread by what else they are known by."""
    return r[0] // width if r[0] >= 0 else -1 - zlib.crc32(f"{r[1]}\t{r[2]}".encode()) % UNPLACED


def _to_runs(width: int):
    names = [x.split()[0] for x in _RUN.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for video, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for r in sorted_runs(parse_piece(content)):
                    parts = [_part(x, width) for x in r]
                    at = 0
                    for i in range(1, len(r) + 1):
                        if i == len(r) or parts[i] != parts[at]:
                            rows.append((video, parts[at], r[at][0], *(list(c) for c in zip(*r[at:i], strict=True))))
                            at = i
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return run


def _merge(target: int):
    names = [x.split()[0] for x in _OUT.split(", ")]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, tuple]]:
        """Each run with its key range; a piece that was sent more than once stands behind itself and is left out."""
        before = None
        for b in batches:
            for video, part, _, *cols in zip(*(c.to_pylist() for c in b.columns), strict=True):
                now = (video, part, cols)
                if now != before:
                    yield (video, part), zip(*cols, strict=True)
                before = now

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (video, part), runs in groupby(ranges(batches), key=lambda x: x[0]):
            size = 0
            for frame, brand, location, dur in merge_runs(r for _, r in runs):
                yield video, part, size // target, None if frame < 0 else frame, brand, location, None if dur < 0 else dur
                size += 16 + len(brand.encode()) + len(location.encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = records(batches)
        while some := list(islice(rows, _AT_ONCE)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)

    return run


def consolidate(pieces: DataFrame, video: str = "video", content: str = "content", width: int = RANGE, target: int = TARGET_BYTES) -> DataFrame:
    """Each record once, in key order within (video, part), with the number ``roll`` of its output file in that range.

    A roll holds the records that begin in one stretch of ``target`` bytes of the range.  A record is identified by video, frame number, brand and location.  Empty and null pieces hold none; an empty table
    gives no rows; a null video is a video of its own.
    """
    runs = pieces.select(F.col(video), F.col(content)).filter(F.length(content) > 0).mapInArrow(_to_runs(width), _RUN)
    return runs.repartition("video", "part").sortWithinPartitions("video", "part", "head", "frames").mapInArrow(_merge(target), _OUT)


def _size() -> Column:
    return F.lit(16) + F.octet_length("brand") + F.octet_length("location")


def output_files(records: DataFrame) -> DataFrame:
    """First and last frame, records and bytes of each key range and roll, before ranges are packed into files."""
    return records.groupBy("video", "part", "roll").agg(
        F.min("frame_no").alias("first_frame"),
        F.max("frame_no").alias("last_frame"),
        F.count(F.lit(1)).alias("records"),
        F.sum(_size()).alias("n_bytes"),
    )


def _range_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = sum(sum(b.column(b.schema.get_field_index("n_bytes")).to_pylist()) for b in batches)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())], names=["pid", "n"])


def _packs(before: dict[int, int], target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            packs, large = [], []
            for n in b.column(2).to_pylist():
                packs.append(at // target)
                large.append(n > target)
                at += n
            cols = [b.column(0), b.column(1), pa.array(packs, pa.int64()), pa.array(large, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["_video", "_part", "pack", "large"])

    return run


def pack_ranges(records: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """The consolidated records with their output file: columns pack, large and roll.

    Key ranges are laid end to end in key order, whatever their video, and each belongs to the stretch of ``target``
    bytes that it starts in.  A range above ``target`` bytes is ``large``: its rolls are files of their own.  Other
    files are below twice ``target``, their keys don't overlap, and there are no more of them than stretches.  What
    reaches the driver is one number per partition.
    """
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = records.groupBy("video", "part").agg(F.sum(_size()).alias("n_bytes"))
    # A null frame's part comes first in its video, a null video before all others.
    ranges = cut(sizes.repartitionByRange(n, F.col("video").asc_nulls_first(), "part").sortWithinPartitions(F.col("video").asc_nulls_first(), "part"))
    before, at = {}, 0
    for r in sorted(ranges.mapInArrow(_range_sizes, "pid int, n bigint").collect()):
        before[r.pid] = at
        at += r.n
    packs = ranges.mapInArrow(_packs(before, target), "_video string, _part bigint, pack bigint, large boolean")
    return records.join(packs, F.col("video").eqNullSafe(F.col("_video")) & (F.col("part") == F.col("_part"))).withColumn("roll", F.when(F.col("large"), F.col("roll")).otherwise(F.lit(0))).drop("_video", "_part")


def packed_files(packed: DataFrame) -> DataFrame:
    """The range metadata of the files of ``pack_ranges``: first and last key, records and bytes of each."""
    ends = packed.groupBy("pack", "large", "roll", "video").agg(F.countDistinct("part").alias("parts"), F.min("frame_no").alias("a"), F.max("frame_no").alias("b"), F.count(F.lit(1)).alias("records"), F.sum(_size()).alias("n_bytes"))
    whole = ends.groupBy("pack", "large", "roll").agg(
        F.min(F.struct("video", "a")).alias("first"),
        F.max(F.struct("video", "b")).alias("last"),
        F.sum("parts").alias("ranges"),
        F.sum("records").alias("records"),
        F.sum("n_bytes").alias("n_bytes"),
    )
    return whole.select("pack", "large", "roll", F.col("first.video").alias("first_video"), F.col("last.video").alias("last_video"), F.col("first.a").alias("first_frame"), F.col("last.b").alias("last_frame"), "ranges", "records", "n_bytes")


def write_consolidated(pieces: DataFrame, path: str, width: int = RANGE, target: int = TARGET_BYTES) -> DataFrame:
    """Writes the files under ``path``, in place of all that stood there, and returns one row per file.

    Neighbouring key ranges share a file, see ``pack_ranges``; each file has a folder of its own named by its place in
    the order of keys.  Spark commits what whole tasks have written, so that a task that runs twice leaves one file.
    The rows are read off the written files and kept beside them, in ``_ranges``: path, first_video, last_video,
    first_frame (of first_video), last_frame (of last_video), records, n_bytes.
    """
    spark = pieces.sparkSession
    packed = pack_ranges(store(consolidate(pieces, width=width, target=target)), target)
    place = F.concat_ws("-", F.lpad(F.col("pack").cast("string"), 12, "0"), F.col("large").cast("int").cast("string"), F.lpad(F.col("roll").cast("string"), 12, "0"))
    laid = packed.select(place.alias("file"), *_KEPT).repartition("file").sortWithinPartitions("file", *_KEPT[:-1])
    laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("file").parquet(path)
    files = read_consolidated(spark, path).select(*_KEPT, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("n_bytes"))
    ends = files.groupBy("path", "n_bytes", "video").agg(F.min("frame_no").alias("a"), F.max("frame_no").alias("b"), F.count(F.lit(1)).alias("records"))
    rows = ends.groupBy("path", "n_bytes").agg(F.min(F.struct("video", "a")).alias("first"), F.max(F.struct("video", "b")).alias("last"), F.sum("records").alias("records"))
    rows = rows.select("path", F.col("first.video").alias("first_video"), F.col("last.video").alias("last_video"), F.col("first.a").alias("first_frame"), F.col("last.b").alias("last_frame"), "records", "n_bytes")
    rows.write.mode("overwrite").parquet(f"{path}/_ranges")
    return spark.read.schema(rows.schema).parquet(f"{path}/_ranges")


def read_consolidated(spark: SparkSession, path: str) -> DataFrame:
    """The records of all files that ``write_consolidated`` has put there."""
    shape = "video string, frame_no bigint, brand string, location string, duration bigint, file string"
    return spark.read.schema(shape).parquet(path)
