"""Incremental ingest: processed files, cumulative totals, consecutive frames, intervals in keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright.operators.intervals import IntervalMap


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder, or one file; the query's checkpoint is the list of the ones that were read."""
    r = spark.readStream.schema(schema).format(fmt)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        r, path = r.option("pathGlobFilter", at.getName()), str(at.getParent())
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.load(path)


def cumulative_totals(stream: DataFrame, keys: list[str], value: str, out: str, checkpoint: str) -> DataFrame:
    """Runs what is there, adding each batch's sums and row counts to a ledger of its own, and returns the totals.

    A batch's sums are written under its number, in place of what an attempt that broke off has left, so that a batch
    that runs twice counts once; the totals are the sum over the batches.
    """

    def add(batch: DataFrame, number: int) -> None:
        sums = batch.dropna(subset=keys).groupBy(*keys).agg(F.sum(value).cast("bigint").alias("total"), F.count(F.lit(1)).alias("n"))
        sums.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return totals(stream.sparkSession, out, keys)


def totals(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    t = spark.read.parquet(out)
    return t.groupBy(*keys).agg(F.sum("total").cast("bigint").alias("total"), F.sum("n").cast("bigint").alias("n"))


def frame_sessions(stream: DataFrame, keys: list[str], frame: str, delay: str = "0 seconds") -> DataFrame:
    """Consecutive frames as session windows, a frame being a second: columns keys, first_frame, last_frame, n.

    ``delay`` is how late a frame may come; append mode then closes a session once no frame can extend it.
    """
    t = stream.withColumn("_ts", F.timestamp_seconds(F.col(frame)))
    if stream.isStreaming:
        t = t.withWatermark("_ts", delay)
    s = t.groupBy(*keys, F.session_window("_ts", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    # A session of [a, b + 1 s) covers frames a to b; one second of silence ends it.
    return s.select(*keys, F.unix_seconds("w.start").alias("first_frame"), (F.unix_seconds("w.end") - 1).alias("last_frame"), "n")


#: How many frames late a frame may come where nothing else is said.
LATE = 86_400


def consecutive_frames(stream: DataFrame, keys: list[str], frame: str, out: str, checkpoint: str, late: int = LATE) -> DataFrame:
    """Runs what is there and returns the closed runs so far: columns keys, first_frame, last_frame, n.

    Frames that come again count once.  A run is closed, and written once, when a frame has come that is more than
    ``late`` frames behind it; frames that come later than that are dropped.
    """
    delay = f"{late} seconds"
    # A second a frame, and none at or before the time that a watermark begins with.
    t = stream.withColumn("_ts", F.timestamp_seconds(F.col(frame) + late)).withWatermark("_ts", delay).dropDuplicates([*keys, "_ts"])
    s = t.groupBy(*keys, F.session_window("_ts", "1 second").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    s = s.select(*keys, (F.unix_seconds("w.start") - late).alias("first_frame"), (F.unix_seconds("w.end") - 1 - late).alias("last_frame"), "n")
    s.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(s.schema).parquet(out)


_STATE = "starts array<bigint>, ends array<bigint>"


def interval_updates(stream: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Keyed state: each entity's ordered map of disjoint intervals, updated by every batch.

    Emits, for each entity that a batch touched, its periods and gaps as they then are (update mode).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        m = IntervalMap()
        if state.exists:
            m.starts, m.ends = (list(x) for x in state.get)
        for pdf in frames:
            for a, b in pdf[["_first", "_last"]].itertuples(index=False):
                m.add(int(a), int(b))
        state.update((m.starts, m.ends))
        rows = [(*key, "period", a, b) for a, b in zip(m.starts, m.ends, strict=True)] + [(*key, "gap", a, b) for a, b in m.gaps()]
        yield pd.DataFrame(rows, columns=[*keys, "kind", "first", "last"])

    slim = stream.select(*keys, F.col(first).cast("bigint").alias("_first"), F.col(last).cast("bigint").alias("_last")).dropna().filter("_last >= _first")
    fields = ", ".join(f"`{k}` {slim.schema[k].dataType.simpleString()}" for k in keys)
    return slim.groupBy(*keys).applyInPandasWithState(step, f"{fields}, kind string, first bigint, last bigint", _STATE, "update", "NoTimeout")
