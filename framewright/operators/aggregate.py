"""Aggregations over exposures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.numbers import log_measure


def totals(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Summed value per key; rows with a null key are left out."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.sum(value).cast("bigint").alias(name))


def at_least(df: DataFrame, keys: list[str], value: str, name: str, least: int) -> DataFrame:
    return totals(df, keys, value, name).filter(F.col(name) > least)


def joined_list(df: DataFrame, keys: list[str], value: str, order: str, name: str, sep: str = ",") -> DataFrame:
    """Values of each key in order, joined; nulls are left out."""
    rows = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("a"))
    return rows.select(*keys, F.array_join(F.transform("a", lambda x: x["v"]), sep).alias(name))


def joined_set(df: DataFrame, keys: list[str], value: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct values of each key, sorted and joined.  They are made distinct before they are gathered."""
    once = df.dropna(subset=[*keys, value]).select(*keys, value).distinct()
    return once.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(name))


def file_span(df: DataFrame, file: str, frame: str, duration: str, row: str) -> DataFrame:
    """Column total_frames per file: from its first row's frame to the end of its last row, in row order."""
    rows = df.filter(F.col(frame).isNotNull())
    return rows.groupBy(file).agg((F.max_by(frame, row) - F.min_by(frame, row) + F.coalesce(F.max_by(duration, row), F.lit(0))).cast("bigint").alias("total_frames"))


def normalised_exposure(df: DataFrame, file: str, keys: list[str], frame: str, duration: str, row: str) -> DataFrame:
    """Columns file, keys, total_frames, total_duration, avg_total_duration: the log measure of their ratio.

    The ratio is 0 where the file spans no frames.
    """
    span = file_span(df, file, frame, duration, row)
    sums = totals(df, [file, *keys], duration, "total_duration")
    ratio = F.when(F.col("total_frames") > 0, F.col("total_duration") / F.col("total_frames")).otherwise(0.0)
    return sums.join(span, file).withColumn("avg_total_duration", log_measure(ratio))


def levels(df: DataFrame, keys: list[str], per_hour: int = 3600) -> DataFrame:
    """Counts at every level of the keys, the whole included, and in hours at a row a second."""
    out = df.rollup(*keys).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("hours", F.round(F.col("n") / per_hour, 3))


def reduction(before: Column, after: Column) -> Column:
    """How much less, in percent; null where there was nothing."""
    return F.when(before > 0, F.round((before - after) / before * 100, 3))
