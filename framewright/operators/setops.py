"""Set operations on rows, lines and maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows; a column that a part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def only_once_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that stand exactly once in ``a`` and never in ``b``; nulls are equal to nulls."""
    cols = a.columns
    both = a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(b.select(*cols).withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1)))
    return both.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).filter("_a = 1 and _b = 0").select(*cols)


def line_diff(a: DataFrame, b: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of each key's text in ``a`` that its text in ``b`` lacks (side ``-``), and the other way (``+``), numbered."""

    def lines(df: DataFrame) -> DataFrame:
        return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))

    la, lb = lines(a), lines(b)
    gone = la.join(lb, [key, "line"], "left_anti").withColumn("side", F.lit("-"))
    came = lb.join(la, [key, "line"], "left_anti").withColumn("side", F.lit("+"))
    return gone.unionByName(came).select(key, "side", "line_no", "line")


def merged_map(local: Column, incoming: Column) -> Column:
    """The local entries, overwritten by the incoming ones that aren't empty."""
    kept = F.map_filter(incoming, lambda _, v: v.isNotNull() & (F.size(v) > 0))
    mine = F.map_filter(local, lambda k, _: ~F.coalesce(F.map_contains_key(kept, k), F.lit(False)))
    return F.map_concat(mine, kept)


def replaced_document(df: DataFrame, other: DataFrame, key: str, part: str) -> DataFrame:
    """The documents with the part that ``other`` has for their key.  A document that has none there is an error."""
    new = other.groupBy(key).agg(F.first(part, ignorenulls=True).alias("_new"))
    out = df.join(new, key, "left")
    return out.withColumn(part, F.coalesce("_new", F.raise_error(F.concat(F.lit("no part for "), F.col(key).cast("string"))).cast(df.schema[part].dataType))).select(*df.columns)


def write_grouped(parts: list[DataFrame], key: Column, path: str) -> None:
    """All rows of tables of one shape, under one folder per key: what belongs together in one output."""
    union_by_name(*parts).withColumn("base", key).write.mode("overwrite").partitionBy("base").parquet(path)
