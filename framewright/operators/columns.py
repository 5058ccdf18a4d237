"""Column order, previews and closest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def move_column(df: DataFrame, column: str, at: int) -> DataFrame:
    rest = [c for c in df.columns if c != column]
    return df.select(*rest[:at], column, *rest[at:])


def swap_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    """Both keep their names and change places."""
    return df.select(*[{a: b, b: a}.get(c, c) for c in df.columns])


def preview(df: DataFrame, order: list[str], offset: int, n: int = 10) -> DataFrame:
    """The next ``n`` rows in order from an offset, which is clipped at the start."""
    return df.orderBy(*order).offset(max(offset, 0)).limit(n)


def closest(df: DataFrame, by: list[str], value: str, target: Column, order: str) -> DataFrame:
    """Per group the value with the least distance from the target; of equally close ones the first by ``order``."""
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(*by).agg(F.min_by(value, F.struct(F.abs(F.col(value) - target), F.col(order))).alias("closest"))


def has_repeats(boxes: Column, fields: list[str]) -> Column:
    """Whether two elements of an array of structs agree in the fields."""
    keys = F.transform(boxes, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return F.size(keys) > F.size(F.array_distinct(keys))


def by_last_column(df: DataFrame) -> DataFrame:
    """In the order of the last column, nulls last."""
    return df.orderBy(F.col(df.columns[-1]).asc_nulls_last())


def without_empty_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Without rows that are null in all columns, or in all of the subset."""
    return df.dropna(how="all", subset=subset)


def exact_filters(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Rows whose columns read exactly as wanted, as text; an empty wish lets everything pass."""
    for c, v in wanted.items():
        df = df.filter(F.col(c).cast("string") == v) if v != "" else df
    return df
