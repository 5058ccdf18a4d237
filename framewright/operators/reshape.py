"""Expanding, compacting, splitting and nesting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.numbers import padded
from framewright.operators.ordered import global_rank, rank_in_group


def expand_duration(df: DataFrame, frame: str = "frame_no", duration: str = "duration", hits: str | None = "total_hits") -> DataFrame:
    """One row per covered frame, each of duration 1 (and one hit); a null duration or one below 1 gives none."""
    out = df.filter(F.col(duration) >= 1).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col(duration) - 1)))
    out = out.withColumn(frame, F.col(frame) + F.col("_i")).withColumn(duration, F.lit(1))
    return (out.withColumn(hits, F.lit(1)) if hits else out).drop("_i")


def expand_padded(df: DataFrame, frame: str = "frame", duration: str = "duration") -> DataFrame:
    """As ``expand_duration`` for frames as text, ``prefix_000123`` or digits: prefix and width stay."""
    digits = F.regexp_extract(frame, "([0-9]+)\\z", 1)
    out = df.filter((F.col(duration) >= 1) & (digits != "")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col(duration) - 1)))
    prefix = F.expr(f"left({frame}, length({frame}) - length(regexp_extract({frame}, '([0-9]+)\\\\z', 1)))")
    number = padded(digits.cast("bigint") + F.col("_i"), F.length(digits))
    return out.withColumn(frame, F.concat(prefix, number)).withColumn(duration, F.lit(1)).drop("_i")


def compact(df: DataFrame, keys: list[str], sums: list[str], first: str) -> DataFrame:
    """Rows alike in ``keys`` become one with the sums and the least ``first``; rows with a null key are left out."""
    aggs = [F.sum(c).cast("bigint").alias(c) for c in sums]
    return df.dropna(subset=keys).groupBy(*keys).agg(*aggs, F.min(first).alias(first))


def compact_expanded(df: DataFrame, keys: list[str], frame: str = "frame_no", duration: str = "duration", hits: str = "total_hits") -> DataFrame:
    """What compacting the expanded rows gives, without expanding them."""
    rows = df.filter(F.col(duration) >= 1).withColumn(hits, F.col(duration))
    return compact(rows, keys, [duration, hits], frame)


def unpivot_flags(df: DataFrame, ids: list[str], flags: list[str], name: str = "sponsor") -> DataFrame:
    """One row per flag that is set; the suffix that repeated column names carry is dropped from the name."""
    long = df.select(*ids, *[F.col(c).cast("int").alias(c) for c in flags]).unpivot(ids, flags, name, "flag")
    return long.filter((F.col("flag").isNotNull()) & (F.col("flag") != 0)).withColumn(name, F.regexp_replace(name, "\\.[0-9]+$", ""))


def split_range(df: DataFrame, start: str, stop: str, people: str) -> DataFrame:
    """A frame range shared out equally: columns person, first_frame, last_frame behind those of ``df``.

    The parts cover the range without holes or overlaps, and where there are fewer frames than people the last people
    get none.  The first part may be longer by the rounding, as are those before it shifted.
    """
    total = F.col(stop) - F.col(start)
    step = F.floor(total / F.col(people))
    first = F.bround(total / F.col(people), 0).cast("bigint")
    out = df.withColumn("person", F.explode(F.sequence(F.lit(1), F.col(people))))
    p = F.col("person")
    raw_start = F.when(p == 1, F.col(start)).otherwise(F.col(start) + first + 1 + (p - 2) * (step + 1))
    raw_end = F.when(p == 1, F.col(start) + first).otherwise(F.col(start) + first + (p - 1) * (step + 1))
    end = F.when(p == F.col(people), F.col(stop)).otherwise(F.least(raw_end, F.col(stop)))
    over = F.col(start) + first + (F.col(people) - 1) * (step + 1) > F.col(stop)
    shift = F.when(over, 1).otherwise(0)
    begin = F.when(p == 1, raw_start).otherwise(raw_start - shift)
    close = F.when(p == F.col(people), end).otherwise(raw_end - shift)
    return out.withColumn("first_frame", begin.cast("bigint")).withColumn("last_frame", close.cast("bigint")).filter("first_frame <= last_frame")


def chunks(df: DataFrame, by: list[str], order: list[str], parts: int, remainder: str = "last") -> DataFrame:
    """Column part, 0-based: rows in order split into parts of one size; the remainder goes to the last or first parts."""
    rows = rank_in_group(df, by, order, "_i", 0).withColumn("_by", F.struct(*by))
    n = df.groupBy(F.struct(*by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    i, size = F.col("_i"), F.floor(F.col("_n") / parts)
    if remainder == "first":
        more, longer = F.col("_n") % parts, size + 1
        part = F.when(i < more * longer, F.floor(i / longer)).otherwise(more + F.floor((i - more * longer) / F.greatest(size, F.lit(1))))
    else:
        part = F.least(F.floor(i / F.greatest(size, F.lit(1))), F.lit(parts - 1))
    return rows.join(n, "_by").withColumn("part", part.cast("int")).select(*df.columns, "part")


def fill_bins(df: DataFrame, by: list[str], order: list[str], size: str, quota: int) -> DataFrame:
    """Column part, 0-based: a new part begins with the row that would take the running size beyond the quota."""
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        part, held, out = 0, 0, []
        for n in pdf[size].fillna(0):
            if held and held + n > quota:
                part, held = part + 1, 0
            held += n
            out.append(part)
        return pdf.assign(part=out)

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", part int"
    return df.groupBy(*by).applyInPandas(run, shape)


def take_exact(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """Column side, ``train`` for exactly floor(n * share) rows and ``val`` for the rest, in the order of a hash.

    The hash is MD5 of the key and the seed as text: the split is the same wherever it is made.
    """
    rows = global_rank(df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))), ["_h", key], "_r")
    side = F.when(F.col("_r") <= F.floor(F.lit(df.count()) * F.lit(share)), "train").otherwise("val")
    return rows.withColumn("side", side).select(*df.columns, "side")


def explode_annotations(df: DataFrame, images: str = "images") -> DataFrame:
    """One row per box of an annotation document; an image without boxes gives none."""
    one = df.select(*[c for c in df.columns if c != images], F.explode(F.map_values(F.col(images))).alias("image"))
    return one.select(*[c for c in df.columns if c != images], "image.imageName", "image.imageIndex", "image.width", "image.height", F.explode("image.annotations").alias("box")).select("*", "box.*").drop("box")


def nest_boxes(df: DataFrame, image: str, box: list[str], order: list[Column | str]) -> DataFrame:
    """One row per image with its boxes as an array in order."""
    o = F.struct(*order).alias("_o")
    rows = df.groupBy(image).agg(F.array_sort(F.collect_list(F.struct(o, F.struct(*box).alias("box")))).alias("a"))
    return rows.select(image, F.transform("a", lambda x: x["box"]).alias("annotations"))
