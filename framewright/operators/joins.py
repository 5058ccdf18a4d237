"""Joins: enrichment, lookups, updates, comparisons with history, bands, membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.numbers import percent_change
from framewright.operators.ordered import rank_in_group
from framewright.operators.stretches import Ordering


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join in which a null key matches a null key; the right side's keys are dropped."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def enrich(rows: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with what ``extra`` has for its keys; repeated keys there repeat the row, none leaves nulls."""
    return null_safe(rows, extra, keys)


def first_match(rows: DataFrame, lookup: DataFrame, keys: list[str], row: str) -> DataFrame:
    """As ``enrich``, but of several matches only the first one by ``row`` counts."""
    cols = [c for c in lookup.columns if c not in (*keys, row)]
    once = lookup.groupBy(*keys).agg(F.min_by(F.struct(*cols), row).alias("_x"))
    return null_safe(rows, once, keys).select(*rows.columns, *[F.col(f"_x.{c}").alias(c) for c in cols])


def outer_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on one key, which comes out once."""
    return left.join(right, key, "full")


def add_updates(rows: DataFrame, updates: DataFrame, key: str, amount: str, to: list[str]) -> DataFrame:
    """The summed updates of each key added to the columns ``to`` of every row that has it."""
    per = updates.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(amount).alias("_add"))
    out = rows.join(per, key, "left")
    return out.withColumns({c: (F.col(c) + F.coalesce("_add", F.lit(0))).cast("bigint") for c in to}).drop("_add").select(*rows.columns)


def stripped_number(c: Column) -> Column:
    """The digits of a name without leading zeros, as a number; no digits give 0."""
    d = F.ltrim(F.regexp_replace(c, "[^0-9]", ""), F.lit("0"))
    return F.coalesce(d.try_cast("bigint"), F.lit(0))


def name_prefix(c: Column) -> Column:
    """``prefix_000123`` of a picture's name; null where it isn't so named."""
    p = F.regexp_extract(c, "^(.+_[0-9]+)\\.jpe?g$", 1)
    return F.when(p != "", p)


def add_runs(rows: DataFrame, runs: DataFrame, frame: str, name: str, amount: str, to: list[str]) -> DataFrame:
    """Run sizes added to the rows of their first picture.

    Each run decides for itself how it meets the rows: one whose picture is named by a number alone meets the frames of
    that number, another one the frames that are its name's whole prefix.  What several runs add to a row is added up.  A frame
    without digits meets no number.
    """
    number = F.regexp_like(F.col(name), F.lit("^[0-9]+\\.jpe?g$"))
    keyed = runs.select(F.when(number, F.concat(F.lit("#"), stripped_number(F.col(name)).cast("string"))).otherwise(name_prefix(F.col(name))).alias("_k"), amount)
    per = keyed.filter("_k is not null").groupBy("_k").agg(F.sum(amount).alias("_add"))
    # Prefixes end in digits behind an underscore, so that a row's two keys are never the same.
    named = F.when(F.regexp_like(F.col(frame), F.lit("[0-9]")), F.concat(F.lit("#"), stripped_number(F.col(frame)).cast("string")))
    out = rows.withColumns({"_n": named, "_p": F.col(frame)})
    out = out.join(per.withColumnsRenamed({"_k": "_n", "_add": "_a"}), "_n", "left").join(per.withColumnsRenamed({"_k": "_p", "_add": "_b"}), "_p", "left")
    add = F.coalesce("_a", F.lit(0)) + F.coalesce("_b", F.lit(0))
    return out.withColumns({c: (F.col(c) + add).cast("bigint") for c in to}).select(*rows.columns)


def history_diff(new: DataFrame, old: DataFrame, keys: list[str], value: str, percent: float = 25.0) -> DataFrame:
    """Keys whose value is more than ``percent`` off the old one; an old value of zero counts when the new one differs."""
    o = old.select(*keys, F.col(value).alias("old_value"))
    out = new.select(*keys, F.col(value).alias("new_value")).join(o, keys)
    return out.withColumn("difference", F.round(percent_change(F.col("new_value"), F.col("old_value")), 3)).filter(percent_change(F.col("new_value"), F.col("old_value")) > percent)


def new_keys(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(old.select(*keys), keys, "left_anti")


def cumulative_merge(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Columns total_duration and file_count of either side added up, average_duration computed anew."""
    both = state.select(*keys, "total_duration", "file_count").unionByName(batch.select(*keys, "total_duration", "file_count"))
    out = both.groupBy(*keys).agg(F.sum("total_duration").cast("bigint").alias("total_duration"), F.sum("file_count").cast("bigint").alias("file_count"))
    return out.withColumn("average_duration", F.round(F.col("total_duration") / F.col("file_count"), 3))


def pair_by_kind(df: DataFrame, key: str, kind: str, value: str, kinds: list[str]) -> DataFrame:
    """One row per key with the least value of each kind in a column of its own."""
    return df.groupBy(key).pivot(kind, kinds).agg(F.min(value))


def within_band(df: DataFrame, by: list[str], pos: str, reach: int) -> DataFrame:
    """Pairs of different positions at most ``reach`` apart, both ways, as an equi-join on the positions within reach."""
    left = df.select(*by, F.col(pos).alias("pos_a")).withColumn("pos_b", F.explode(F.sequence(F.col("pos_a") - reach, F.col("pos_a") + reach))).filter("pos_a <> pos_b")
    return left.join(df.select(*by, F.col(pos).alias("pos_b")), [*by, "pos_b"])


def next_pairs(df: DataFrame, by: list[str], order: list[str], col: str, stretch: Column | None = None) -> DataFrame:
    return Ordering(by, order, stretch).neighbour(df, {col: "next_value"}, behind=True).filter("next_value is not null")


def semi(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return rows.join(ids.select(key).distinct(), key, "left_semi")


def missing_per_file(listed: DataFrame, present: DataFrame, files: DataFrame, brand: str, file: str) -> DataFrame:
    """Each listed brand that a file lacks.

    The distinct names are kept in parts of ``NAMES_AT_ONCE``: a file's brands are subtracted from each part they fall
    into, so that no pair of file and brand is made that isn't part of the result, and no task holds the whole list.
    Null files and names are left out.
    """
    part = lambda c: F.pmod(F.xxhash64(c), F.col("_parts"))
    names = listed.select(F.col(brand).alias("_name")).dropna().distinct()
    n = names.agg(F.greatest(F.ceil(F.count(F.lit(1)) / NAMES_AT_ONCE), F.lit(1)).cast("bigint").alias("_parts"))
    wanted = names.join(F.broadcast(n)).groupBy(part(F.col("_name")).alias("_part")).agg(F.array_sort(F.collect_list("_name")).alias("_wanted"))
    have = present.select(F.col(file).alias("_file"), F.col(brand).alias("_name")).dropna().distinct().join(F.broadcast(n))
    have = have.groupBy("_file", part(F.col("_name")).alias("_part")).agg(F.collect_list("_name").alias("_have"))
    every = files.select(F.col(file).alias("_file")).dropna().distinct().join(F.broadcast(n)).select("_file", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part"))
    rows = every.join(have, ["_file", "_part"], "left").join(wanted, "_part")
    left = F.array_except("_wanted", F.coalesce("_have", F.array().cast("array<string>")))
    return rows.select(F.col("_file").alias(file), F.explode(left).alias(brand))


#: Names in one part of a list.
NAMES_AT_ONCE = 10_000


def group_semi(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """Rows of keys that stand more than once and of which at least one row has the flag."""
    ok = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(flag.cast("int")).alias("f")).filter("n > 1 and f = 1")
    return df.join(ok.select(key), key, "left_semi")


def zip_rows(left: DataFrame, right: DataFrame, by: list[str], order_left: list[str], order_right: list[str]) -> DataFrame:
    """The i-th row of either side within ``by``; the shorter side decides.  A null key meets nothing."""
    a = rank_in_group(left.dropna(subset=by), by, order_left, "_i")
    b = rank_in_group(right.dropna(subset=by), by, order_right, "_i")
    return a.join(b, [*by, "_i"]).drop("_i")


def keep_boxes(df: DataFrame, pairs: list[tuple[str, str]], boxes: str = "annotations") -> DataFrame:
    """Boxes whose (brand, tpoint) is among the pairs; images without any left are dropped."""
    keep = F.array(*[F.struct(F.lit(b).alias("brand"), F.lit(t).alias("tpoint")) for b, t in pairs])
    out = df.withColumn(boxes, F.filter(boxes, lambda x: F.array_contains(keep, F.struct(x["brand"].alias("brand"), x["tpoint"].alias("tpoint")))))
    return out.filter(F.size(boxes) > 0)


def contained_in(bases: DataFrame, names: DataFrame, base: str, name: str) -> DataFrame:
    """Distinct pairs of a base and a name that holds it anywhere: columns base, name.

    Exact: a base is contained in a name where it equals one of the name's pieces of its own length, so pieces of the
    lengths that bases have meet the bases in an equi-join.  Nulls meet nothing; an empty base is in every name.
    """
    short = bases.select(base).dropna().distinct()
    long = names.select(name).dropna().distinct()
    sizes = short.select(F.length(base).alias("_n")).distinct()
    cut = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) - F.col("_n") + 1), lambda i: F.substring(F.col(name), i, F.col("_n"))))
    pieces = long.join(sizes, F.length(name) >= F.col("_n")).select(name, F.explode(cut).alias("_piece"))
    return short.join(pieces, F.col(base) == F.col("_piece")).select(base, name)


def join_back(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with the other columns of the table they came from, each once; a null key meets a null key."""
    return null_safe(rows.select(*keys), table, keys).distinct()


def reattach(rows: DataFrame, groups: DataFrame, key: str, group: str) -> DataFrame:
    """Rows without a group take the one that ``groups`` has for their key; of several the least."""
    once = groups.dropna(subset=[key, group]).groupBy(key).agg(F.min(group).alias("_group"))
    return rows.join(once, key, "left").withColumn(group, F.coalesce(group, "_group")).select(*rows.columns)
