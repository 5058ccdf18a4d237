"""Order-dependent operators: every one takes what it runs within and what it is ordered by.

Where a ``stretch`` is given (see ``stretches``), a group is spread over tasks however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.numbers import half_up
from framewright.operators.ordered import global_rank, rank_in_group
from framewright.operators.stretches import Ordering


def run_index(df: DataFrame, by: list[str], order: list[str], values: list[str], stretch: Column | None = None) -> DataFrame:
    """Columns run (1-based number of the run of equal values) and pos (1-based place in it).

    A null value always opens a new run.
    """
    o = Ordering(by, order, stretch)
    d = o.marked(df)
    w = o.window()
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    row = F.struct(*[F.col(c).alias(c) for c in values])

    def goes_on(value: Column, before: Column) -> Column:
        out = before.isNotNull()
        for c in values:
            out = out & (value[c] == before[c])
        return F.coalesce(out, F.lit(False))

    d = d.withColumn("_new", (~goes_on(row, F.lag(row).over(w))).cast("bigint"))
    d = d.withColumn("run", F.sum("_new").over(upto))
    d = d.withColumn("_n", F.row_number().over(w)).withColumn("pos", F.col("_n") - F.max(F.when(F.col("_new") == 1, F.col("_n"))).over(upto) + 1)
    if stretch is None:
        return d.drop("_new", "_n").withColumn("pos", F.col("pos").cast("int"))
    at = F.struct(*order)
    edge = F.struct(F.min_by(row, at).alias("first"), F.max_by(row, at).alias("last"), F.max("run").alias("runs"), F.max_by("pos", at).cast("bigint").alias("open"))

    # A stretch that is one run going on keeps open what was open before it.
    per = d.groupBy("_by", "_st").agg(edge.alias("_sum"))
    across = Window.partitionBy("_by").orderBy("_st")
    upto = across.rowsBetween(Window.unboundedPreceding, 0)
    past = across.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("joins", goes_on(F.col("_sum.first"), F.lag("_sum.last").over(across)).cast("bigint"))
    per = per.withColumn("chain", F.sum(F.when((F.col("joins") == 1) & (F.col("_sum.runs") == 1), 0).otherwise(1)).over(upto))
    per = per.withColumn("held", F.sum("_sum.open").over(Window.partitionBy("_by", "chain").orderBy("_st").rowsBetween(Window.unboundedPreceding, 0)))
    per = per.select("_by", "_st", "joins", (F.coalesce(F.sum(F.col("_sum.runs") - F.col("joins")).over(past), F.lit(0)) - F.col("joins")).alias("_runs"), (F.col("joins") * F.lag("held", 1, 0).over(across)).alias("_held"))
    d = d.join(per, ["_by", "_st"])
    d = d.withColumn("pos", (F.col("pos") + F.when(F.col("run") == 1, F.col("_held")).otherwise(0)).cast("int")).withColumn("run", F.col("run") + F.col("_runs"))
    return o.unmarked(d.drop("_new", "_n", "joins", "_runs", "_held"))


def half_innings(run: Column, base: int = 1) -> Column:
    """Label of a run: ``Top`` and ``Bottom`` in turn.  From a base beyond 1 the bottom half counts one higher."""
    top = F.concat(F.lit("Top "), (F.lit(base) + (run - 1) / 2).cast("bigint").cast("string"))
    below = F.lit(base) + run / 2 - (1 if base == 1 else 0)
    return F.when(run % 2 == 1, top).otherwise(F.concat(F.lit("Bottom "), below.cast("bigint").cast("string")))


def forward_fill(df: DataFrame, by: list[str], order: list[str], cols: list[str], stretch: Column | None = None) -> DataFrame:
    """Nulls take the last value before them; leading nulls stay."""
    out = Ordering(by, order, stretch).last_values(df, {c: f"_l{i}" for i, c in enumerate(cols)})
    return out.withColumns({c: F.col(f"_l{i}") for i, c in enumerate(cols)}).select(*df.columns)


def leading_fill(df: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Leading nulls take the first value that comes; others stay."""
    at = F.struct(*[F.col(c).alias(c) for c in order])
    first = df.groupBy(*by).agg(*[F.min_by(F.struct(F.col(c).alias("v"), at.alias("at")), F.when(F.col(c).isNotNull(), at)).alias(f"_f_{c}") for c in cols])
    out = df.join(first.withColumnsRenamed({b: f"_b_{b}" for b in by}), _null_safe(by), "left")
    fill = {c: F.when(F.col(c).isNull() & (at < F.col(f"_f_{c}.at")), F.col(f"_f_{c}.v")).otherwise(F.col(c)) for c in cols}
    return out.select(*[fill.get(c, F.col(c)).alias(c) for c in df.columns])


def _null_safe(by: list[str]) -> Column:
    cond = F.lit(True)
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
    return cond


def adjacent_conflicts(df: DataFrame, by: list[str], order: list[str], same: str, differs: str, stretch: Column | None = None) -> DataFrame:
    """Rows whose next row has the same ``same`` but another ``differs`` (null differs from everything)."""
    out = Ordering(by, order, stretch).neighbour(df, {same: "_next_same", differs: "next_value"}, behind=True)
    clash = (F.col("_next_same") == F.col(same)) & ~F.coalesce(F.col(differs) == F.col("next_value"), F.lit(False))
    return out.filter(clash).drop("_next_same")


def merge_consecutive(
    df: DataFrame, keys: list[str], offset: str, hits: str, keep_first: list[str], keep_last: list[str], row: str, average: str = "odd", gap: int = 1, stretch: Column | None = None
) -> DataFrame:
    """Rows of one key whose offsets follow each other become one exposure.

    Of rows with one key and offset the last one (by ``row``) counts.  duration counts the offsets; hits are summed;
    ``keep_first`` columns come from the first row, ``keep_last`` from the last.  average ``odd`` is hits / duration to
    three digits where that isn't whole, else the last row's own hits; ``tenth`` is hits / duration to one digit.
    Rows with a null key or offset are left out.
    """
    rest = list(dict.fromkeys([hits, *keep_first, *keep_last]))
    d = df.dropna(subset=[*keys, offset]).withColumn("_st", F.lit(0) if stretch is None else stretch)
    # One shuffle, by key and stretch: the rows of an offset, and those around it, meet there.
    rows = d.repartition(*keys, "_st").groupBy(*keys, "_st", offset).agg(F.max_by(F.struct(*rest), row).alias("_x"))
    w = Window.partitionBy(*keys, "_st").orderBy(offset)
    begins = lambda first, before: F.when(first - before <= gap, 0).otherwise(1)
    rows = rows.withColumn("_new", begins(F.col(offset), F.lag(offset).over(w)))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = [F.min_by("_x", offset).alias("_first"), F.max_by("_x", offset).alias("_last")]
    parts = rows.groupBy(*keys, "_st", "_island").agg(F.min(offset).alias("_a"), F.max(offset).alias("_b"), F.count(F.lit(1)).alias("_n"), F.sum(f"_x.{hits}").alias("_hits"), *ends)
    # Only a stretch's first and last island can go on in another stretch; the others are done.
    of_stretch = Window.partitionBy(*keys, "_st")
    inside = (F.col("_island") > 1) & (F.col("_island") < F.max("_island").over(of_stretch))
    parts = parts.withColumn("_done", F.when(inside, F.struct("_st", "_island")))
    side = Window.partitionBy(*keys, "_done").orderBy("_a")
    parts = parts.withColumn("_new", begins(F.col("_a"), F.lag("_b").over(side)))
    parts = parts.withColumn("_island", F.sum("_new").over(side.rowsBetween(Window.unboundedPreceding, 0)))
    aggs = [F.min("_a").alias("first_offset"), F.sum("_n").alias("duration"), F.sum("_hits").cast("bigint").alias("hits"), F.min_by("_first", "_a").alias("_first"), F.max_by("_last", "_a").alias("_last")]
    out = parts.groupBy(*keys, "_done", "_island").agg(*aggs)
    out = out.select(*keys, "first_offset", "duration", "hits", F.col(f"_last.{hits}").alias("_own"), *[F.col(f"_first.{c}").alias(c) for c in keep_first], *[F.col(f"_last.{c}").alias(c) for c in keep_last])
    q = F.col("hits") / F.col("duration")
    avg = F.when(q == F.floor(q), F.col("_own").cast("double")).otherwise(F.round(q, 3)) if average == "odd" else half_up(q, 1)
    return out.withColumn("average_hits", avg).drop("_own")


def similarity_runs(df: DataFrame, by: list[str], order: list[str], score: str, first: str, least: float, stretch: Column | None = None) -> DataFrame:
    """Runs of more than one row in which each row but the last scores ``least`` or more with the next one.

    ``score`` stands at the earlier row of each pair.  Columns ``by``, first_image, n_images.
    """
    o = Ordering(by, order, stretch)
    out = o.neighbour(df, {score: "_before"}, keep=True)
    out = o.running_sum(out, F.when(F.col("_before") >= least, 0).otherwise(1), "_run")
    runs = out.groupBy(*by, "_run").agg(F.min_by(first, F.struct(*order)).alias("first_image"), F.count(F.lit(1)).alias("n_images"))
    return runs.filter("n_images > 1").drop("_run")


def first_seen_ids(df: DataFrame, key: str, row: str, start: int = 0) -> DataFrame:
    """Columns key, id: dense ids in the order in which keys first appear.  The keys, not the rows, are ranked."""
    seen = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("_r"))
    return global_rank(seen, ["_r"], "id", start).select(key, "id")


def majority_vote(df: DataFrame, by: list[str], value: str, row: str) -> DataFrame:
    """The most frequent value of each group at every one of its rows; of equally frequent ones the first met.

    Groups with one distinct value, or none, stay as they are, their nulls included.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("r"))
    best = counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("n"), "r")).alias("_best"), F.count(F.lit(1)).alias("_kinds"))
    out = df.join(best.withColumnsRenamed({b: f"_b_{b}" for b in by}), _null_safe(by), "left")
    return out.withColumn(value, F.when(F.col("_kinds") > 1, F.col("_best")).otherwise(F.col(value))).select(*df.columns)


def round_robin(df: DataFrame, by: str, side: Column, name: str) -> DataFrame:
    """Pairs the i-th member of either side of each group, the shorter side starting over; an empty side is null.

    Members are in the order of their names; those of the longer side come out once each.  A group without two members
    on one side gives none; rows with a null group, side or name are left out.
    """
    rows = df.select(F.col(by).alias("g"), side.alias("s"), F.col(name).alias("v")).dropna()
    rows = rank_in_group(rows, ["g", "s"], ["v"], "i", 0)
    n = rows.groupBy("g").agg(F.count_if(F.col("s")).alias("a"), F.count_if(~F.col("s")).alias("b"))
    every = rows.join(n, "g").filter(F.greatest("a", "b") > 1)
    own, other = F.when(F.col("s"), F.col("a")).otherwise(F.col("b")), F.when(F.col("s"), F.col("b")).otherwise(F.col("a"))
    # Of sides of one length the first leads.
    lead = every.filter((own > other) | ((own == other) & F.col("s"))).select("g", "i", "s", F.col("v").alias("x"), F.when(other > 0, F.col("i") % other).alias("j"))
    rest = rows.select("g", F.col("i").alias("j"), (~F.col("s")).alias("s"), F.col("v").alias("y"))
    out = lead.join(rest, ["g", "s", "j"], "left")
    left, right = F.when(F.col("s"), F.col("x")).otherwise(F.col("y")), F.when(F.col("s"), F.col("y")).otherwise(F.col("x"))
    return out.select(F.col("g").alias(by), F.col("i").cast("int").alias("i"), left.alias("left_name"), right.alias("right_name"))


def duplicate_split(df: DataFrame, key: str) -> DataFrame:
    """Column is_duplicate: whether the key stands in more than one row.  A null key is a key like others."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(key, "_b")
    return df.join(n, F.col(key).eqNullSafe(F.col("_b"))).withColumn("is_duplicate", F.col("_n") > 1).select(*df.columns, "is_duplicate")


def carry_over(df: DataFrame, by: list[str], order: list[str], col: str, to: str, stretch: Column | None = None) -> DataFrame:
    """The previous row's value beside each row."""
    return Ordering(by, order, stretch).neighbour(df, {col: to})


def greedy_groups(df: DataFrame, by: list[str], target: str, member: str, order: list[str]) -> DataFrame:
    """First come, first served: a pair's member joins the target's group unless either is in another group already.

    Pairs are taken in order within ``by``.  Columns by, target, member of the pairs that were taken.
    """
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        claimed: set = set()
        keep = []
        for t, m in pdf.sort_values(order)[[target, member]].itertuples(index=False):
            keep.append(t not in claimed and m not in claimed and t != m)
            if keep[-1]:
                claimed.add(m)
        return pdf.sort_values(order)[keep][[*by, target, member]]

    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in [*by, target, member])
    return df.groupBy(*by).applyInPandas(run, shape)
