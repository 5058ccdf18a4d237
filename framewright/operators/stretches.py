"""Running sums, last values and neighbours within an order, without one task per group.

An ``Ordering`` may name a stretch: an expression of the order's first column that never falls (a bucket of frames).  Each
stretch is then a window of its own, and what has to come from the stretches before it, or after it, is taken from one
row per stretch.  A group of any size is so spread over as many tasks as it has stretches.

With a stretch the rows are shuffled once, by group and stretch; their summaries come off the same shuffle, and steps on
one ordering that follow one another keep its partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames in a stretch where queries cut by frame.
WIDTH = 1 << 14


def frames(column: str, width: int = WIDTH) -> Column:
    return F.floor(F.col(column) / width)


@dataclass(frozen=True)
class Ordering:
    by: list[str]
    order: list[str]
    stretch: Column | None = None

    def window(self):
        return Window.partitionBy(*(self.by if self.stretch is None else ["_by", "_st"])).orderBy(*self.order)

    def marked(self, df: DataFrame) -> DataFrame:
        """``df`` shuffled by group and stretch, which stay as ``_by`` and ``_st``; structs, as nulls are equal there."""
        if self.stretch is None or "_st" in df.columns:
            return df
        return df.withColumns({"_by": F.struct(F.lit(0).alias("_"), *self.by), "_st": F.struct(self.stretch.alias("at"))}).repartition("_by", "_st")

    @staticmethod
    def unmarked(df: DataFrame) -> DataFrame:
        return df.drop("_by", "_st")

    def carried(self, df: DataFrame, summary: Column, carry) -> DataFrame:
        """Marked rows with ``_carry``: what ``carry`` makes of the summaries of the other stretches of their group."""
        per = df.groupBy("_by", "_st").agg(summary.alias("_sum"))
        per = per.select("_by", "_st", carry(Window.partitionBy("_by").orderBy("_st")).alias("_carry"))
        return df.join(per, ["_by", "_st"], "left")

    def running_sum(self, df: DataFrame, flag: Column, name: str) -> DataFrame:
        """The sum of ``flag`` over all rows up to each row."""
        d = self.marked(df).withColumn("_flag", flag)
        local = F.sum("_flag").over(self.window().rowsBetween(Window.unboundedPreceding, 0))
        if self.stretch is None:
            return d.withColumn(name, local).drop("_flag")
        before = lambda w: F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1))
        d = self.carried(d, F.sum("_flag"), before)
        return self.unmarked(d.withColumn(name, local + F.coalesce("_carry", F.lit(0))).drop("_flag", "_carry"))

    def row_number(self, df: DataFrame, name: str) -> DataFrame:
        return self.running_sum(df, F.lit(1), name)

    def last_values(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """The last values up to each row that aren't null, under the given names."""
        d = self.marked(df)
        upto = self.window().rowsBetween(Window.unboundedPreceding, 0)
        local = {c: F.last(c, ignorenulls=True).over(upto) for c in columns}
        if self.stretch is None:
            return d.withColumns({name: local[c] for c, name in columns.items()})
        fields = {c: f"f{i}" for i, c in enumerate(columns)}
        latest = F.struct(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*self.order))).alias(f) for c, f in fields.items()])

        def before(w):
            past = w.rowsBetween(Window.unboundedPreceding, -1)
            return F.struct(*[F.last(f"_sum.{f}", ignorenulls=True).over(past).alias(f) for f in fields.values()])

        d = self.carried(d, latest, before)
        return self.unmarked(d.withColumns({name: F.coalesce(local[c], F.col(f"_carry.{fields[c]}")) for c, name in columns.items()}).drop("_carry"))

    def neighbour(self, df: DataFrame, columns: dict[str, str], behind: bool = False, keep: bool = False) -> DataFrame:
        """The columns of the row before (or behind) each row under the given names; null at the end of a group.

        ``keep`` leaves the marks for a step that follows.
        """
        d = self.marked(df)
        row = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(columns)])
        move = F.lead if behind else F.lag
        local = move(row).over(self.window())
        if self.stretch is None:
            d = d.withColumn("_n", local)
        else:
            edge = (F.min_by if behind else F.max_by)(row, F.struct(*self.order))
            d = self.carried(d, edge, lambda w: move("_sum").over(w)).withColumn("_n", F.coalesce(local, F.col("_carry"))).drop("_carry")
        d = d.withColumns({name: F.col(f"_n.f{i}") for i, name in enumerate(columns.values())}).drop("_n")
        return d if keep else self.unmarked(d)
