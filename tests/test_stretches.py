import random

import pytest
from pyspark.sql import functions as F

from framewright.operators import sequences
from framewright.operators.stretches import Ordering, frames


@pytest.fixture(scope="module")
def data():
    random.seed(9)
    return [(random.choice(["a", "b", None]), random.choice([None, *range(60)]), i, random.choice(["x", "y", None, None]), random.randrange(3), "extra") for i in range(300)]


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "g string, f long, r long, v string, n int, _sum string")


def groups(data):
    key = lambda x: (x[1] is not None, x[1] or 0, x[2])
    for g in ("a", "b", None):
        yield sorted((x for x in data if x[0] == g), key=key)


@pytest.mark.parametrize("stretch", [None, 1, 7, 1 << 14])
def test_against_loops(data, df, stretch):
    o = Ordering(["g"], ["f", "r"], None if stretch is None else frames("f", stretch))
    sums = {r.r: r.s for r in o.running_sum(df, F.col("n"), "s").collect()}
    places = {r.r: r.p for r in o.row_number(df, "p").collect()}
    last = {r.r: r.l for r in o.last_values(df, {"v": "l", "n": "m"}).collect()}
    before = {r.r: (r.b, r.c) for r in o.neighbour(df, {"r": "b", "v": "c"}).collect()}
    behind = {r.r: r.b for r in o.neighbour(df, {"r": "b"}, behind=True).collect()}
    for rows in groups(data):
        total, seen = 0, None
        for i, (_, _, r, v, n, _) in enumerate(rows):
            total, seen = total + n, v if v is not None else seen
            assert (sums[r], places[r], last[r]) == (total, i + 1, seen)
            assert before[r] == ((rows[i - 1][2], rows[i - 1][3]) if i else (None, None))
            assert behind[r] == (rows[i + 1][2] if i + 1 < len(rows) else None)


@pytest.mark.parametrize("width", [1, 5])
def test_operators_are_alike_with_and_without(df, rows, width):
    s = frames("f", width)
    d = df.drop("_sum")
    args = (["g"], ["f", "r"])
    d = d.withColumn("same", F.lit(1)).withColumn("half", F.col("f") > 40)
    for values in (["v"], ["n"], ["same"], ["half"], ["same", "half"]):
        assert rows(sequences.run_index(d, *args, values, s)) == rows(sequences.run_index(d, *args, values))
    assert rows(sequences.forward_fill(d, *args, ["v", "n"], s)) == rows(sequences.forward_fill(d, *args, ["v", "n"]))
    assert rows(sequences.adjacent_conflicts(d, *args, "f", "v", s)) == rows(sequences.adjacent_conflicts(d, *args, "f", "v"))
    merge = lambda **k: rows(sequences.merge_consecutive(d, ["g", "v"], "f", "n", ["r"], [], "r", **k))
    assert merge(stretch=s) == merge()
    runs = lambda **k: rows(sequences.similarity_runs(d.withColumn("n", F.col("n").cast("double")), *args, "n", "r", 1.0, **k))
    assert runs(stretch=s) == runs()
