import math
import random
from datetime import datetime, timedelta

import numpy as np

from framewright.operators.spikes import flag_readings, haar_details, stuck_runs

T0 = datetime(2020, 1, 1)


def flag(spark, data, **how):
    df = spark.createDataFrame(data, "src string, loc string, at timestamp_ntz, v double, id long, value string")
    return sorted((r.id, r.kind) for r in flag_readings(df, ["src", "loc"], "at", "v", "id", **how).collect())


def series(values, src="s", loc="l", start=0):
    return [(src, loc, T0 + timedelta(hours=i), v, start + i, "x") for i, v in enumerate(values)]


def test_kinds(spark):
    random.seed(4)
    x = [round(random.gauss(2, 0.02), 3) for _ in range(120)]
    x[10], x[20], x[21], x[30], x[31], x[40] = 2.4, 1.6, 1.6, -1.0, math.nan, math.inf
    x[50:56] = [2.011] * 6
    x[70:75] = [2.012] * 5
    data = series(x)
    data += [("s", "l", T0 + timedelta(hours=10), 2.4, 900, "x"), ("s", "l", T0, None, 901, "x")]
    for size in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", size)
        got = flag(spark, data)
        want = [(10, "spike"), (900, "spike"), (20, "spike"), (21, "spike"), (30, "impossible"), (31, "impossible"), (40, "impossible")]
        assert got == sorted(want + [(i, "stuck") for i in range(50, 56)])
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_long_source_over_partitions_and_batches(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(5, 0.1, 3000), 3).tolist()
    x[1000:1010] = [5.001] * 10
    for i in (5, 777, 1500, 2999):
        x[i] = 9.0
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    got = flag(spark, series(x))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted([(i, "stuck") for i in range(1000, 1010)] + [(i, "spike") for i in (5, 777, 1500, 2999)])


def test_stuck_counts_times_not_deliveries(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(5, 0.1, 40), 3).tolist()
    x[10:15] = [5.5] * 5
    data = series(x)
    data += [(*r[:4], r[4] + 500, "x") for r in data[10:15]]
    assert [k for k in flag(spark, data) if k[1] == "stuck"] == []


def test_small_and_null_sources(spark):
    data = series([1.0]) + series([1.0, 2.0], src="b", start=10) + series([3.0, 30.0], src=None, start=20)
    assert flag(spark, data) == [(21, "impossible")]
    assert flag(spark, []) == []
    constant = series([1.0, 1.0, 1.0, 1.0, 1.0, 4.0, 1.0, 1.0, 1.0, 1.0, 1.0])
    assert flag(spark, constant) == [(5, "spike")]


def test_haar():
    d = haar_details(np.array([1.0, 1, 1, 5, 1, 1, 1, 1]))
    assert d[0, 1] == 0 and abs(d[0, 3]) > 2 and abs(d[0, 4]) > 2
    finest = haar_details(np.array([1.0, 2, 2, 2, 3]), 1)[0]
    assert stuck_runs(finest, 3).tolist() == [False, True, True, True, False]
    assert stuck_runs(np.zeros(0), 3).tolist() == []


def test_same_over_any_partitions_with_repeated_rows(spark):
    rng = np.random.default_rng(9)
    data = []
    for s in range(12):
        x = np.round(rng.normal(s, 0.05, 90), 3).tolist()
        x[7], x[30], x[60] = s + 2.0, -1.0, math.nan
        x[40:47] = [s + 0.01] * 7
        data += series(x, src=None if s == 3 else f"s{s}", loc=None if s % 5 == 0 else "l", start=1000 * s)
    data += [(*r[:4], r[4] + 500, "x") for r in data for _ in range(3 if r[4] % 40 < 20 else 0)]
    random.seed(1)
    random.shuffle(data)
    found = []
    for n, batch in (("1", "10000"), ("5", "17"), ("23", "100")):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        found.append(flag(spark, data))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1] == found[2]
    kinds = [k for _, k in found[0]]
    assert kinds.count("spike") >= 12 and kinds.count("stuck") >= 12 * 7 and kinds.count("impossible") >= 24
