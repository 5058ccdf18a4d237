import random

import pytest

from framewright.operators.intervals import IntervalMap, periods_and_gaps


def brute(rows):
    out = []
    for k in {r[0] for r in rows if r[0] is not None}:
        covered = sorted({x for kk, a, b in rows if kk == k and a is not None and b is not None for x in range(a, b + 1)})
        begin = covered[0] if covered else None
        for x, y in zip(covered, [*covered[1:], None], strict=False):
            if y != x + 1:
                out.append((k, "period", begin, x))
                if y is not None:
                    out.append((k, "gap", x + 1, y - 1))
                begin = y
    return sorted(out)


def test_map_any_order():
    random.seed(1)
    for _ in range(200):
        parts = [(a := random.randrange(60), a + random.randrange(8)) for _ in range(25)]
        m = IntervalMap()
        grown = sum(m.add(a, b) for a, b in parts)
        assert grown == len(m)
        assert [("x", "period", a, b) for a, b in zip(m.starts, m.ends, strict=True)] == [r for r in brute([("x", *p) for p in parts]) if r[1] == "period"]
        assert m.gaps() == [r[2:] for r in brute([("x", *p) for p in parts]) if r[1] == "gap"]


@pytest.mark.parametrize(("bucket", "held"), [(5, 3), (16, 10), (1 << 15, 200_000)])
def test_periods_and_gaps(spark, bucket, held):
    random.seed(bucket)
    data = [(random.choice("ab"), a := random.randrange(300), a + random.choice([0, 1, 2, 3, 40])) for _ in range(60)] + [("c", 7, 7)]
    data += [(None, 1, 2), ("d", None, 2), ("e", 1, None), ("f", 5, 4), *data[:5]]
    df = spark.createDataFrame([(*r, "x") for r in data], "k string, a long, b long, kind string")
    got = sorted(tuple(r) for r in periods_and_gaps(df, ["k"], "a", "b", bucket=bucket, held=held).collect())
    assert got == brute([r for r in data if r[0] != "f"])


def test_one_entity_over_many_buckets(spark):
    df = spark.createDataFrame([("a", 3, 100), ("a", 101, 200), ("a", 300, 300)], "k string, a long, b long")
    got = sorted(tuple(r) for r in periods_and_gaps(df, ["k"], "a", "b", bucket=10).collect())
    assert got == [("a", "gap", 201, 299), ("a", "period", 3, 200), ("a", "period", 300, 300)]


def test_empty(spark):
    df = spark.createDataFrame([], "k string, a long, b long")
    assert periods_and_gaps(df, ["k"], "a", "b").collect() == []
