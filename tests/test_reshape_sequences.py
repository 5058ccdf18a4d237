from pyspark.sql import functions as F

from framewright.operators import aggregate, joins, reshape, sequences, setops
from framewright.operators.ordered import global_rank, ordered_chunks


def test_expand_and_compact(spark, rows):
    df = spark.createDataFrame([("f", "a", 10, 3, 7), ("f", "a", 20, 1, 1), ("f", "a", 30, 0, 1), ("f", "a", 40, -1, 1), ("f", None, 1, 2, 1), ("f", "b", 5, None, 1)], "file string, brand string, frame_no long, duration int, total_hits int")
    out = reshape.expand_duration(df)
    assert rows(out.select("frame_no").filter("brand = 'a'")) == [(10,), (11,), (12,), (20,)]
    keys = ["file", "brand"]
    want = rows(reshape.compact(out, keys, ["duration", "total_hits"], "frame_no"))
    assert want == rows(reshape.compact_expanded(df, keys)) == [("f", "a", 4, 4, 10)]
    assert reshape.expand_duration(df.limit(0)).collect() == []


def test_expand_padded(spark, rows):
    df = spark.createDataFrame([(1, "a_b_009", 2), (2, "99", 2), (3, "x", 3), (4, None, 2), (5, "a_1", 0)], "id int, frame string, duration int")
    assert rows(reshape.expand_padded(df).select("id", "frame")) == [(1, "a_b_009"), (1, "a_b_010"), (2, "100"), (2, "99")]


def test_range_split(spark):
    def split(a, b, n):
        df = spark.createDataFrame([(a, b, n)], "a long, b long, n int")
        return sorted((r.first_frame, r.last_frame) for r in reshape.split_range(df, "a", "b", "n").collect())

    assert split(0, 100, 3) == [(0, 32), (33, 66), (67, 100)]
    assert split(0, 10, 4) == [(0, 1), (2, 4), (5, 7), (8, 10)]
    for a, b, n in [(0, 1000, 7), (5, 500, 10), (3, 200, 3), (0, 99, 9), (1, 401, 20)]:
        parts = split(a, b, n)
        assert parts[0][0] == a and parts[-1][1] == b and all(x[1] + 1 == y[0] for x, y in zip(parts, parts[1:], strict=False))


def test_chunks_and_bins(spark):
    df = spark.createDataFrame([("v", i, 10 if i != 4 else 100) for i in range(10)], "v string, i int, n int")
    sizes = lambda d: [r["count"] for r in d.groupBy("part").count().orderBy("part").collect()]
    assert sizes(reshape.chunks(df, ["v"], ["i"], 4)) == [2, 2, 2, 4]
    assert sizes(reshape.chunks(df, ["v"], ["i"], 4, "first")) == [3, 3, 2, 2]
    bins = {r.i: r.part for r in reshape.fill_bins(df, ["v"], ["i"], "n", 30).collect()}
    assert [bins[i] for i in range(10)] == [0, 0, 0, 1, 2, 3, 3, 3, 4, 4]
    sides = reshape.take_exact(df.select("i"), "i", 0.75).groupBy("side").count().collect()
    assert {r.side: r["count"] for r in sides} == {"train": 7, "val": 3}


def test_nested(spark):
    df = spark.createDataFrame([("i", "b", "t", 2), ("i", "a", "t", 1), ("j", "a", "u", 1)], "image string, brand string, tpoint string, n int")
    nested = reshape.nest_boxes(df, "image", ["brand", "tpoint"], ["n"])
    assert {r.image: [b.brand for b in r.annotations] for r in nested.collect()} == {"i": ["a", "b"], "j": ["a"]}
    kept = joins.keep_boxes(nested, [("a", "t")])
    assert [(r.image, len(r.annotations)) for r in kept.collect()] == [("i", 1)]


def test_flags(spark, rows):
    df = spark.createDataFrame([(1, 1, 0, None), (2, 0, 1, 1)], "id int, x int, y int, z int")
    assert rows(reshape.unpivot_flags(df, ["id"], ["x", "y", "z"]).select("id", "sponsor")) == [(1, "x"), (2, "y"), (2, "z")]


def seq(spark, values, col="v"):
    return spark.createDataFrame([("p", i, v, "extra") for i, v in enumerate(values)], f"p string, i int, {col} string, pos0 string")


def test_runs(spark):
    out = sequences.run_index(seq(spark, ["A", "A", "B", "A"]), ["p"], ["i"], ["v"]).orderBy("i").collect()
    assert [(r.run, r.pos) for r in out] == [(1, 1), (1, 2), (2, 1), (3, 1)]
    out = sequences.run_index(seq(spark, ["A", None, None, "A"]), ["p"], ["i"], ["v"]).orderBy("i").collect()
    assert [r.run for r in out] == [1, 2, 3, 4]
    runs = spark.createDataFrame([(1,), (2,), (3,)], "r int")
    assert [r[0] for r in runs.select(sequences.half_innings(F.col("r"))).collect()] == ["Top 1", "Bottom 1", "Top 2"]
    assert [r[0] for r in runs.select(sequences.half_innings(F.col("r"), 7)).collect()] == ["Top 7", "Bottom 8", "Top 8"]


def test_fills(spark):
    df = seq(spark, [None, "x", None, "y"])
    get = lambda d: [r.v for r in d.orderBy("i").collect()]
    filled = sequences.forward_fill(df, ["p"], ["i"], ["v"])
    assert get(filled) == [None, "x", "x", "y"]
    assert get(sequences.leading_fill(filled, ["p"], ["i"], ["v"])) == ["x", "x", "x", "y"]
    assert get(sequences.leading_fill(seq(spark, [None, None]), ["p"], ["i"], ["v"])) == [None, None]


def test_consecutive_merge(spark):
    data = [("k", 1, 1, "a", 1), ("k", 2, 3, "b", 2), ("k", 4, 9, "c", 3), ("k", 4, 2, "d", 4), (None, 1, 1, "e", 5), ("m", 1, 1, "f", 6), ("m", 2, 2, "g", 7)]
    df = spark.createDataFrame(data, "k string, o long, h int, s string, r long")
    out = sequences.merge_consecutive(df, ["k"], "o", "h", ["s"], [], "r").orderBy("k", "first_offset").collect()
    assert [(r.k, r.first_offset, r.duration, r.hits, r.average_hits, r.s) for r in out] == [("k", 1, 2, 4, 3.0, "a"), ("k", 4, 1, 2, 2.0, "d"), ("m", 1, 2, 3, 1.5, "f")]
    tenth = sequences.merge_consecutive(df, ["k"], "o", "h", [], ["s"], "r", average="tenth").filter("k = 'm'").first()
    assert (tenth.average_hits, tenth.s) == (1.5, "g")


def test_similarity_runs(spark):
    df = spark.createDataFrame([("p", i, s, f"n{i}") for i, s in enumerate([0.99, 0.99, 0.5, 0.99, None])], "p string, i int, score double, name string")
    out = sequences.similarity_runs(df, ["p"], ["i"], "score", "name", 0.98).orderBy("first_image").collect()
    assert [(r.first_image, r.n_images) for r in out] == [("n0", 3), ("n3", 2)]


def test_vote(spark):
    df = spark.createDataFrame([(1, "P", 1), (1, "P", 2), (1, "Q", 3), (1, None, 4), (2, "Q", 5), (2, "P", 6), (3, None, 7), (3, "Z", 8)], "f int, v string, r long")
    out = {r.r: r.v for r in sequences.majority_vote(df, ["f"], "v", "r").collect()}
    assert out == {1: "P", 2: "P", 3: "P", 4: "P", 5: "Q", 6: "Q", 7: None, 8: "Z"}


def test_conflicts_pairs_ids(spark, rows):
    df = spark.createDataFrame([("p", 1, 1, "a"), ("p", 1, 2, "b"), ("p", 1, 3, None), ("p", 2, 4, "a")], "p string, f int, r long, v string")
    assert rows(sequences.adjacent_conflicts(df, ["p"], ["f", "r"], "f", "v").select("r", "next_value")) == [(1, "b"), (2, None)]
    assert rows(sequences.first_seen_ids(df, "v", "r")) == [("a", 0), ("b", 1)]
    rr = spark.createDataFrame([("h", "w1"), ("h", "w2"), ("h", "o1"), ("g", "o1"), ("g", "o2"), ("s", "w1")], "h string, n string")
    got = rows(sequences.round_robin(rr, "h", F.col("n").startswith("w"), "n"))
    assert got == [("g", 0, None, "o1"), ("g", 1, None, "o2"), ("h", 0, "w1", "o1"), ("h", 1, "w2", "o1")]
    greedy = spark.createDataFrame([("c", 1, 2, 0.1), ("c", 2, 3, 0.2), ("c", 1, 3, 0.3)], "c string, t int, m int, d double")
    assert rows(sequences.greedy_groups(greedy, ["c"], "t", "m", ["d"])) == [("c", 1, 2), ("c", 1, 3)]
    dup = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    assert rows(sequences.duplicate_split(dup, "k")) == [("x", True), ("x", True), (None, False)]


def test_joins(spark, rows):
    left = spark.createDataFrame([(7, "a"), (None, "b"), (8, "c")], "f int, x string")
    right = spark.createDataFrame([(7, "p", 1), (7, "q", 2), (None, "n", 3)], "f int, y string, r long")
    assert rows(joins.enrich(left, right.drop("r"), ["f"]).select("x", "y")) == [("a", "p"), ("a", "q"), ("b", "n"), ("c", None)]
    assert rows(joins.first_match(left, right, ["f"], "r").select("x", "y")) == [("a", "p"), ("b", "n"), ("c", None)]
    upd = spark.createDataFrame([("7", 2), ("7", 3), (None, 9)], "f string, n int")
    base = spark.createDataFrame([("7", 1, 1), ("9", 1, 1)], "f string, d int, h int")
    assert rows(joins.add_updates(base, upd, "f", "n", ["d", "h"])) == [("7", 6, 6), ("9", 1, 1)]
    new = spark.createDataFrame([("a", 2.5), ("b", 2.6), ("c", 1.0), ("z", 0.0)], "k string, v double")
    old = spark.createDataFrame([("a", 2.0), ("b", 2.0), ("c", 0.0), ("z", 0.0)], "k string, v double")
    assert rows(joins.history_diff(new, old, ["k"], "v").select("k", "difference")) == [("b", 30.0), ("c", float("inf"))]
    listed = spark.createDataFrame([("x",), ("y",)], "b string")
    present = spark.createDataFrame([("f", "x"), ("g", None)], "file string, b string")
    assert rows(joins.missing_per_file(listed, present, present, "b", "file")) == [("f", "y"), ("g", "x"), ("g", "y")]
    names = spark.createDataFrame([("im_000120.jpg",), ("none",), (None,)], "n string")
    assert [r[0] for r in names.select(joins.stripped_number(F.col("n"))).collect()] == [120, 0, 0]
    band = spark.createDataFrame([("p", i) for i in (1, 2, 5, 9)], "p string, i int")
    assert rows(joins.within_band(band, ["p"], "i", 3).select("pos_a", "pos_b")) == [(1, 2), (2, 1), (2, 5), (5, 2)]


def test_contained_names(spark, rows):
    bases = ["game_1", "game_10", "x", "é.b", "", None, "batters_game_10.csv_and_more"]
    names = ["batters_game_10.csv", "final_x-2.csv", "xx", "éé.bat", "", None, "batters_game_1"]
    one = lambda c, v: spark.createDataFrame([(x,) for x in [*v, v[0]]], f"{c} string")
    got = rows(joins.contained_in(one("base", bases), one("name", names), "base", "name"))
    assert got == sorted((b, n) for b in bases for n in names if b is not None and n is not None and b in n)


def test_sets(spark, rows):
    a = spark.createDataFrame([("r",), ("r",), ("s",), ("t",), (None,)], "x string")
    assert rows(setops.only_once_in(a, spark.createDataFrame([("t",)], "x string"))) == [("s",), (None,)]
    assert setops.only_once_in(a, a).collect() == []
    left, right = spark.createDataFrame([(1, "a\nb\nb\nc")], "k int, t string"), spark.createDataFrame([(1, "a\nd")], "k int, t string")
    assert rows(setops.line_diff(left, right, "k", "t")) == sorted([(1, "+", 1, "d"), (1, "-", 1, "b"), (1, "-", 2, "b"), (1, "-", 3, "c")], key=lambda r: tuple((False, str(v)) for v in r))
    m = spark.sql("SELECT map('a', array(1), 'b', array(2)) l, map('b', array(3), 'a', array(), 'c', array(4)) i")
    got = m.select(setops.merged_map(F.col("l"), F.col("i"))).first()[0]
    assert got == {"a": [1], "b": [3], "c": [4]}
    u = setops.union_by_name(spark.sql("SELECT 1 a"), spark.sql("SELECT 2 b"))
    assert rows(u) == [(1, None), (None, 2)]


def test_aggregates(spark, rows):
    df = spark.createDataFrame([("f", "a", "l", 10, 5, 1), ("f", "a", "l", 20, 5, 2), ("f", None, "l", 90, 10, 3)], "file string, brand string, location string, frame_no long, duration int, row_id long")
    out = aggregate.normalised_exposure(df, "file", ["brand", "location"], "frame_no", "duration", "row_id").first()
    assert (out.total_frames, out.total_duration, out.avg_total_duration) == (90, 10, 2.197)
    assert rows(aggregate.joined_set(df, ["location"], "brand", "b")) == [("l", "a")]


def test_ranks_over_partitions(spark):
    df = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "x int")
    got = global_rank(df, ["x"], "r").collect()
    assert all(r.r == r.x + 1 for r in got) and len(got) == 1000
    held, around = ordered_chunks(df, ["x"], 3)
    assert held.count() == 1000 and sorted(around) == list(range(4))
    assert [len(around[0][0]), len(around[3][1])] == [0, 0]
    before = [r["x"] for r in around[2][0]]
    assert before == list(range(before[0], before[0] + 3)) and around[1][1][0]["x"] == before[-1] + 1


def test_places_in_groups_of_any_size(spark):
    import random

    from framewright.operators.ordered import rank_in_group

    random.seed(6)
    data = [(random.choice(["hot"] * 6 + ["a", "b", None]), random.choice([None, *range(500)]), i, "x") for i in range(2000)]
    df = spark.createDataFrame(data, "g string, o int, id int, place string").withColumnRenamed("place", "v")
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    want = {}
    for g in {r[0] for r in data}:
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in data if r[0] == g), key=key), 1)}
    for parts, batch in (("1", "10000"), ("7", "13"), ("40", "100")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        assert {r.id: r.n for r in rank_in_group(df, ["g"], ["o", "id"], "n").collect()} == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rank_in_group(df.limit(0), ["g"], ["o", "id"], "n").collect() == []
