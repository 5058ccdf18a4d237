import random

from pyspark.sql import functions as F

from framewright.operators.intervals import periods_and_gaps
from framewright.plans import pipelines
from framewright.streaming import ledger


def write_parts(spark, data, schema, path, n=3):
    for i in range(n):
        spark.createDataFrame(data[i::n], schema).coalesce(1).write.mode("append").parquet(path)


def test_ledger_over_files_and_restarts(spark, tmp_path, rows):
    schema = "brand string, location string, duration int"
    data = [(random.choice(["a", "b", None]), "l", i) for i in range(30)]
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_parts(spark, data, schema, src)
    kind = spark.read.parquet(src).schema
    want = lambda d: sorted((b, "l", sum(x for y, _, x in d if y == b), sum(y == b for y, _, _ in d)) for b in {r[0] for r in d if r[0]})
    got = ledger.cumulative_totals(ledger.file_stream(spark, src, kind, files_per_batch=1), ["brand", "location"], "duration", out, ck)
    assert rows(got) == want(data)
    more = [("c", "l", 5), ("a", "l", 7)]
    write_parts(spark, more, schema, src, 1)
    got = ledger.cumulative_totals(ledger.file_stream(spark, src, kind), ["brand", "location"], "duration", out, ck)
    assert rows(got) == want(data + more)


def test_sessions(spark, rows):
    df = spark.createDataFrame([("a", f) for f in (1, 2, 3, 7, 8, 20)] + [("b", 3)], "k string, f long")
    assert rows(ledger.frame_sessions(df, ["k"], "f")) == [("a", 1, 3, 3), ("a", 20, 20, 1), ("a", 7, 8, 2), ("b", 3, 3, 1)]


def test_interval_state_equals_batch(spark, tmp_path, rows):
    random.seed(6)
    data = [(random.choice("xy"), a := random.randrange(200), a + random.randrange(9)) for _ in range(60)]
    src = str(tmp_path / "in")
    write_parts(spark, data, "k string, a long, b long", src)
    stream = ledger.file_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    last = {}

    def keep(batch, n):
        got = batch.collect()
        for k in {r.k for r in got}:
            last[k] = sorted((r.k, r.kind, r["first"], r["last"]) for r in got if r.k == k)

    out = ledger.interval_updates(stream, ["k"], "a", "b")
    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    want = sorted(tuple(r) for r in periods_and_gaps(spark.createDataFrame(data, "k string, a long, b long"), ["k"], "a", "b").collect())
    assert sorted(x for v in last.values() for x in v) == want


COLS = "file string, frame_no long, row_id long, brand string, location string, duration int, screen_time string, screen_location string, screen_size_pct double, average_hits double"


def test_player_sheet(spark, rows):
    def exp(frame, row, brand, loc, d):
        return ("f", frame, row, brand, loc, d, "t", "A", 1.0, 1.0)

    home = spark.createDataFrame([exp(1, 1, "Acme", "Board", 4), exp(5, 2, "Bolt", "Board", 2)], COLS)
    bat = spark.createDataFrame([exp(2, 1, "Reds", "7 - Able", 1), exp(4, 2, "Blues", "8 - Baker", 1)], COLS)
    out = pipelines.player_sheet(home, bat)
    got = sorted((r.brand, r.player, r.inning, r.frame_no, r.duration) for r in out.collect())
    assert got == [("Acme", "7 - Able", "Top 1", 1, 3), ("Acme", "8 - Baker", "Bottom 1", 4, 1), ("Bolt", "8 - Baker", "Bottom 1", 5, 2)]


def test_history(spark, rows):
    e = spark.createDataFrame([("new", "a", "l", 0, 50, 1), ("new", "b", "l", 50, 50, 2), ("old", "a", "l", 0, 9, 3)], "file_name string, brand string, location string, frame_no long, duration int, row_id long")
    held = spark.createDataFrame([("old", "a", "l", 3.0)], "file_name string, brand string, location string, avg_total_duration double")
    ledger_rows, off, fresh = pipelines.checked_against_history(e, held)
    assert rows(ledger_rows.select("file_name", "brand", "total_frames", "total_duration")) == [("new", "a", 100, 50), ("new", "b", 100, 50)]
    assert rows(off.select("brand", "new_value", "old_value")) == [("a", 0.693, 3.0)]
    assert rows(fresh.select("brand")) == [("b",)]


def test_history_is_the_whole_ledger(spark, rows, tmp_path):
    from framewright.queries.pipelines import QUERIES

    e = "row_id long, file_name string, frame string, brand string, location string, duration int"
    spark.createDataFrame([(1, "new", "0", "a", "l", 50), (2, "new", "50", "b", "l", 50), (3, "late", "0", "a", "l", 9), (4, "odd", "0", "a", "l", 9)], e).write.parquet(f"{tmp_path}/exposures.parquet")
    held = [("early", "a", "l", 2.0, "2011-01-01"), ("late", "a", "l", 4.0, "2011-03-01"), ("odd", "a", "l", float("nan"), "2011-03-01")]
    t = spark.createDataFrame(held, "file_name string, brand string, location string, avg_total_duration double, d string")
    t.withColumn("processed_at", t.d.cast("timestamp_ntz")).drop("d").write.parquet(f"{tmp_path}/results_ledger.parquet")
    got = QUERIES["q_history_check_whole"](spark, str(tmp_path))
    assert rows(got.select("brand", "location", "new_value", "old_value")) == [("a", "l", 0.693, 3.0)]


def test_reduce_and_restore(spark, rows):
    edges = spark.createDataFrame([("v", i, f"{i:03d}.jpg", s) for i, s in enumerate([0.99, 0.99, 0.2, 0.1])], "v string, i int, target_image string, score double")
    runs = pipelines.reduced_frames(edges, ["v"], ["i"])
    assert rows(runs.select("first_image", "n_images")) == [("000.jpg", 3)]
    ann = spark.createDataFrame([("0000", 1, 1), ("0003", 1, 1)], "frame string, duration int, total_hits int")
    assert rows(pipelines.restored_durations(ann, runs).select("frame", F.col("duration"))) == [("0000", 4), ("0003", 1)]


def test_social_report(spark, rows):
    art = spark.createDataFrame([("1", "u", "x", 5), ("2", "v", "y", 6)], "art_id string, user string, url string, followers long")
    text = spark.createDataFrame([("1", "Acme", "Text")], "art_id string, sponsor string, touchpoint string")
    photo = spark.createDataFrame([("1", "p", "photo", "t", 1.0), ("3", "q", "Bolt", "t", 2.0)], "art_id string, photo_url string, sponsor string, touchpoint string, percentage double")
    got = rows(pipelines.social_report(art, text, photo).select("report_id", "art_id", "url", "sponsor"))
    assert got == [(1, "1", "x", "Acme"), (2, "2", "y", None), (3, "3", "q", "Bolt")]
