import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import names, numbers
from framewright.operators import columns, images, joins, setops
from framewright.sinks import files as sinks
from framewright.sources import lists
from framewright.streaming import ledger


def test_missing_per_file_in_parts(spark, rows, monkeypatch):
    listed = spark.createDataFrame([(x,) for x in "abcdefa"] + [(None,)], "brand string")
    present = spark.createDataFrame([("f", "a", 1), ("f", "a", 2), ("g", "z", 1), ("h", None, 1), (None, "b", 1)], "file string, brand string, n int")
    want = sorted((f, b) for f, held in (("f", "a"), ("g", ""), ("h", "")) for b in "abcdef" if b not in held)
    for at_once in (1, 4, 10_000):
        monkeypatch.setattr(joins, "NAMES_AT_ONCE", at_once)
        assert rows(joins.missing_per_file(listed, present, present, "brand", "file")) == want
    assert joins.missing_per_file(listed.limit(0), present, present, "brand", "file").collect() == []
    assert joins.missing_per_file(listed, present.limit(0), present.limit(0), "brand", "file").collect() == []


def test_runs_meet_frames_row_by_row(spark, rows):
    ann = spark.createDataFrame([("0003", 1, 1), ("x_0003", 1, 1), (None, 1, 1), ("y", 2, 2)], "frame string, duration int, total_hits int")
    runs = spark.createDataFrame([("0003.jpg", 5), ("x_0003.jpg", 7), ("x_0003.jpeg", 1), ("odd.jpg", 9), (None, 9), ("0.jpg", 50)], "image string, n int")
    got = rows(joins.add_runs(ann, runs, "frame", "image", "n", ["duration"]))
    # A number meets every frame of that number, a prefix only its own name.
    assert got == sorted([("0003", 6, 1), ("x_0003", 14, 1), (None, 1, 1), ("y", 2, 2)], key=lambda r: tuple((v is None, str(v)) for v in r))
    other_order = runs.orderBy(F.desc("n"))
    assert rows(joins.add_runs(ann, other_order, "frame", "image", "n", ["duration"])) == got
    assert rows(joins.add_runs(ann, runs.limit(0), "frame", "image", "n", ["duration"])) == rows(ann.withColumn("duration", F.col("duration").cast("bigint")))


def test_join_back_and_groups(spark, rows):
    t = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("b", "x", 2)], "k string, l string, v int")
    assert rows(joins.join_back(t.select("k", "l"), t, ["k", "l"])) == [("a", None, 1), ("b", "x", 2)]
    groups = spark.createDataFrame([("a", "g2"), ("a", "g1"), (None, "g3")], "k string, l string")
    assert rows(joins.reattach(t.select("k", "l"), groups, "k", "l")) == [("a", "g1"), ("a", "g1"), ("b", "x")]


def test_columns_and_documents(spark, rows):
    t = spark.createDataFrame([(1, None, None), (None, None, None), (2, "x", "b")], "a int, b string, c string")
    assert len(columns.without_empty_rows(t).collect()) == 2 and len(columns.without_empty_rows(t, ["b", "c"]).collect()) == 1
    assert [r.a for r in columns.by_last_column(t.filter("a is not null")).collect()] == [2, 1]
    assert [r.a for r in columns.exact_filters(t, {"a": "2", "b": ""}).collect()] == [2] and columns.exact_filters(t, {"c": "B"}).collect() == []
    docs = spark.createDataFrame([("p", "old"), ("q", "old")], "k string, part string")
    new = spark.createDataFrame([("p", "new"), ("p", None), ("q", "newer")], "k string, part string")
    assert rows(setops.replaced_document(docs, new, "k", "part")) == [("p", "new"), ("q", "newer")]
    with pytest.raises(Exception, match="no part for q"):
        setops.replaced_document(docs, new.filter("k = 'p'"), "k", "part").collect()


def test_names_and_edges(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(names.unnumbered(F.lit("a/b/Photo (12).jpg"))) == "Photo" and one(names.stem(F.lit("x.tar.gz"))) == "x.tar"
    assert one(names.names_country(F.lit("HP mexico 2"), ["MEXICO", "JAPAN"])) and not one(names.names_country(F.lit(None).cast("string"), ["JAPAN"]))
    edge = lambda a, b: one(numbers.kept_edge(F.lit(a), F.lit(b), F.lit(100)))
    assert edge(95, 20) == [20, 95] and edge(-50, 10) == [0, 10] and edge(-50, 9) is None and edge(95, 300) is None


def test_preferences_editing(spark):
    t = spark.createDataFrame([({"A": ["x", "y"], "B": []},)], "m map<string,array<string>>")
    got = lambda c: t.select(c.alias("m")).first().m
    m, lit = F.col("m"), F.lit
    assert got(lists.add_touchpoint(m, lit("A"), lit("z"))) == {"A": ["z", "x", "y"], "B": []}
    assert got(lists.add_touchpoint(m, lit("A"), lit("x")))["A"] == ["x", "y"] and got(lists.add_touchpoint(m, lit("C"), lit("z")))["C"] == ["z"]
    assert got(lists.rename_touchpoint(m, lit("A"), lit("x"), lit("w"))) == {"A": ["w", "y"], "B": []}
    assert got(lists.delete_touchpoint(m, lit("A"), lit("x"))) == {"A": ["y"], "B": []}
    assert got(lists.rename_brand(m, lit("A"), lit("B"))) == {"B": ["x", "y"]} and got(lists.rename_brand(m, lit("no"), lit("B"))) == {"A": ["x", "y"], "B": []}
    assert got(lists.delete_brand(m, lit("A"))) == {"B": []}


def test_list_files_and_errors(spark, tmp_path, rows):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.txt").write_text("//Filename: f\n-- G\n*All\n#A\nx\n#B\n")
    (tmp_path / "p" / "b.txt").write_text("")
    assert rows(lists.read_preferences(spark, str(tmp_path / "p")).select("file_name", "annotator", "group_brand", "touchpoint")) == [("f", None, "G__A", "All"), ("f", None, "G__A", "x"), ("f", None, "G__B", "All")]
    (tmp_path / "pairs.txt").write_text("a-b\n\n c - d \n")
    assert rows(lists.read_pairs(spark, str(tmp_path / "pairs.txt")).select("brand", "touchpoint")) == [("a", "b"), ("c", "d")]
    (tmp_path / "bad.txt").write_text("a-b-c\n")
    with pytest.raises(Exception, match="not one dash"):
        lists.read_pairs(spark, str(tmp_path / "bad.txt")).collect()


def test_database(spark, rows):
    url, how = "jdbc:derby:memory:more;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    first = spark.createDataFrame([(1, "a")], "id long, name string")
    first.write.jdbc(url, "t", properties=how)
    sinks.insert_new(spark.createDataFrame([(1, "again"), (2, "b"), (2, "b")], "id long, name string"), url, "t", ["id"], how)
    assert rows(spark.read.jdbc(url, "t", properties=how)) == [(1, "a"), (2, "b")]


def test_templates_and_crops(spark):
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (12, 10, 3), dtype=np.uint8)
    small = a[:2, :2]
    image = lambda p: (p.shape[0], p.shape[1], 3, p.tobytes())
    shape = "name string, image struct<height:int,width:int,nChannels:int,data:binary>"
    t = spark.createDataFrame([("a", image(a)), ("small", image(np.ascontiguousarray(small))), ("none", (-1, -1, -1, b""))], shape)
    grey = a.mean(axis=-1)
    found = {r.name: (r.template, round(r.score, 6)) for r in images.match_templates(t, [rng.random((3, 3)), grey[4:8, 2:6]], 0.999).collect()}
    assert found == {"a": (1, 1.0)}
    got = {r.name: (r.width, r.height, bytes(r.data)) for r in images.crop_pictures(t, 1, 2, 4, 3).collect()}
    assert got["a"] == (4, 3, a[2:5, 1:5].tobytes()) and set(got) == {"a", "small"}
    h = np.histogramdd(a.reshape(-1, 3), bins=8, range=[(0, 256)] * 3)[0]
    assert (images.histogram(a, 8) == h.ravel()).all()


def test_consecutive_frames_as_a_stream(spark, tmp_path, rows):
    shape = "f string, frame long"
    for part in ([("a", 0), ("a", 1), ("b", 5)], [("a", 2), ("a", 4), ("b", 6), ("b", 6)], [("end", 10_000)]):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ledger.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files_per_batch=1)
    out = ledger.consecutive_frames(stream, ["f"], "frame", str(tmp_path / "out"), str(tmp_path / "ck"), late=1000)
    assert rows(out) == [("a", 0, 2, 3), ("a", 4, 4, 1), ("b", 5, 6, 2)]
