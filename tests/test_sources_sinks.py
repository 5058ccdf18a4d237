import io
import zipfile

import pytest
from pyspark.sql import functions as F

from framewright import schemas
from framewright.sinks import files as sinks
from framewright.sources import delimited, documents, lists, workbook

HEAD = "\t".join(schemas.EXPOSURE_HEADER)


def test_delimited(spark, tmp_path, rows):
    utf, latin = tmp_path / "d" / "a.tsv", tmp_path / "d" / "b.tsv"
    utf.parent.mkdir()
    line = "Øre\tBoard\t10:00:00\t3\tA\t1.5\t3\t1.0\t7"
    utf.write_bytes(f"{HEAD}\r\n{line}\r\n".encode())
    latin.write_bytes(f"{HEAD}\n{line}\n".encode("latin1"))
    got = delimited.read_decoded(spark, str(tmp_path / "d"))
    assert rows(got.select("source_file", "brand", "duration", "frame")) == [("a.tsv", "Øre", 3, "7"), ("b.tsv", "Øre", 3, "7")]
    one = delimited.read_tsv(spark, str(utf)).first()
    assert (one.brand, one.screen_size_pct, one.source_file) == ("Øre", 1.5, "a.tsv")
    semi = tmp_path / "s.csv"
    semi.write_text("a;b\n1;2\n3;4;5\n")
    schema = schemas.fields(("a", schemas._L), ("b", schemas._L))
    assert delimited.sniff(spark, str(semi)) == ";"
    assert rows(delimited.read_tolerant(spark, str(semi), schema, sep=";")) == [(1, 2)]
    nul = tmp_path / "n.csv"
    nul.write_bytes(b"a,b\n\x001,\x002\n")
    assert rows(delimited.read_without_nul(spark, str(nul), schema)) == [(1, 2)]
    listed = delimited.list_files(spark, str(tmp_path), suffix=".tsv")
    assert sorted(r.name for r in listed.collect()) == ["a.tsv", "b.tsv"]
    assert delimited.total_size(listed).first().n_bytes == utf.stat().st_size + latin.stat().st_size
    ledger = spark.createDataFrame([("a.tsv",)], "file_name string")
    assert [r.name for r in delimited.unread(listed, ledger).collect()] == ["b.tsv"]


def test_lists(spark, tmp_path):
    text = "lost\n#Acme Tools\nBoard\n\n#Bolt\nx\n#Acme Tools\nFlag"
    assert lists.brand_list(text) == {"Acme Tools": ["Flag"], "Bolt": ["x"]}
    assert lists.listed_brands("#Anheuser-Busch (Budweiser)\n#Bolt") == {"Anheuser", "Bolt"}
    p = lists.preferences("//Filename: f\n//Annotator: me\n% no\n-- G\n#A\nx\n*All\n#B\nAll\ny\n--\n#C\nz")
    assert (p.file_name, p.annotator, p.touchpoints) == ("f", "me", {"G__A": ["All", "x"], "G__B": ["All", "y"]})
    assert lists.renamed({"a": ["x", "y"]}, "a", "x", "z") == {"a": ["z", "y"]} and lists.renamed({"a": ["x", "y"]}, "a", "x", None) == {"a": ["y"]}
    assert lists.pairs("a-b\n\nc - d") == [("a", "b"), ("c", "d")]
    with pytest.raises(ValueError, match="one dash"):
        lists.pairs("a-b-c")
    assert lists.class_ids("0: A-B\n1: C") == {"A-B": 0, "C": 1}
    assert lists.detections("1 .5 .5 .1 .1\n2 .5 .5 .1 .1 .9")[1][5] == 0.9
    with pytest.raises(ValueError, match="4 fields"):
        lists.detections("1 2 3 4")
    (tmp_path / "l.txt").write_text(text)
    got = sorted((r.source_file, r.brand, r.at, r.location) for r in lists.read_brand_lists(spark, str(tmp_path / "l.txt")).collect())
    assert got == [("l.txt", "Acme Tools", 0, "Flag"), ("l.txt", "Bolt", 0, "x")]


def test_workbook_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("A & <b>", 1, 1.5), (None, 2, None)], "name string, n bigint, x double")
    path = str(tmp_path / "w.xlsx")
    assert workbook.write_workbook({"Homeplate": df, "Batters": df.limit(0)}, path) == ["Homeplate", "Batters"]
    with open(path, "rb") as f:
        assert workbook.sheet_names(f.read()) == ["Homeplate", "Batters"]
    assert rows(workbook.read_sheet(spark, path, df.schema, "HomePlate").select(*df.columns)) == rows(df)
    assert workbook.read_sheet(spark, path, df.schema, 1).collect() == []
    assert workbook.read_sheet(spark, str(tmp_path), df.schema, 0).count() == 2
    many = spark.range(7).select("id")
    assert workbook.write_workbook({"x": many, "y": df}, path, most_rows=4) == ["x", "x (2)", "x (3)", "y"]
    got = [r.id for s in ("x", "x (2)", "x (3)") for r in workbook.read_sheet(spark, path, many.schema, s).orderBy("row_no").collect()]
    assert got == list(range(7))
    assert workbook.write_workbook({"x": many}, path, most_rows=8) == ["x"]
    wrong = workbook.read_sheet(spark, str(tmp_path / "w.xlsx"), schemas.fields(("id", schemas._D), ("more", schemas._S)), "X").collect()
    assert [(r.id, r.more) for r in sorted(wrong, key=lambda r: r.row_no)] == [(float(i), None) for i in range(7)]


def test_documents(spark, tmp_path, rows):
    html = "<table><tr><th>No</th><th>Name</th></tr><tr><td>1</td><td>A &amp; B</td></tr></table><table><tr><td>x</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>none")], "id long, html string")
    assert rows(documents.roster(pages, "id", "html").select("id", "table_no", "row_no", "name")) == [(1, 0, 0, "A & B")]
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p/></w:body></w:document>')
    assert rows(documents.read_docx(spark, str(tmp_path)).select("line_no", "line")) == [(0, "one"), (1, "")]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("f/x.jpg", b"12")
        z.writestr("y.jpg", b"")
    (tmp_path / "bad.zip").write_bytes(b"no")
    got = rows(documents.read_archives(spark, str(tmp_path)).select("entry", "folder", "n_bytes", "readable"))
    assert got == [("f/x.jpg", "f", 2, True), ("y.jpg", "", 0, True), (None, None, None, False)]
    hashes = documents.read_hashes(spark, str(tmp_path / "bad.zip")).first()
    assert hashes.hash == "7fa3b767c460b54a2be4d49030b349c7"


def test_annotations(spark, tmp_path):
    from framewright.plans.pipelines import exposures_of

    box = '{"startPoint": [1, 2], "start_point": [1, 2], "diag_point": [3, 4], "group": "G", "brand": "B", "tpoint": "T", "hits": 2}'
    image = lambda n: f'"i{n}": {{"imageName": "im_{n:04d}", "imageIndex": {n}, "width": 10, "height": 10, "annotations": [{box}]}}'
    (tmp_path / "a.json").write_text('{"project": "p", "images": {' + ", ".join(map(image, (9, 10, 11, 20))) + "}}")
    out = exposures_of(documents.read_annotations(spark, str(tmp_path / "a.json"))).orderBy("first_offset").collect()
    assert [(r.brand, r.first_offset, r.duration, r.hits, r.imageName) for r in out] == [("B", 9, 3, 6, "im_0009"), ("B", 20, 1, 2, "im_0020")]


def test_sinks(spark, tmp_path, rows):
    book = sinks.TableFolder(spark, str(tmp_path / "book"))
    df = spark.createDataFrame([("b", "y"), ("b", "x"), ("a", "z"), ("b", "x"), (None, "q")], "brand string, location string")
    book.append("t", df)
    book.replace("t", book.read("t").filter("brand = 'b'"))
    assert book.read("t").count() == 3 and book.names() == ["t"]
    book.drop("t")
    assert book.names() == []
    assert rows(sinks.brand_report(df)) == [("#a\nz",), ("#b\nx\ny",)]
    sinks.write_text(sinks.brand_report(df), str(tmp_path / "r"))
    sinks.write_tsv(df, str(tmp_path / "tsv"))
    sinks.write_json_documents(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 5
    box = spark.createDataFrame([("i", 1, 0.5, 0.25, 0.1, 0.2)], "image string, class_id int, x_center double, y_center double, width double, height double")
    assert sinks.label_lines(box).first().value == "1 0.500000 0.250000 0.100000 0.200000"
    sinks.write_labels(box, str(tmp_path / "labels"))
    assert (tmp_path / "labels" / "image=i").is_dir()
    moved = sinks.move_manifest(spark.createDataFrame([("/a/x.jpg", "x.jpg"), ("/b/x.jpg", "x.jpg")], "path string, name string"), "name", "/out/")
    assert rows(moved.select("src", "dst")) == [("/a/x.jpg", "/out/x.jpg"), ("/b/x.jpg", "/out/x_1.jpg")]


def test_pictures(spark, tmp_path):
    # The smallest picture that the image source decodes: a bitmap of 2 x 1 pixels.
    data = b"BM" + (62).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24) + bytes(8)
    (tmp_path / "p.bmp").write_bytes(data)
    (tmp_path / "q.bmp").write_bytes(b"no picture")
    got = documents.read_pictures(spark, str(tmp_path)).select("name", "size").collect()
    assert [(r.name, r["size"]) for r in got] == [("p.bmp", "2x1")]
    pic = documents.read_pictures(spark, str(tmp_path)).select("image")
    from framewright.operators.images import measure_pairs

    pairs = pic.select(F.lit("a").alias("target"), F.lit("b").alias("compared"), F.col("image").alias("a"), F.col("image").alias("b"))
    assert [r.score for r in measure_pairs(pairs, lambda a, b: float(a.shape == b.shape)).collect()] == [1.0]


def test_archive_in_memory():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a/", b"")
        z.writestr("a/b", b"x")
    assert list(documents.archive_entries(buf.getvalue())) == [("a/b", "a", 1, True)]
