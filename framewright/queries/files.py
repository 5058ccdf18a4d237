"""Sources and sinks over the test tables: each query writes whole tables in a format and reads them back."""

from __future__ import annotations

import io
import struct
import uuid
import zipfile
import zlib
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright import schemas
from framewright.operators import images, ontology, reshape, setops
from framewright.operators.sequences import carry_over
from framewright.functions.names import base_name
from framewright.plans.pipelines import exposures_of
from framewright.queries.exposures import _NO, numbered
from framewright.queries.registry import Registry
from framewright.queries.relations import RULES_TEXT, _RULES
from framewright.session import scratch
from framewright.sinks import files as sinks
from framewright.sources import delimited, documents, lists, workbook
from framewright.tables import table

query = Registry()

_S, _I, _L, _D = schemas._S, schemas._I, schemas._L, schemas._D


# -- delimited text --------------------------------------------------------------------------------------------------

# In delimited text an empty field is a null.
_NULL = lambda c: f"nullif({c}, '') AS {c}"


@query(f"SELECT {_NULL('brand')}, {_NULL('location')}, screen_time, duration, screen_location, screen_size_pct, total_hits, average_hits, {_NULL('frame')} FROM exposures")
def q_read_tsv(spark, folder):
    path = scratch(spark, "tsv")
    sinks.write_tsv(table(spark, folder, "exposures").select(*schemas.EXPOSURE.names), path)
    return delimited.read_tsv(spark, path).select(*schemas.EXPOSURE.names)


@query(f"SELECT row_id, {_NULL('brand')}, {_NULL('location')}, duration FROM bbl")
def q_read_decoded(spark, folder):
    path = scratch(spark, "text")
    t = table(spark, folder, "bbl").select("row_id", "brand", "location", "duration")
    latin = F.concat_ws("", "brand", "location").rlike("^[\\x00-\\x7f\\xa0-\\xff]*$")
    sinks.write_tsv(t.filter(latin), f"{path}/latin", encoding="ISO-8859-1")
    sinks.write_tsv(t.filter(~latin), f"{path}/utf")
    shape = schemas.fields(("row_id", _L), ("brand", _S), ("location", _S), ("duration", _I))
    return delimited.read_decoded(spark, f"{path}/*", shape).select(*shape.names)


@query("SELECT row_id, total_frames, total_duration FROM results_ledger")
def q_read_tolerant(spark, folder):
    path = scratch(spark, "csv")
    t = table(spark, folder, "results_ledger").select("row_id", "total_frames", "total_duration")
    text = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    broken = t.filter("row_id % 5 = 0").select(F.lit("x").alias("row_id"), F.lit("1").alias("total_frames"), F.lit("y").alias("total_duration"))
    sinks.write_tsv(text.unionByName(broken), path, sep=",")
    return delimited.read_tolerant(spark, path, schemas.fields(("row_id", _L), ("total_frames", _L), ("total_duration", _L)))


@query("SELECT 'semicolon' AS kind, row_id, brand, accumulative_avg FROM accumulated_averages UNION ALL SELECT 'comma', row_id, brand, accumulative_avg FROM accumulated_averages")
def q_read_sniffed(spark, folder):
    t = table(spark, folder, "accumulated_averages").select("row_id", "brand", "accumulative_avg")
    parts = []
    for kind, sep in (("semicolon", ";"), ("comma", ",")):
        path = scratch(spark, "csv")
        sinks.write_tsv(t, path, sep=sep)
        parts.append(delimited.read_sniffed(spark, path, t.schema).select(F.lit(kind).alias("kind"), *t.columns))
    return parts[0].unionByName(parts[1])


@query(f"SELECT row_id, {_NULL('brand')}, duration FROM bbl")
def q_read_without_nul(spark, folder):
    path = scratch(spark, "csv")
    t = table(spark, folder, "bbl").select("row_id", "brand", "duration")
    line = F.to_csv(F.struct(*t.columns), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    sinks.write_text(t.select(F.concat(F.lit("\x00"), F.regexp_replace(line, ",", "\x00,")).alias("value")), path)
    return delimited.read_without_nul(spark, path, t.schema)


@query("SELECT DISTINCT video FROM shard_files WHERE video IS NOT NULL")
def q_list_files(spark, folder):
    path = scratch(spark, "pieces")
    table(spark, folder, "shard_files").filter("video is not null").select("video", "content").write.partitionBy("video").text(path)
    listed = delimited.list_files(spark, path, suffix=".txt", contains="part-")
    return listed.select(F.url_decode(F.regexp_extract("path", "video=([^/]*)/", 1)).alias("video")).distinct()


@query("SELECT CAST(sum(strlen(coalesce(content, '')) + 1) AS BIGINT) AS n_bytes, round(sum(strlen(coalesce(content, '')) + 1) / pow(1024, 3), 2) AS gigabytes FROM shard_files")
def q_folder_size(spark, folder):
    path = scratch(spark, "pieces")
    sinks.write_text(table(spark, folder, "shard_files").select(F.coalesce("content", F.lit("")).alias("value")), path)
    return delimited.total_size(delimited.list_files(spark, path))


@query("SELECT video, count(*) AS n FROM shard_files WHERE video NOT IN (SELECT min(video) FROM shard_files) GROUP BY video")
def q_unread_files(spark, folder):
    t = table(spark, folder, "shard_files").filter("video is not null")
    ledger = t.agg(F.min("video").alias("file_name"))
    return delimited.unread(t.groupBy(F.col("video").alias("name")).agg(F.count(F.lit(1)).alias("n")), ledger).withColumnRenamed("name", "video")


# -- workbooks -------------------------------------------------------------------------------------------------------


@query("SELECT 'Homeplate' AS sheet, ref_id, name, alt_names FROM reference_names WHERE kind = 'brand' UNION ALL SELECT 'Batters', ref_id, name, alt_names FROM reference_names WHERE kind = 'location'")
def q_workbook(spark, folder):
    t = table(spark, folder, "reference_names")
    sheet = lambda kind: t.filter(F.col("kind") == kind).select("ref_id", "name", "alt_names")
    path = f"{scratch(spark, 'book')}.xlsx"
    workbook.write_workbook({"Homeplate": sheet("brand"), "Batters": sheet("location")}, path)
    # One sheet by a name in other case, one by its place.
    a = workbook.read_sheet(spark, path, sheet("brand").schema, "HomePlate").withColumn("sheet", F.lit("Homeplate"))
    b = workbook.read_sheet(spark, path, sheet("brand").schema, 1).withColumn("sheet", F.lit("Batters"))
    return a.unionByName(b).select("sheet", "ref_id", "name", "alt_names")


@query("SELECT row_id, brand, location, accumulative_avg FROM accumulated_averages")
def q_workbook_numbers(spark, folder):
    t = table(spark, folder, "accumulated_averages").select("row_id", "brand", "location", "accumulative_avg")
    path = f"{scratch(spark, 'book')}.xlsx"
    text = t.withColumn("accumulative_avg", F.col("accumulative_avg").cast("string"))
    workbook.write_workbook({"Sheet1": text}, path)
    return workbook.read_sheet(spark, path, t.schema).select(*t.columns)


@query("SELECT 'new' AS sheet, ref_id, name FROM reference_names UNION ALL SELECT 'old', ref_id, name || '!' FROM reference_names WHERE kind = 'brand' UNION ALL SELECT 'old', ref_id, name FROM reference_names WHERE kind = 'location'")
def q_table_folder(spark, folder):
    t = table(spark, folder, "reference_names").select("ref_id", "kind", "name")
    book = sinks.TableFolder(spark, scratch(spark, "book"))
    book.replace("old", t.filter("kind = 'brand'"))
    book.append("old", t.filter("kind = 'location'"))
    book.replace("gone", t)
    book.replace("new", t)
    book.replace("old", book.read("old").withColumn("name", F.when(F.col("kind") == "brand", F.concat("name", F.lit("!"))).otherwise(F.col("name"))))
    book.drop("gone")
    parts = [book.read(n).select(F.lit(n).alias("sheet"), "ref_id", "name") for n in book.names()]
    return setops.union_by_name(*parts)


# -- lists and documents ---------------------------------------------------------------------------------------------

_ONCE = "(SELECT DISTINCT brand, location FROM results_ledger WHERE brand IS NOT NULL AND location IS NOT NULL)"


def _once(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "results_ledger").select("brand", "location").dropna().distinct()


@query(f"SELECT brand, CAST(row_number() OVER (PARTITION BY brand ORDER BY location) - 1 AS INTEGER) AS at, location FROM {_ONCE}")
def q_brand_lists(spark, folder):
    path = scratch(spark, "lists")
    sinks.write_text(sinks.brand_report(table(spark, folder, "results_ledger")), path)
    return lists.read_brand_lists(spark, path).select("brand", "at", "location")


@query(r"SELECT DISTINCT regexp_extract(brand, '^([\p{L}\p{M}\p{N}_]*)', 1) AS brand FROM " + _ONCE + r" WHERE regexp_matches(brand, '^[\p{L}\p{M}\p{N}_]')")
def q_listed_brands(spark, folder):
    path = scratch(spark, "lists")
    sinks.write_text(sinks.brand_report(table(spark, folder, "results_ledger")), path)
    return lists.read_listed_brands(spark, path).select("brand").distinct()


@query(
    f"""
WITH g AS (SELECT 'G__' || brand AS group_brand, list_concat(['Everywhere'], list_sort(list(location))) AS a FROM {_ONCE} GROUP BY brand)
SELECT group_brand, CAST(unnest(range(len(a))) AS INTEGER) AS at, unnest(a) AS touchpoint, 'made' AS file_name, 'somebody' AS annotator FROM g"""
)
def q_preferences(spark, folder):
    path = scratch(spark, "lists")
    head = "//Filename: made\n//Annotator: somebody\n% a comment\n-- G\n*Everywhere\n"
    texts = sinks.brand_report(table(spark, folder, "results_ledger")).select(F.concat(F.lit(head), "value").alias("value"))
    # Each text is a file of its own: the head stands before every brand, and may.
    sinks.write_text(texts, path)
    return lists.read_preferences(spark, path).select("group_brand", "at", "touchpoint", "file_name", "annotator")


@query(
    f"""
WITH c AS (SELECT brand, list_sort(list(location)) AS a FROM {_ONCE} GROUP BY brand),
d AS (SELECT brand || ' (was)' AS brand, list_concat(['First'], list_transform(list_filter(a, lambda x: x <> a[1]), lambda x: CASE WHEN x = a[2] THEN 'Second' ELSE x END)) AS a FROM c)
SELECT brand, array_to_string(a, '|') AS touchpoints FROM d"""
)
def q_preferences_edit(spark, folder):
    c = _once(spark, folder).groupBy("brand").agg(F.array_sort(F.collect_list("location")).alias("a"))
    b = F.col("brand")
    held = F.create_map(b, F.col("a"), F.lit(" gone "), F.array(F.lit("x")))
    held = lists.delete_touchpoint(held, b, F.get("a", F.lit(0)))
    held = lists.rename_touchpoint(held, b, F.get("a", F.lit(1)), F.lit("Second"))
    held = lists.add_touchpoint(held, b, F.lit("First"))
    held = lists.rename_brand(lists.delete_brand(held, F.lit(" gone ")), b, F.concat(b, F.lit(" (was)")))
    return c.select(F.explode(held).alias("brand", "t")).select("brand", F.array_join("t", "|").alias("touchpoints"))


@query("SELECT DISTINCT doc_id, official FROM (" + " UNION ALL ".join(f"SELECT doc_id, '{r.official}' AS official FROM documents WHERE contains(lower(text), '{r.alternative}')" for r in _RULES if r.kind == "keyword") + ")")
def q_rules_file(spark, folder):
    path = scratch(spark, "rules")
    sinks.write_file(spark, f"{path}/rules.txt", RULES_TEXT.encode())
    return ontology.contains_rules(table(spark, folder, "documents"), ontology.read_rules(spark, path), "doc_id", "text")


@query(f"SELECT replace(brand, '-', ' ') AS brand, replace(location, '-', ' ') AS touchpoint FROM {_ONCE}")
def q_pair_lists(spark, folder):
    path = scratch(spark, "lists")
    sinks.write_text(_once(spark, folder).select(F.concat(F.translate("brand", "-", " "), F.lit("-"), F.translate("location", "-", " ")).alias("value")), path)
    return lists.read_pairs(spark, path).select("brand", "touchpoint")


@query("SELECT name AS label, ref_id AS class_id FROM reference_names")
def q_class_ids(spark, folder):
    path = scratch(spark, "lists")
    sinks.write_text(table(spark, folder, "reference_names").select(F.concat_ws(": ", F.col("ref_id").cast("string"), "name").alias("value")), path)
    return lists.read_class_ids(spark, path).select("label", "class_id")


_BOXES = "SELECT l_suppkey % 50 AS image, l_linenumber AS class_id, CAST(l_partkey % 1000 AS DOUBLE) / 1000 AS x_center, CAST(l_orderkey % 1000 AS DOUBLE) / 1000 AS y_center, l_quantity / 64 AS width, CAST(l_suppkey % 7 AS DOUBLE) / 8 AS height FROM lineitem"


def _rounded(c: str) -> str:
    return f"round({c}, 6) AS {c}"


@query(f"SELECT CAST(image AS VARCHAR) AS image, CAST(class_id AS BIGINT) AS class_id, {', '.join(_rounded(c) for c in ('x_center', 'y_center', 'width', 'height'))} FROM ({_BOXES})")
def q_detections(spark, folder):
    t = table(spark, folder, "lineitem")
    share = lambda c, n, d: ((F.col(c) % n).cast("double") / d)
    boxes = t.select((F.col("l_suppkey") % 50).cast("string").alias("image"), F.col("l_linenumber").cast("bigint").alias("class_id"), share("l_partkey", 1000, 1000).alias("x_center"), share("l_orderkey", 1000, 1000).alias("y_center"), (F.col("l_quantity").cast("double") / 64).alias("width"), share("l_suppkey", 7, 8).alias("height"))
    path = scratch(spark, "labels")
    sinks.write_labels(boxes, path)
    return lists.read_detections(spark, path).select("image", "class_id", *[F.round(c, 6).alias(c) for c in ("x_center", "y_center", "width", "height")])


@query("SELECT CAST(row_number() OVER (ORDER BY ref_id) - 1 AS INTEGER) AS line_no, name AS line FROM reference_names")
def q_docx(spark, folder):
    names = [r.name for r in table(spark, folder, "reference_names").select("ref_id", "name").orderBy("ref_id").toLocalIterator()]
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(n)}</w:t></w:r></w:p>' for n in names)
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    path = scratch(spark, "docx")
    sinks.write_file(spark, f"{path}/names.docx", held.getvalue())
    return documents.read_docx(spark, path).select("line_no", "line")


@query("SELECT kind || '/' || ref_id || '.txt' AS entry, kind AS folder, CAST(strlen(name) AS BIGINT) AS n_bytes, true AS readable FROM reference_names UNION ALL SELECT NULL, NULL, NULL, false")
def q_archives(spark, folder):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for r in table(spark, folder, "reference_names").select("kind", "ref_id", "name").toLocalIterator():
            z.writestr(f"{r.kind}/{r.ref_id}.txt", r.name)
    path = scratch(spark, "zip")
    sinks.write_file(spark, f"{path}/names.zip", held.getvalue())
    sinks.write_file(spark, f"{path}/broken.zip", b"PK not a zip")
    return documents.read_archives(spark, path).select("entry", "folder", "n_bytes", "readable")


@query("SELECT md5(name || chr(10)) AS hash FROM reference_names")
def q_file_hashes(spark, folder):
    path = scratch(spark, "files")
    table(spark, folder, "reference_names").select("ref_id", "name").repartition("ref_id").write.partitionBy("ref_id").text(path)
    return documents.read_hashes(spark, f"{path}/*").select("hash")


@query("SELECT n_name || '.png' AS name, (n_nationkey + 1) || 'x' || (n_regionkey + 1) AS size FROM nation")
def q_pictures(spark, folder):
    def png(w: int, h: int) -> bytes:
        chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        rows = b"".join(b"\x00" + bytes((x * 9 + y) % 256 for x in range(w)) for y in range(h))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")

    path = scratch(spark, "pictures")
    for r in table(spark, folder, "nation").toLocalIterator():
        sinks.write_file(spark, f"{path}/{r.n_name}.png", png(r.n_nationkey + 1, r.n_regionkey + 1))
    sinks.write_file(spark, f"{path}/broken.png", b"not a picture")
    return documents.read_pictures(spark, path).select(F.url_decode("name").alias("name"), "size")


# -- annotations -----------------------------------------------------------------------------------------------------


def _annotations(spark: SparkSession, folder: str) -> DataFrame:
    """One document per file of bbl, its images by frame, a box per row."""
    t = table(spark, folder, "bbl").dropna(subset=["file_name", "frame", "brand", "location"])
    none = F.lit(None).cast("array<double>")
    box = F.struct(F.array(F.col("row_id").cast("double"), F.lit(0.0)).alias("start_point"), none.alias("diag_point"), F.lit("G").alias("group"), "brand", F.col("location").alias("tpoint"), F.col("total_hits").alias("hits"))
    image = t.groupBy("file_name", "frame").agg(F.array_sort(F.collect_list(box)).alias("annotations"))
    image = image.select("file_name", F.concat(F.col("frame").cast("string"), F.lit(".jpg")).alias("imageName"), F.col("frame").cast("int").alias("imageIndex"), F.lit(640.0).alias("width"), F.lit(480.0).alias("height"), "annotations")
    entry = F.struct("imageName", F.struct("imageName", "imageIndex", "width", "height", "annotations").alias("v"))
    return image.groupBy(F.col("file_name").alias("project")).agg(F.map_from_entries(F.collect_list(entry)).alias("images"))


_BOX_ROWS = "FROM bbl WHERE file_name IS NOT NULL AND frame IS NOT NULL AND brand IS NOT NULL AND location IS NOT NULL"


@query(f"SELECT file_name AS project, frame || '.jpg' AS image_name, CAST(row_id AS DOUBLE) AS x, brand, location AS tpoint, CAST(total_hits AS INTEGER) AS hits {_BOX_ROWS}")
def q_annotations(spark, folder):
    path = scratch(spark, "json")
    sinks.write_json_documents(_annotations(spark, folder), path)
    boxes = reshape.explode_annotations(documents.read_annotations(spark, path, lines=True))
    return boxes.select("project", F.col("imageName").alias("image_name"), F.get("start_point", F.lit(0)).alias("x"), "brand", "tpoint", "hits")


@query(
    f"""
WITH a AS (SELECT file_name AS project, brand, location AS tpoint, frame AS o, arg_max(total_hits, row_id) AS h {_BOX_ROWS} GROUP BY ALL),
b AS (SELECT *, o - row_number() OVER (PARTITION BY project, brand, tpoint ORDER BY o) AS g FROM a),
c AS (SELECT project, brand, tpoint, min(o) AS first_offset, count(*) AS duration, CAST(sum(h) AS BIGINT) AS hits, arg_max(h, o) AS own FROM b GROUP BY project, brand, tpoint, g)
SELECT project, {_NULL('brand')}, {_NULL('tpoint')}, first_offset, duration, hits, CASE WHEN hits % duration = 0 THEN CAST(own AS DOUBLE) ELSE round(hits / CAST(duration AS DOUBLE), 3) END AS average_hits FROM c"""
)
def q_export_tsv(spark, folder):
    out = exposures_of(_annotations(spark, folder)).select("project", "brand", "tpoint", "first_offset", "duration", "hits", "average_hits")
    path = scratch(spark, "tsv")
    sinks.write_tsv(out, path)
    return delimited.read_tsv(spark, path, out.schema).drop("source_file")


@query(
    f"""
WITH i AS (SELECT file_name, frame, string_agg(brand || '/' || location, '|' ORDER BY row_id) AS boxes {_BOX_ROWS} GROUP BY file_name, frame)
SELECT file_name, frame, boxes, lag(boxes) OVER (PARTITION BY file_name ORDER BY frame) AS carried FROM i"""
)
def q_carry_boxes(spark, folder):
    from framewright.operators.stretches import frames

    t = table(spark, folder, "bbl").dropna(subset=["file_name", "frame", "brand", "location"])
    boxes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "brand", "location"))), lambda x: F.concat(x["brand"], F.lit("/"), x["location"])), "|")
    i = t.groupBy("file_name", "frame").agg(boxes.alias("boxes"))
    return carry_over(i, ["file_name"], ["frame"], "boxes", "carried", frames("frame"))


@query(f"SELECT file_name AS project, count(*) AS boxes, CAST(sum(total_hits) * 0 AS BIGINT) AS hits {_BOX_ROWS} GROUP BY file_name")
def q_replace_document(spark, folder):
    held = _annotations(spark, folder)
    other = held.withColumn("images", F.transform_values("images", lambda _, v: v.withField("annotations", F.transform(v["annotations"], lambda b: b.withField("hits", F.lit(0))))))
    boxes = reshape.explode_annotations(setops.replaced_document(held, other, "project", "images"))
    return boxes.groupBy("project").agg(F.count(F.lit(1)).alias("boxes"), F.sum("hits").alias("hits"))


# -- logs, databases, manifests --------------------------------------------------------------------------------------


@query("SELECT brand || '_' || location AS value, 2 AS times FROM " + _ONCE)
def q_text_log(spark, folder):
    path = scratch(spark, "log")
    line = _once(spark, folder).select(F.concat("brand", F.lit("_"), "location").alias("value")).orderBy("value")
    sinks.write_text(line, path, append=True)
    sinks.write_text(line, path, append=True)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query("SELECT ref_id, kind, name FROM reference_names")
def q_jdbc_insert(spark, folder):
    t = table(spark, folder, "reference_names").select("ref_id", "kind", "name")
    url, how = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    t.filter("kind = 'brand'").write.jdbc(url, "names", properties=how)
    sinks.insert_new(t.unionByName(t), url, "names", ["ref_id"], how)
    return spark.read.jdbc(url, "names", properties=how).select("ref_id", "kind", "name")


@query(
    r"""
WITH f AS (SELECT path, regexp_extract(path, '([^/]*)$', 1) AS name, row_number() OVER (PARTITION BY regexp_extract(path, '([^/]*)$', 1) ORDER BY path, shard_id) AS i FROM shard_files)
SELECT path AS src, 'flat/' || CASE WHEN i = 1 THEN name ELSE regexp_replace(name, '\.[^.]*$', '') || '_' || (i - 1) || regexp_extract(name, '(\.[^.]*)$', 1) END AS dst, 'copy' AS action FROM f"""
)
def q_move_manifest(spark, folder):
    t = table(spark, folder, "shard_files").select("shard_id", "path", F.substring_index("path", "/", -1).alias("name"))
    return sinks.move_manifest(t, "name", "flat", ["path", "shard_id"])


@query(
    """
SELECT regexp_replace(regexp_replace(split_part('reduced_' || replace(file_name, '_cup', '-cup'), '-', 1), '^reduced_', ''), '_?part ?[0-9]+$', '') AS base, count(*) AS n, CAST(sum(duration) AS BIGINT) AS total
FROM (SELECT file_name, duration FROM bbl UNION ALL SELECT file_name, duration FROM exposures) WHERE file_name IS NOT NULL GROUP BY 1"""
)
def q_grouped_union(spark, folder):
    parts = [table(spark, folder, n).select("file_name", "duration").filter("file_name is not null") for n in ("bbl", "exposures")]
    path = scratch(spark, "grouped")
    setops.write_grouped(parts, base_name(F.concat(F.lit("reduced_"), F.replace("file_name", F.lit("_cup"), F.lit("-cup")))), path)
    t = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    return t.groupBy(F.col("base").cast("string").alias("base")).agg(F.count(F.lit(1)).alias("n"), F.sum("duration").alias("total"))


# -- pictures --------------------------------------------------------------------------------------------------------


def _picture(vector: Column, h: int, w: int, channels: int) -> Column:
    """A picture of a vector's values, from -1 to 1, one after the other and over again."""
    byte = lambda i: F.lpad(F.hex(F.floor((F.get(vector, i % 64).cast("double") + 1) * 128)), 2, "0")
    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(h * w * channels - 1)), byte), ""))
    return F.struct(F.lit(h).alias("height"), F.lit(w).alias("width"), F.lit(channels).alias("nChannels"), data.alias("data"))


def _picture_pairs(spark: SparkSession, folder: str, h: int, w: int) -> DataFrame:
    t = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("id"), "vec_id", "label", _picture(F.col("embedding"), h, w, 3).alias("a"))
    nxt = F.lead(F.struct("id", "a")).over(Window.partitionBy("label").orderBy("vec_id"))
    return t.withColumn("n", nxt).filter("n is not null").select(F.col("id").alias("target"), F.col("n.id").alias("compared"), "a", F.col("n.a").alias("b"))


def _pair_sql(h: int, w: int, bins: int, cell: str, n_pixels: int) -> str:
    """Correlation of the histograms of each cell of the pictures of neighbours within a label: vec_id, other, cell, c."""
    step, n = 256 // bins, bins**3
    mean2 = f"(CAST({n_pixels} AS DOUBLE) * {n_pixels} / {n})"
    return f"""
WITH v AS (SELECT vec_id, embedding AS e, lead(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS other FROM embeddings),
q AS (SELECT vec_id, i // 3 AS p, i % 3 AS k, CAST(floor((CAST(e[i % 64 + 1] AS DOUBLE) + 1) * 128) AS BIGINT) // {step} AS b FROM v, range({h * w * 3}) t(i)),
x AS (SELECT vec_id, p // {w} AS y, p % {w} AS x, sum(b * CASE k WHEN 0 THEN {bins * bins} WHEN 1 THEN {bins} ELSE 1 END) AS bin FROM q GROUP BY vec_id, p),
h AS (SELECT vec_id, {cell} AS cell, bin, count(*) AS n FROM x GROUP BY ALL),
s AS (SELECT vec_id, cell, sum(n * n) - {mean2} AS var FROM h GROUP BY ALL),
j AS (SELECT v.vec_id, v.other, a.cell, sum(a.n * b.n) AS xy FROM v JOIN h a ON a.vec_id = v.vec_id JOIN h b ON b.vec_id = v.other AND a.cell = b.cell AND a.bin = b.bin GROUP BY ALL),
c AS (SELECT v.vec_id, v.other, a.cell, (coalesce(j.xy, 0) - {mean2}) / sqrt(a.var * b.var) AS c
  FROM v JOIN s a ON a.vec_id = v.vec_id JOIN s b ON b.vec_id = v.other AND a.cell = b.cell LEFT JOIN j ON j.vec_id = v.vec_id AND j.cell = a.cell)
"""


@query(_pair_sql(6, 6, 8, "(y // 2) * 3 + x // 2", 4) + "SELECT CAST(vec_id AS VARCHAR) AS target_image, CAST(other AS VARCHAR) AS compared_image, round(avg(c), 6) AS score FROM c GROUP BY vec_id, other")
def q_picture_regions(spark, folder):
    return images.measure_pairs(_picture_pairs(spark, folder, 6, 6)).withColumn("score", F.round("score", 6))


@query(_pair_sql(20, 2, 32, "y", 2) + "SELECT CAST(vec_id AS VARCHAR) AS target_image, CAST(other AS VARCHAR) AS compared_image, round(coalesce(arg_min(c, cell) FILTER (c < 0.9), arg_max(c, cell)), 6) AS score FROM c GROUP BY vec_id, other")
def q_picture_strict(spark, folder):
    return images.measure_pairs(_picture_pairs(spark, folder, 20, 2), images.strict_similarity).withColumn("score", F.round("score", 6))


_GREY = """
WITH q AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, floor((CAST(embedding[i + 1] AS DOUBLE) + 1) * 128) AS v FROM embeddings, range(64) t(i)),
t AS (SELECT dense_rank() OVER (ORDER BY vec_id) - 1 AS n, y, x, v FROM q WHERE vec_id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 3) AND y < 3 AND x < 3),
w AS (SELECT q.vec_id, n, py, px, corr(q.v, t.v) AS c FROM q, t, range(6) a(py), range(6) b(px) WHERE q.y = py + t.y AND q.x = px + t.x GROUP BY ALL),
s AS (SELECT vec_id, n, max(CASE WHEN c IS NULL OR isnan(c) THEN 0 ELSE c END) AS c FROM w GROUP BY ALL)
"""


def _grey(spark: SparkSession, folder: str) -> tuple[DataFrame, list]:
    t = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("name"), "vec_id", _picture(F.col("embedding"), 8, 8, 1).alias("image"))
    first = [images.decode(r.image.asDict()) for r in t.orderBy("vec_id").limit(3).collect()]
    return t, [p[:3, :3, 0] for p in first]


@query(_GREY + "SELECT CAST(vec_id AS VARCHAR) AS name, CAST(CASE WHEN c >= 0.8 THEN 0 ELSE -1 END AS INTEGER) AS template, round(c, 6) AS score FROM s WHERE n = 0")
def q_template(spark, folder):
    t, templates = _grey(spark, folder)
    return images.match_templates(t, templates[:1], 0.8).withColumn("score", F.round("score", 6))


@query(_GREY + "SELECT CAST(vec_id AS VARCHAR) AS name, CAST(coalesce(min(n) FILTER (c >= 0.8), -1) AS INTEGER) AS template, round(coalesce(arg_min(c, n) FILTER (c >= 0.8), max(c)), 6) AS score FROM s GROUP BY vec_id")
def q_any_template(spark, folder):
    t, templates = _grey(spark, folder)
    return images.match_templates(t, templates, 0.8).withColumn("score", F.round("score", 6))


@query("SELECT CAST(vec_id AS VARCHAR) AS name, 4 AS width, 3 AS height, string_agg(printf('%02X', CAST(floor((CAST(embedding[i + 1] AS DOUBLE) + 1) * 128) AS BIGINT)), '' ORDER BY i) AS data FROM embeddings, range(64) t(i) WHERE i // 8 BETWEEN 1 AND 3 AND i % 8 BETWEEN 2 AND 5 GROUP BY vec_id")
def q_crop(spark, folder):
    return images.crop_pictures(_grey(spark, folder)[0], 2, 1, 4, 3).withColumn("data", F.hex("data"))


QUERIES, SQL = query.queries, query.sql
