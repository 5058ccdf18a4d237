"""Smaller operators over the test tables: names, columns, null rows, updates by name, boxes, consecutive frames as a stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framewright.functions import names, numbers, times
from framewright.functions.text import first_number, last_number, strip_all
from framewright.operators import aggregate, columns, joins, reshape
from framewright.queries.exposures import _NO, numbered
from framewright.queries.registry import Registry
from framewright.queries.training import _ENDS
from framewright.session import scratch
from framewright.streaming import ledger
from framewright.tables import table

query = Registry()

_SEVEN = ["file_name", "brand", "location", "screen_time", "screen_location", "screen_size_pct", "total_hits", "average_hits"]


def _some(cols: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


@query(f"SELECT {', '.join(_SEVEN)}, CAST(sum(duration) AS BIGINT) AS duration, min(frame) AS frame FROM exposures WHERE {_some(_SEVEN)} GROUP BY {', '.join(_SEVEN)}")
def q_compact_all_seven(spark, folder):
    """Brand, location, time, screen location, size, total hits and average hits, per file."""
    return reshape.compact(table(spark, folder, "exposures").select(*_SEVEN, "duration", "frame"), _SEVEN, ["duration"], "frame")


_EIGHT = ["file_name", "brand", "location", "screen_time", "screen_location", "screen_size_pct", "average_hits", "player", "inning"]


@query(
    f"""
WITH b AS (SELECT file_name, {_NO}, min(location) AS player, min(brand) AS inning FROM batters GROUP BY ALL),
e AS (SELECT *, {_NO} FROM exposures),
x AS (SELECT e.* EXCLUDE (brand, location), regexp_replace(e.brand, '{_ENDS}', '', 'g') AS brand, regexp_replace(e.location, '{_ENDS}', '', 'g') AS location, b.player, b.inning FROM e JOIN b ON b.file_name = 'batters_' || e.file_name AND b.frame_no = e.frame_no)
SELECT {', '.join(_EIGHT)}, CAST(sum(duration) AS BIGINT) AS duration, CAST(sum(total_hits) AS BIGINT) AS total_hits, min(frame_no) AS frame_no FROM x WHERE {_some(_EIGHT)} GROUP BY {', '.join(_EIGHT)}"""
)
def q_compact_all_eight(spark, folder):
    """Brand, location, time, screen location, size, average hits, player and inning (here the club), per file."""
    b = numbered(spark, folder, "batters").filter("frame_no is not null").groupBy(F.regexp_replace("file_name", "^batters_", "").alias("file_name"), "frame_no").agg(F.min("location").alias("player"), F.min("brand").alias("inning"))
    e = numbered(spark, folder, "exposures").withColumns({c: strip_all(F.col(c)) for c in ("brand", "location")})
    return reshape.compact(joins.enrich(e, b, ["file_name", "frame_no"]).select(*_EIGHT, "duration", "total_hits", "frame_no"), _EIGHT, ["duration", "total_hits"], "frame_no")


# -- updates by name -------------------------------------------------------------------------------------------------


@query(
    f"""
WITH u AS (SELECT CASE WHEN row_id % 2 = 0 THEN '#' || frame ELSE file_name || '_' || lpad(CAST(frame AS VARCHAR), 6, '0') END AS k, total_hits FROM bbl WHERE frame IS NOT NULL AND (row_id % 2 = 0 OR file_name IS NOT NULL)),
s AS (SELECT k, sum(total_hits) AS n FROM u GROUP BY k),
r AS (SELECT row_id, frame, coalesce(TRY_CAST(ltrim(regexp_replace(frame, '[^0-9]', '', 'g'), '0') AS BIGINT), 0) AS d, duration, total_hits FROM exposures)
SELECT row_id, CAST(duration + coalesce(a.n, 0) + coalesce(b.n, 0) AS BIGINT) AS duration, CAST(total_hits + coalesce(a.n, 0) + coalesce(b.n, 0) AS BIGINT) AS total_hits
FROM r LEFT JOIN s a ON a.k = '#' || r.d AND regexp_matches(r.frame, '[0-9]') LEFT JOIN s b ON b.k = r.frame"""
)
def q_update_by_name(spark, folder):
    """Runs whose picture is a number alone, and runs named by a prefix, each meeting the frames their own way."""
    rows = table(spark, folder, "exposures").select("row_id", "frame", "duration", "total_hits")
    t = table(spark, folder, "bbl").filter("frame is not null")
    prefix = F.concat("file_name", F.lit("_"), F.lpad(F.col("frame").cast("string"), 6, "0"), F.lit(".jpg"))
    runs = t.select(F.when(F.col("row_id") % 2 == 0, F.concat(F.col("frame").cast("string"), F.lit(".jpg"))).otherwise(prefix).alias("image"), F.col("total_hits").alias("n"))
    return joins.add_runs(rows, runs, "frame", "image", "n", ["duration", "total_hits"]).select("row_id", "duration", "total_hits")


_BACK = ["file_name", "brand", "location", "screen_location"]


@query(f"WITH k AS (SELECT {', '.join(_BACK)} FROM exposures GROUP BY ALL HAVING count(*) > 1) SELECT DISTINCT e.{', e.'.join(_BACK)}, e.screen_time FROM exposures e JOIN k ON " + " AND ".join(f"e.{c} IS NOT DISTINCT FROM k.{c}" for c in _BACK))
def q_join_back(spark, folder):
    t = table(spark, folder, "exposures").select(*_BACK, "screen_time")
    again = t.groupBy(*_BACK).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return joins.join_back(again, t, _BACK)


@query(
    """
WITH g AS (SELECT brand, min(location) AS place FROM bbl WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY brand)
SELECT row_id, e.brand, coalesce(e.location, g.place) AS location FROM exposures e LEFT JOIN g ON e.brand = g.brand"""
)
def q_reattach_group(spark, folder):
    return joins.reattach(table(spark, folder, "exposures").select("row_id", "brand", "location"), table(spark, folder, "bbl"), "brand", "location")


# -- columns and null rows -------------------------------------------------------------------------------------------


@query("SELECT row_id, frame, brand, location, duration FROM news_exposures")
def q_column_moves(spark, folder):
    t = table(spark, folder, "news_exposures").select("row_id", "location", "brand", "duration", "frame")
    return columns.move_column(columns.swap_columns(t, "location", "brand"), "frame", 1)


@query("SELECT brand, location FROM (SELECT nullif(trim(brand), '') AS brand, nullif(trim(location), '') AS location FROM bbl) WHERE brand IS NOT NULL OR location IS NOT NULL")
def q_drop_null_rows(spark, folder):
    t = table(spark, folder, "bbl").select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in ("brand", "location")])
    return columns.without_empty_rows(t)


@query("SELECT row_id, brand, location, channel, solus FROM (SELECT row_id, brand, location, CASE WHEN brand IS NULL THEN NULL ELSE channel END AS channel, nullif(solus, 0) AS solus FROM news_exposures) WHERE brand IS NOT NULL OR location IS NOT NULL OR channel IS NOT NULL OR solus IS NOT NULL")
def q_drop_null_subset(spark, folder):
    t = table(spark, folder, "news_exposures").select("row_id", "brand", "location", F.when(F.col("brand").isNotNull(), F.col("channel")).alias("channel"), F.nullif("solus", F.lit(0)).alias("solus"))
    return columns.without_empty_rows(t, ["brand", "location", "channel", "solus"])


@query("SELECT DISTINCT file_name, regexp_matches(upper(file_name), 'CUP|RALLY') AS skipped FROM exposures WHERE file_name IS NOT NULL")
def q_skip_by_word(spark, folder):
    t = table(spark, folder, "exposures").select("file_name").dropna().distinct()
    return t.withColumn("skipped", names.names_country(F.col("file_name"), ["cup", "rally"]))


@query("SELECT i, brand, n FROM (SELECT row_number() OVER (ORDER BY n, brand) AS i, brand, n FROM (SELECT brand, count(*) AS n FROM bbl WHERE brand IS NOT NULL GROUP BY brand)) WHERE i <= 10")
def q_order_by_last(spark, folder):
    t = table(spark, folder, "bbl").filter("brand is not null").groupBy("brand").agg(F.count(F.lit(1)).alias("n"))
    top = columns.by_last_column(t.select("brand", "n", F.struct("n", "brand").alias("last"))).limit(10)
    return top.select(F.row_number().over(Window.orderBy("n", "brand")).cast("bigint").alias("i"), "brand", "n")


@query("SELECT video, arg_min(path, struct_pack(a := CAST(regexp_extract(path, '([0-9]+)', 1) AS BIGINT), b := CAST(regexp_extract(path, 'part-([0-9]+)', 1) AS BIGINT), c := path)) AS first_path FROM shard_files WHERE video IS NOT NULL AND path IS NOT NULL GROUP BY video")
def q_first_number_order(spark, folder):
    t = table(spark, folder, "shard_files").dropna(subset=["video", "path"])
    key = F.struct(first_number(F.col("path")), first_number(F.regexp_extract("path", "part-([0-9]+)", 1)), "path")
    return t.groupBy("video").agg(F.min_by("path", key).alias("first_path"))


@query("SELECT row_id, brand, screen_location FROM exposures WHERE screen_location = 'B' AND total_hits = 3")
def q_exact_filters(spark, folder):
    t = columns.exact_filters(table(spark, folder, "exposures"), {"screen_location": "B", "total_hits": "3", "brand": ""})
    return t.select("row_id", "brand", "screen_location")


# -- names and numbers -----------------------------------------------------------------------------------------------


@query(
    r"""
WITH p AS (SELECT DISTINCT path FROM shard_files WHERE path IS NOT NULL), s AS (SELECT path, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\.[^.]*$', '') AS stem FROM p)
SELECT path, stem, regexp_replace(stem, '[ _-]*(\(?[0-9]+\)?)$', '') AS bare,
  regexp_replace(regexp_replace(split_part(stem, '-', 1), '^reduced_', ''), '_?part ?[0-9]+$', '') AS base,
  regexp_replace(regexp_replace(stem, '([0-9])-([0-9])', '\1_\2', 'g'), '-[A-Za-z]+$', '') AS dashed,
  replace(replace(stem, '-r2', ''), 'part', '') AS cleaned FROM s"""
)
def q_base_names(spark, folder):
    t = table(spark, folder, "shard_files").select("path").dropna().distinct().withColumn("stem", names.stem(F.col("path")))
    s = F.col("stem")
    return t.select("path", "stem", names.unnumbered(F.col("path")).alias("bare"), names.base_name(s).alias("base"), names.dashed_digits(s).alias("dashed"), names.without_any(s, ["-r2", "part"]).alias("cleaned"))


@query("SELECT row_id, brand || '_' || location AS pair FROM news_exposures")
def q_concat_pair(spark, folder):
    return table(spark, folder, "news_exposures").select("row_id", F.concat("brand", F.lit("_"), "location").alias("pair"))


@query("SELECT row_id, replace(replace(location, ' Backcloth', ''), ' Headgear', '') AS place FROM exposures")
def q_positional_replace(spark, folder):
    return table(spark, folder, "exposures").select("row_id", names.without_any(F.col("location"), [" Backcloth", " Headgear"]).alias("place"))


@query(
    """
WITH x AS (SELECT row_id, 'WV_' || replace(screen_time[1:5], ':', '') || '_' || duration AS f FROM bbl WHERE duration IS NOT NULL AND regexp_full_match(screen_time, '[0-9]{2}:[0-9]{2}:[0-9]{2}'))
SELECT row_id, split_part(f, '_', 2) AS start, CAST(split_part(f, '_', 3) AS BIGINT) AS second FROM x WHERE regexp_matches(f, '_[0-9]{4}_[0-9]+$')"""
)
def q_frame_start(spark, folder):
    t = table(spark, folder, "bbl").filter(F.col("duration").isNotNull() & F.col("screen_time").rlike("^[0-9]{2}:[0-9]{2}:[0-9]{2}$"))
    t = t.select("row_id", F.concat(F.lit("WV_"), F.replace(F.substring("screen_time", 1, 5), F.lit(":"), F.lit("")), F.lit("_"), F.col("duration").cast("string")).alias("f"))
    start, second = times.start_of_frame(F.col("f"))
    return t.select("row_id", start.alias("start"), second.alias("second")).filter("start is not null")


@query("SELECT file_name, CASE WHEN count(*) > 0 THEN round((count(*) - count(DISTINCT brand)) / CAST(count(*) AS DOUBLE) * 100, 3) END AS less FROM exposures GROUP BY file_name")
def q_percent_reduction(spark, folder):
    t = table(spark, folder, "exposures").groupBy("file_name").agg(F.count(F.lit(1)).alias("a"), F.countDistinct("brand").alias("b"))
    return t.select("file_name", aggregate.reduction(F.col("a"), F.col("b")).alias("less"))


@query(
    """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey % 800 AS DOUBLE) AS a, CAST(l_partkey % 800 AS DOUBLE) + l_quantity - 20 AS b FROM lineitem),
y AS (SELECT *, least(greatest(least(a, b), 0), 640) AS lo, least(greatest(greatest(a, b), 0), 640) AS hi FROM x)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi FROM y WHERE hi - lo >= 10"""
)
def q_kept_boxes(spark, folder):
    a = (F.col("l_partkey") % 800).cast("double")
    edge = numbers.kept_edge(a, a + F.col("l_quantity").cast("double") - 20, F.lit(640.0))
    t = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", edge.alias("e")).filter("e is not null")
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.get("e", F.lit(0)).alias("lo"), F.get("e", F.lit(1)).alias("hi"))


# -- consecutive frames as a stream ----------------------------------------------------------------------------------


@query(
    f"""
WITH x AS (SELECT DISTINCT file_name, brand, {_NO} FROM batters), y AS (SELECT * FROM x WHERE frame_no IS NOT NULL AND brand IS NOT NULL AND file_name IS NOT NULL),
z AS (SELECT *, frame_no - row_number() OVER (PARTITION BY file_name, brand ORDER BY frame_no) AS g FROM y)
SELECT file_name, brand, min(frame_no) AS first_frame, max(frame_no) AS last_frame, count(*) AS n FROM z GROUP BY file_name, brand, g"""
)
def q_stream_consecutive(spark, folder):
    """Frames come as files of a folder; a watermark closes the runs, and the last file only moves it on."""
    t = table(spark, folder, "batters").select("file_name", "brand", last_number(F.col("frame")).alias("frame_no")).dropna()
    path = scratch(spark, "stream")
    t.write.parquet(f"{path}/in")
    end = t.agg(F.max("frame_no").alias("m")).select(F.lit("").alias("file_name"), F.lit("").alias("brand"), (F.col("m") + 2 * ledger.LATE).alias("frame_no")).filter("frame_no is not null")
    end.write.mode("append").parquet(f"{path}/in")
    stream = ledger.file_stream(spark, f"{path}/in", t.schema, files_per_batch=4)
    out = ledger.consecutive_frames(stream, ["file_name", "brand"], "frame_no", f"{path}/out", f"{path}/checkpoint")
    return out.filter("file_name <> '' or brand <> ''")


QUERIES, SQL = query.queries, query.sql
