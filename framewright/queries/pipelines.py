"""The pipelines and streams over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewright.functions.text import last_number
from framewright.plans import pipelines
from framewright.queries.exposures import _NO, numbered
from framewright.queries.registry import Registry
from framewright.session import scratch
from framewright.sources.documents import roster
from framewright.streaming import ledger
from framewright.tables import table

query = Registry()


_SHEET_COLS = "frame_no, row_id, brand, location, duration, screen_time, screen_location, screen_size_pct, average_hits"
_SHEET_KEYS = "file, brand, location, screen_time, screen_location, screen_size_pct, average_hits, player, inning"


def _vote(source: str, value: str) -> str:
    """The most frequent value of each file and frame, of equally frequent ones that of the least row."""
    return f"""
SELECT * REPLACE (CASE WHEN kinds > 1 THEN best ELSE {value} END AS {value}) FROM {source} LEFT JOIN (
  SELECT file, frame_no, arg_min({value}, struct_pack(n := -n, r := r)) AS best, count(*) AS kinds
  FROM (SELECT file, frame_no, {value}, count(*) AS n, min(row) AS r FROM {source} GROUP BY file, frame_no, {value}) GROUP BY file, frame_no) USING (file, frame_no)"""


@query(
    f"""
WITH e AS (SELECT file_name AS file, * EXCLUDE (file_name), {_NO} FROM exposures), b AS (SELECT regexp_replace(file_name, '^batters_', '') AS file, * EXCLUDE (file_name), {_NO} FROM batters),
y AS (SELECT *, CASE WHEN brand = lag(brand) OVER (PARTITION BY file ORDER BY frame_no, row_id) THEN 0 ELSE 1 END AS new FROM b WHERE frame_no IS NOT NULL),
z AS (SELECT *, CAST(sum(new) OVER (PARTITION BY file ORDER BY frame_no, row_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM y),
w AS (SELECT file, frame_no, row_id, CASE WHEN run % 2 = 1 THEN 'Top ' || (run + 1) // 2 ELSE 'Bottom ' || run // 2 END AS inning,
  coalesce(last_value(location IGNORE NULLS) OVER (PARTITION BY file ORDER BY frame_no, row_id ROWS UNBOUNDED PRECEDING),
           first_value(location IGNORE NULLS) OVER (PARTITION BY file ORDER BY frame_no, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS player FROM z),
x AS (SELECT *, frame_no + unnest(range(duration)) AS f FROM (SELECT file, {_SHEET_COLS} FROM e UNION ALL SELECT file, {_SHEET_COLS} FROM b)
  WHERE duration >= 1 AND frame_no IS NOT NULL AND NOT regexp_matches(location, '[0-9]\\s*-\\s*')),
l AS (SELECT file, frame_no, arg_max(player, row_id) AS player, arg_max(inning, row_id) AS inning FROM w GROUP BY file, frame_no),
s AS (SELECT file, arg_min(player, struct_pack(f := frame_no, r := row_id)) AS player, arg_min(inning, struct_pack(f := frame_no, r := row_id)) AS inning FROM w GROUP BY file),
here AS (SELECT x.*, w.player, w.inning FROM x JOIN w ON x.file = w.file AND x.f = w.frame_no),
other AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.file = x.file AND l.frame_no = x.f)),
fill AS (SELECT o.*, coalesce(l.player, s.player) AS player, coalesce(l.inning, s.inning) AS inning FROM other o ASOF LEFT JOIN l ON o.file = l.file AND o.f >= l.frame_no JOIN s ON o.file = s.file),
a AS (SELECT * FROM here UNION ALL SELECT * FROM fill),
c AS (SELECT {_SHEET_KEYS}, count(*) AS duration, count(*) AS total_hits, min(f) AS frame_no,
    struct_pack(a := file, b := brand, c := location, d := screen_time, e := screen_location, f := screen_size_pct, g := average_hits, h := player, i := inning) AS row
  FROM a WHERE {" AND ".join(f"{k} IS NOT NULL" for k in _SHEET_KEYS.split(", "))} GROUP BY {_SHEET_KEYS}),
p AS ({_vote("c", "player")}), q AS (SELECT * EXCLUDE (best, kinds) FROM p), i AS ({_vote("q", "inning")})
SELECT {_SHEET_KEYS}, duration, total_hits, frame_no FROM i"""
)
def q_player_sheet(spark, folder):
    cols = ["frame_no", "row_id", "brand", "location", "duration", "screen_time", "screen_location", "screen_size_pct", "average_hits"]
    e = numbered(spark, folder, "exposures").select(F.col("file_name").alias("file"), *cols)
    b = numbered(spark, folder, "batters").select(F.regexp_replace("file_name", "^batters_", "").alias("file"), *cols)
    return pipelines.player_sheet(e, b)


@query(
    f"""
WITH o AS (SELECT * FROM results_ledger WHERE isfinite(avg_total_duration) AND abs(avg_total_duration) < 24 AND processed_at < TIMESTAMP '2011-01-20'),
x AS (SELECT *, {_NO} FROM exposures WHERE file_name NOT IN (SELECT file_name FROM o WHERE file_name IS NOT NULL)),
y AS (SELECT * FROM x WHERE frame_no IS NOT NULL AND duration >= 1),
s AS (SELECT file_name, arg_max(frame_no, row_id) - arg_min(frame_no, row_id) + arg_max(duration, row_id) AS t FROM y GROUP BY file_name),
d AS (SELECT file_name, brand, location, CAST(sum(duration) AS BIGINT) AS n FROM y WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL),
a AS (SELECT brand, location, round(CAST(sum(CAST(round(abs(ln(abs(CASE WHEN t > 0 THEN n / CAST(t AS DOUBLE) ELSE 0 END) + 1e-10)), 3) AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 3) AS new_value FROM d JOIN s USING (file_name) GROUP BY ALL),
b AS (SELECT brand, location, round(CAST(sum(CAST(avg_total_duration AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 3) AS old_value FROM o GROUP BY ALL)
SELECT brand, location, new_value, old_value, round(abs((new_value - old_value) / old_value) * 100, 3) AS difference
FROM a JOIN b USING (brand, location) WHERE abs((new_value - old_value) / old_value) * 100 > 25"""
)
def q_history_check(spark, folder):
    e = numbered(spark, folder, "exposures").filter("frame_no is not null and duration >= 1")
    v = F.col("avg_total_duration")
    held = table(spark, folder, "results_ledger").filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 24))
    return pipelines.checked_against_history(e, held.filter("processed_at < timestamp_ntz'2011-01-20 00:00:00'"))[1]


@query(
    f"""
WITH o AS (SELECT * FROM results_ledger WHERE isfinite(avg_total_duration) AND abs(avg_total_duration) < 24),
x AS (SELECT *, {_NO} FROM exposures WHERE file_name NOT IN (SELECT file_name FROM results_ledger WHERE file_name IS NOT NULL)),
y AS (SELECT * FROM x WHERE frame_no IS NOT NULL AND duration >= 1),
s AS (SELECT file_name, arg_max(frame_no, row_id) - arg_min(frame_no, row_id) + arg_max(duration, row_id) AS t FROM y GROUP BY file_name),
d AS (SELECT file_name, brand, location, CAST(sum(duration) AS BIGINT) AS n FROM y WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL),
a AS (SELECT brand, location, round(CAST(sum(CAST(round(abs(ln(abs(CASE WHEN t > 0 THEN n / CAST(t AS DOUBLE) ELSE 0 END) + 1e-10)), 3) AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 3) AS new_value FROM d JOIN s USING (file_name) GROUP BY ALL),
b AS (SELECT brand, location, round(CAST(sum(CAST(avg_total_duration AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 3) AS old_value FROM o GROUP BY ALL)
SELECT brand, location, new_value, old_value, round(abs((new_value - old_value) / old_value) * 100, 3) AS difference
FROM a JOIN b USING (brand, location) WHERE abs((new_value - old_value) / old_value) * 100 > 25"""
)
def q_history_check_whole(spark, folder):
    e = numbered(spark, folder, "exposures").filter("frame_no is not null and duration >= 1")
    return pipelines.checked_against_history(e, table(spark, folder, "results_ledger"))[1]


@query(
    """
WITH p AS (SELECT doc_id AS art_id, user_name AS user, 'https://example.org/' || doc_id AS url, followers FROM documents WHERE doc_kind = 'post'),
t AS (SELECT DISTINCT doc_id AS art_id, sponsor, 'Text' AS touchpoint, CAST(NULL AS DOUBLE) AS percentage FROM (SELECT doc_id, unnest(regexp_extract_all(text, '#([A-Za-z]+)', 1)) AS sponsor FROM documents)),
f AS (SELECT p.art_id AS a, t.art_id AS b, user, url, followers, sponsor, touchpoint, percentage FROM p FULL JOIN t ON p.art_id = t.art_id
  UNION ALL SELECT art_id, art_id, user, url, followers, 'photo', 'Photo', 1.5 FROM p WHERE false),
g AS (SELECT coalesce(a, b) AS art_id, user, url, followers, sponsor, touchpoint, percentage FROM f WHERE b IS NOT NULL OR NOT (coalesce(followers, 0) > 1000))
SELECT dense_rank() OVER (ORDER BY art_id) AS report_id, art_id, user, url, followers, sponsor, touchpoint, percentage FROM g"""
)
def q_social_report(spark, folder):
    d = table(spark, folder, "documents")
    art = d.filter("doc_kind = 'post'").select(F.col("doc_id").alias("art_id"), F.col("user_name").alias("user"), F.concat(F.lit("https://example.org/"), "doc_id").alias("url"), "followers")
    text = d.filter("text is not null").select(F.col("doc_id").alias("art_id"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("#([A-Za-z]+)"), 1))).alias("sponsor"), F.lit("Text").alias("touchpoint"))
    photo = d.filter("doc_kind = 'post' and followers > 1000").select(F.col("doc_id").alias("art_id"), F.concat(F.lit("https://example.org/p/"), "doc_id").alias("photo_url"), F.lit("photo").alias("sponsor"), F.lit("Photo").alias("touchpoint"), F.lit(1.5).alias("percentage"))
    return pipelines.social_report(art, text, photo)


@query()
def q_html_roster(spark, folder):
    t = table(spark, folder, "reference_names").groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("ref_id", "name"))).alias("a"))
    cells = F.array_join(F.transform("a", lambda x: F.concat(F.lit("<tr><td>"), x["ref_id"].cast("string"), F.lit("</td><td>"), F.replace(x["name"], F.lit("&"), F.lit("&amp;")), F.lit("</td></tr>"))), "")
    pages = t.select("kind", F.concat(F.lit("<table><tr><th>No</th><th>Name</th></tr>"), cells, F.lit("</table>")).alias("html"))
    return roster(pages, "kind", "html").select("kind", "row_no", "name")


_ROSTER = """
SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY ref_id) - 1 AS INTEGER) AS row_no, name FROM reference_names"""
query.sql["q_html_roster"] = _ROSTER


@query("SELECT brand, location, CAST(sum(duration) AS BIGINT) AS total, count(*) AS n FROM bbl WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY brand, location")
def q_stream_ledger(spark, folder):
    base = scratch(spark, "stream")
    path = f"{folder}/bbl.parquet"
    stream = ledger.file_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=8)
    return ledger.cumulative_totals(stream, ["brand", "location"], "duration", f"{base}/ledger", f"{base}/checkpoint")


@query(
    f"""
WITH x AS (SELECT DISTINCT file_name, brand, {_NO} FROM batters), y AS (SELECT * FROM x WHERE frame_no IS NOT NULL AND brand IS NOT NULL),
z AS (SELECT *, frame_no - row_number() OVER (PARTITION BY file_name, brand ORDER BY frame_no) AS g FROM y)
SELECT file_name, brand, min(frame_no) AS first_frame, max(frame_no) AS last_frame, count(*) AS n FROM z GROUP BY file_name, brand, g"""
)
def q_stream_sessions(spark, folder):
    t = table(spark, folder, "batters").select("file_name", "brand", last_number(F.col("frame")).alias("frame_no")).dropna().distinct()
    return ledger.frame_sessions(t, ["file_name", "brand"], "frame_no")


QUERIES, SQL = query.queries, query.sql
