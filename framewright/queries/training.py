"""The general operators over the test tables: p3 to p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.text import last_number, strip_all
from framewright.operators import badrows, smallfiles, spikes
from framewright.operators.intervals import periods_and_gaps
from framewright.session import scratch, store
from framewright.tables import table

UPPER = 23.026


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "exposures").select("file_name", "brand", "frame", "duration").filter("duration >= 1")
    t = t.select("file_name", F.lower(strip_all(F.col("brand"))).alias("brand"), last_number(F.col("frame")).alias("a"), "duration").filter("brand <> ''")
    t = t.withColumn("b", F.col("a") + F.col("duration") - 1)
    out = periods_and_gaps(t, ["file_name", "brand"], "a", "b")
    return out.withColumnsRenamed({"first": "first_frame", "last": "last_frame"})


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = (("results_ledger", "processed_at", "avg_total_duration"), ("accumulated_averages", "as_of", "accumulative_avg"))
    rows = None
    for name, at, value in parts:
        t = table(spark, folder, name).select(F.lit(name).alias("table_name"), "brand", "location", F.col(at).alias("at"), F.col(value).alias("value"), "row_id")
        rows = t if rows is None else rows.unionByName(t)
    rows = rows.withColumn("row", F.struct("table_name", "row_id"))
    out = spikes.flag_readings(rows, ["table_name", "brand", "location"], "at", "value", "row", upper=UPPER)
    return out.select("row.table_name", "row.row_id", "kind")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return badrows.rejected_lines(table(spark, folder, "raw_lines"))


def p5_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return badrows.strict_load(table(spark, folder, "raw_lines"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "files")
    smallfiles.write_consolidated(table(spark, folder, "shard_files"), path)
    return smallfiles.read_consolidated(spark, path).select("video", "frame_no", "brand", "location")


def p6_files(spark: SparkSession, folder: str) -> DataFrame:
    return smallfiles.output_files(smallfiles.consolidate(table(spark, folder, "shard_files")))


def p6_packed(spark: SparkSession, folder: str) -> DataFrame:
    records = store(smallfiles.consolidate(table(spark, folder, "shard_files")))
    return smallfiles.packed_files(smallfiles.pack_ranges(records))


QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p5_loaded": p5_loaded, "p6_found": p6_found, "p6_files": p6_files, "p6_packed": p6_packed}

#: White space of any kind at both ends, for DuckDB's regular expressions.
_ENDS = r"^[\s\p{Z}\x{85}\x{1c}-\x{1f}]+|[\s\p{Z}\x{85}\x{1c}-\x{1f}]+$"

_P3 = f"""
WITH r AS (
  SELECT file_name, lower(regexp_replace(brand, '{_ENDS}', '', 'g')) AS brand,
         TRY_CAST(regexp_extract(frame, '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS a, duration
  FROM exposures WHERE duration >= 1),
x AS (SELECT file_name, brand, a, a + duration - 1 AS b FROM r WHERE a IS NOT NULL AND brand <> '' AND file_name IS NOT NULL),
y AS (SELECT *, max(b) OVER (PARTITION BY file_name, brand ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM x),
z AS (SELECT *, sum(CASE WHEN m IS NULL OR a > m + 1 THEN 1 ELSE 0 END)
        OVER (PARTITION BY file_name, brand ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM y),
p AS (SELECT file_name, brand, min(a) AS f, max(b) AS l FROM z GROUP BY file_name, brand, g),
q AS (SELECT *, lag(l) OVER (PARTITION BY file_name, brand ORDER BY f) AS before FROM p)
SELECT file_name, brand, 'period' AS kind, f AS first_frame, l AS last_frame FROM p
UNION ALL
SELECT file_name, brand, 'gap', before + 1, f - 1 FROM q WHERE before IS NOT NULL
"""

_P4 = f"""
WITH r AS (
  SELECT 'results_ledger' AS t, brand AS b, location AS l, processed_at AS tm, avg_total_duration AS v, row_id FROM results_ledger
  UNION ALL
  SELECT 'accumulated_averages', brand, location, as_of, accumulative_avg, row_id FROM accumulated_averages),
d AS (SELECT DISTINCT t, b, l, tm, v FROM r WHERE v IS NOT NULL),
f AS (SELECT *, (isnan(v) OR v < 0 OR v > {UPPER}) AS bad,
        row_number() OVER (PARTITION BY t, b, l ORDER BY tm NULLS FIRST, v)
          - row_number() OVER (PARTITION BY t, b, l, v ORDER BY tm NULLS FIRST) AS g FROM d),
s AS (SELECT *, count(*) OVER (PARTITION BY t, b, l, v, g) >= 6 AS stuck FROM f),
n AS (SELECT * FROM s WHERE NOT bad AND NOT stuck),
m AS (SELECT t, b, l, median(v) AS mid FROM n GROUP BY t, b, l),
k AS (SELECT n.t, n.b, n.l, any_value(mid) AS mid, median(abs(v - mid)) AS mad FROM n JOIN m
        ON n.t = m.t AND n.b IS NOT DISTINCT FROM m.b AND n.l IS NOT DISTINCT FROM m.l GROUP BY n.t, n.b, n.l),
c AS (SELECT n.t, n.b, n.l, avg(v) AS level, stddev_pop(v) AS sd FROM n JOIN k
        ON n.t = k.t AND n.b IS NOT DISTINCT FROM k.b AND n.l IS NOT DISTINCT FROM k.l
        WHERE abs(v - mid) <= 5 * 1.4826 * mad GROUP BY n.t, n.b, n.l),
w AS (SELECT s.*, CASE WHEN bad THEN 'impossible' WHEN stuck THEN 'stuck' WHEN abs(v - level) > 6 * sd + 1e-9 THEN 'spike' END AS kind
        FROM s LEFT JOIN c ON s.t = c.t AND s.b IS NOT DISTINCT FROM c.b AND s.l IS NOT DISTINCT FROM c.l)
SELECT r.t AS table_name, r.row_id, w.kind FROM r JOIN w
  ON r.t = w.t AND r.b IS NOT DISTINCT FROM w.b AND r.l IS NOT DISTINCT FROM w.l AND r.tm IS NOT DISTINCT FROM w.tm AND r.v = w.v
WHERE w.kind IS NOT NULL
"""

_FIELD = {d: f'"([^"]|"")*"|[^"{d}]*' for d in ("\\t", ";", ",")}


def _by_sep(make) -> str:
    return "CASE sep " + " ".join(f"WHEN {'chr(9)' if d == chr(92) + 't' else repr(d)} THEN {make(d, f)}" for d, f in _FIELD.items()) + " END"


_P5_BASE = f"""
WITH h AS (
  SELECT file_name, CASE WHEN contains(raw, chr(9)) THEN chr(9) WHEN contains(raw, ';') THEN ';' ELSE ',' END AS sep
  FROM raw_lines WHERE line_no = 1),
x AS (SELECT line_id, file_name, regexp_replace(coalesce(raw, ''), '\\r$', '') AS body, sep FROM raw_lines JOIN h USING (file_name) WHERE line_no <> 1),
y AS (SELECT *, {_by_sep(lambda d, f: f"regexp_full_match(body, '(?s)({f})({d}({f}))*')")} AS quoted_well,
        {_by_sep(lambda d, f: f"regexp_extract_all(sep || body, '(?s){d}({f})', 1)")} AS parts FROM x),
z AS (SELECT line_id, file_name, quoted_well,
        list_transform(parts, lambda p: CASE WHEN p[1] = '"' THEN replace(p[2:-2], '""', '"') ELSE p END) AS f FROM y),
c AS (SELECT *, len(f) = 9 AS nine,
        regexp_matches(f[1], '[^\\s\\p{{Z}}\\p{{C}}]') AND regexp_matches(f[2], '[^\\s\\p{{Z}}\\p{{C}}]')
        AND regexp_full_match(f[3], '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') AND regexp_full_match(f[4], '0*[1-9][0-9]*')
        AND regexp_full_match(f[5], '[A-E]') AND regexp_full_match(f[6], '[0-9]+([.][0-9]+)?') AND coalesce(TRY_CAST(f[6] AS DOUBLE) <= 100, false)
        AND regexp_full_match(f[7], '0*[1-9][0-9]*') AND regexp_full_match(f[8], '[0-9]+([.][0-9]+)?')
        AND regexp_full_match(f[9], '(?s)(.*_)?[0-9]+') AS fit FROM z)
"""
_P5 = _P5_BASE + """
SELECT line_id, CASE WHEN NOT quoted_well THEN 'quoting' WHEN NOT nine THEN 'column_count' ELSE 'value' END AS reason
FROM c WHERE NOT (quoted_well AND nine AND fit)
"""
_P5_LOADED = _P5_BASE + """
SELECT line_id, file_name, f[1] AS brand, f[2] AS location, f[3] AS screen_time, TRY_CAST(f[4] AS INTEGER) AS duration, f[5] AS screen_location,
  TRY_CAST(f[6] AS DOUBLE) AS screen_size_pct, TRY_CAST(f[7] AS INTEGER) AS total_hits, TRY_CAST(f[8] AS DOUBLE) AS average_hits, f[9] AS frame
FROM c WHERE quoted_well AND nine AND fit
"""

_P6_BASE = """
WITH l AS (SELECT video, unnest(string_split_regex(content, '\r\n|\n|\r')) AS line FROM shard_files),
f AS (SELECT video, string_split(line, chr(9)) AS f FROM l WHERE line <> ''),
r AS (SELECT video, TRY_CAST(regexp_extract(f[4], '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS frame_no, f[1] AS brand, f[2] AS location
      FROM f WHERE len(f) >= 4 AND NOT (f[1] = 'Brand' AND f[2] = 'Location' AND f[3] = 'Duration' AND f[4] = 'Sequence Frame Number'))
"""
_P6 = _P6_BASE + "SELECT DISTINCT video, frame_no, brand, location FROM r"
_P6_PARTS = _P6_BASE + f""", d AS (SELECT DISTINCT * FROM r),
z AS (SELECT *, CAST(frame_no // {smallfiles.RANGE} AS BIGINT) AS part, 16 + strlen(brand) + strlen(location) AS b FROM d),
p AS (SELECT *, CAST((sum(b) OVER (PARTITION BY video, part ORDER BY frame_no, brand, location ROWS UNBOUNDED PRECEDING) - b) // {smallfiles.TARGET_BYTES} AS BIGINT) AS roll FROM z)
"""
_P6_FILES = _P6_PARTS + """
SELECT video, part, roll, min(frame_no) AS first_frame, max(frame_no) AS last_frame, count(*) AS records, CAST(sum(b) AS BIGINT) AS n_bytes FROM p GROUP BY video, part, roll
"""
_P6_PACKED = _P6_PARTS + f""", g AS (SELECT video, part, sum(b) AS n FROM p GROUP BY video, part),
k AS (SELECT video, part, CAST((sum(n) OVER (ORDER BY video NULLS FIRST, part) - n) // {smallfiles.TARGET_BYTES} AS BIGINT) AS pack, n > {smallfiles.TARGET_BYTES} AS large FROM g),
q AS (SELECT p.* EXCLUDE (roll), pack, large, CASE WHEN large THEN roll ELSE 0 END AS roll FROM p JOIN k ON p.video IS NOT DISTINCT FROM k.video AND p.part = k.part)
SELECT pack, large, roll, arg_min(video, struct_pack(v := coalesce(video, ''), f := frame_no)) AS first_video, arg_max(video, struct_pack(v := coalesce(video, ''), f := frame_no)) AS last_video,
  arg_min(frame_no, struct_pack(v := coalesce(video, ''), f := frame_no)) AS first_frame, arg_max(frame_no, struct_pack(v := coalesce(video, ''), f := frame_no)) AS last_frame,
  count(DISTINCT struct_pack(v := video, p := part)) AS ranges, count(*) AS records, CAST(sum(b) AS BIGINT) AS n_bytes
FROM q GROUP BY pack, large, roll
"""

SQL = {"p3_found": _P3, "p4_found": _P4, "p5_found": _P5, "p5_loaded": _P5_LOADED, "p6_found": _P6, "p6_files": _P6_FILES, "p6_packed": _P6_PACKED}
