"""Projections, filters, aggregations, reshaping and scalar functions over the exposure tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import numbers, times
from framewright.functions.names import natural_key
from framewright.functions.text import last_number, strip_all, word_count
from framewright.operators import aggregate, columns, reshape, sequences
from framewright.operators.ordered import rank_in_group
from framewright.operators.stretches import Ordering, frames
from framewright.queries.registry import Registry
from framewright.tables import table

query = Registry()

_NO = "TRY_CAST(regexp_extract(frame, '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS frame_no"
_X = f"WITH x AS (SELECT *, {_NO} FROM exposures)"
_B = f"WITH x AS (SELECT *, {_NO} FROM batters)"


def numbered(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(spark, folder, name).withColumn("frame_no", last_number(F.col("frame").cast("string")))


@query(
    _X
    + """
SELECT file_name, brand, location, screen_location, average_hits, count(*) AS duration, count(*) AS total_hits, min(frame_no + i) AS frame_no
FROM (SELECT *, unnest(range(duration)) AS i FROM x WHERE duration >= 1 AND file_name IS NOT NULL AND brand IS NOT NULL AND location IS NOT NULL
      AND screen_location IS NOT NULL AND average_hits IS NOT NULL)
GROUP BY file_name, brand, location, screen_location, average_hits"""
)
def q_exposure_compact(spark, folder):
    keys = ["file_name", "brand", "location", "screen_location", "average_hits"]
    out = reshape.compact_expanded(numbered(spark, folder, "exposures").select(*keys, "frame_no", "duration", "total_hits"), keys)
    # The least expanded frame is the least first frame.
    return out.select(*keys, "duration", "total_hits", "frame_no")


@query(_X + " SELECT row_id, frame_no + i AS frame_no, CAST(1 AS INTEGER) AS duration, CAST(1 AS INTEGER) AS total_hits FROM (SELECT *, unnest(range(duration)) AS i FROM x WHERE duration >= 1)")
def q_expand_duration(spark, folder):
    t = numbered(spark, folder, "exposures").select("row_id", "frame_no", "duration", "total_hits")
    return reshape.expand_duration(t)


@query(
    """
WITH x AS (SELECT row_id, frame, duration, regexp_extract(frame, '([0-9]+)$', 1) AS d FROM batters WHERE duration >= 1),
y AS (SELECT row_id, left(frame, length(frame) - length(d)) AS p, CAST(CAST(d AS BIGINT) + unnest(range(duration)) AS VARCHAR) AS n, length(d) AS w FROM x WHERE d <> '')
SELECT row_id, p || lpad(n, CAST(greatest(w, length(n)) AS INTEGER), '0') AS frame, CAST(1 AS INTEGER) AS duration FROM y"""
)
def q_expand_padded_frame(spark, folder):
    return reshape.expand_padded(table(spark, folder, "batters").select("row_id", "frame", "duration"))


@query(
    """
SELECT file_name, brand, location, screen_location, total_hits, average_hits, CAST(sum(duration) AS BIGINT) AS duration, min(frame) AS frame
FROM exposures WHERE file_name IS NOT NULL AND brand IS NOT NULL AND location IS NOT NULL AND screen_location IS NOT NULL AND total_hits IS NOT NULL AND average_hits IS NOT NULL
GROUP BY file_name, brand, location, screen_location, total_hits, average_hits"""
)
def q_compact_seven_keys(spark, folder):
    keys = ["file_name", "brand", "location", "screen_location", "total_hits", "average_hits"]
    return reshape.compact(table(spark, folder, "exposures").select(*keys, "duration", "frame"), keys, ["duration"], "frame")


@query("SELECT file_name, brand, location, CAST(sum(duration) AS BIGINT) AS total FROM exposures WHERE file_name IS NOT NULL AND brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL")
def q_brand_location_total(spark, folder):
    return aggregate.totals(table(spark, folder, "exposures"), ["file_name", "brand", "location"], "duration", "total")


@query("SELECT brand, CAST(sum(duration) AS BIGINT) AS total FROM exposures WHERE brand IS NOT NULL GROUP BY brand HAVING sum(duration) > 1000")
def q_brand_threshold(spark, folder):
    return aggregate.at_least(table(spark, folder, "exposures"), ["brand"], "duration", "total", 1000)


@query(
    """
SELECT file_name, count(*) FILTER (brand IS NULL) AS no_brand, count(*) FILTER (location IS NULL) AS no_location,
  count(*) FILTER (brand IS NOT NULL AND location IS NOT NULL) AS kept, count(*) AS n FROM exposures GROUP BY file_name"""
)
def q_null_brand_report(spark, folder):
    b, loc = F.col("brand"), F.col("location")
    return table(spark, folder, "exposures").groupBy("file_name").agg(F.count_if(b.isNull()).alias("no_brand"), F.count_if(loc.isNull()).alias("no_location"), F.count_if(b.isNotNull() & loc.isNotNull()).alias("kept"), F.count(F.lit(1)).alias("n"))


@query("SELECT file_name, count(*) AS blank FROM exposures WHERE brand IS NULL OR trim(brand) = '' OR location IS NULL OR trim(location) = '' GROUP BY file_name")
def q_completeness_guard(spark, folder):
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c)) == "")
    return table(spark, folder, "exposures").filter(blank("brand") | blank("location")).groupBy("file_name").agg(F.count(F.lit(1)).alias("blank"))


@query(r"SELECT row_id, location FROM batters WHERE NOT coalesce(regexp_matches(location, '[0-9]\s*-\s*'), false)")
def q_regex_exclude(spark, folder):
    return table(spark, folder, "batters").filter(~F.coalesce(F.col("location").rlike("[0-9]\\s*-\\s*"), F.lit(False))).select("row_id", "location")


@query("SELECT row_id, brand FROM bbl WHERE brand IS DISTINCT FROM 'Roboudre'")
def q_not_equal_keep_null(spark, folder):
    return table(spark, folder, "bbl").filter(~F.col("brand").eqNullSafe("Roboudre")).select("row_id", "brand")


@query(
    """
SELECT row_id, CASE WHEN contains(location, 'Overlay') THEN 'graphic' ELSE 'board' END AS route, CASE WHEN contains(location, 'Backcloth') THEN 0 ELSE 1 END AS flag
FROM news_exposures WHERE location IS NOT NULL"""
)
def q_route_contains(spark, folder):
    loc = F.col("location")
    return table(spark, folder, "news_exposures").filter(loc.isNotNull()).select("row_id", F.when(F.contains(loc, F.lit("Overlay")), "graphic").otherwise("board").alias("route"), F.when(F.contains(loc, F.lit("Backcloth")), 0).otherwise(1).alias("flag"))


@query(
    """
SELECT shard_id, regexp_extract(path, '([^/]*)$', 1) AS name, lower(regexp_extract(path, '([^.]*)$', 1)) AS suffix
FROM shard_files WHERE regexp_matches(path, 'part-[0-9]{5}') AND NOT regexp_matches(path, '(copy|bak)') AND lower(regexp_extract(path, '([^.]*)$', 1)) IN ('tsv', 'csv')"""
)
def q_name_predicates(spark, folder):
    p, suffix = F.col("path"), F.lower(F.substring_index("path", ".", -1))
    ok = p.rlike("part-[0-9]{5}") & ~p.rlike("(copy|bak)") & suffix.isin("tsv", "csv")
    return table(spark, folder, "shard_files").filter(ok).select("shard_id", F.substring_index("path", "/", -1).alias("name"), suffix.alias("suffix"))


@query(
    """
SELECT channel, CAST(sum(duration) AS BIGINT) AS seconds, round(CAST(sum(duration) AS BIGINT) / 3600.0, 3) AS hours FROM news_exposures
WHERE strptime(air_date, '%d/%m/%Y') BETWEEN DATE '2011-01-10' AND DATE '2011-02-20' GROUP BY channel"""
)
def q_date_range_footage(spark, folder):
    t = table(spark, folder, "news_exposures").filter(times.day(F.col("air_date")).between(F.lit("2011-01-10").cast("date"), F.lit("2011-02-20").cast("date")))
    out = t.groupBy("channel").agg(F.sum("duration").cast("bigint").alias("seconds"))
    return out.withColumn("hours", F.round(F.col("seconds") / 3600, 3))


@query("SELECT file_name, string_agg(brand, ',' ORDER BY row_id) AS brands FROM results_ledger WHERE brand IS NOT NULL GROUP BY file_name")
def q_group_list(spark, folder):
    return aggregate.joined_list(table(spark, folder, "results_ledger"), ["file_name"], "brand", "row_id", "brands")


@query(
    """
SELECT '#' || brand || chr(10) || string_agg(location, chr(10) ORDER BY location) AS report
FROM (SELECT DISTINCT brand, location FROM results_ledger WHERE brand IS NOT NULL AND location IS NOT NULL) GROUP BY brand"""
)
def q_group_set_report(spark, folder):
    out = aggregate.joined_set(table(spark, folder, "results_ledger"), ["brand"], "location", "places", "\n")
    return out.select(F.concat(F.lit("#"), F.col("brand"), F.lit("\n"), F.col("places")).alias("report"))


@query("SELECT DISTINCT brand || '_' || location AS pair FROM bbl WHERE brand IS NOT NULL AND location IS NOT NULL")
def q_distinct_pairs(spark, folder):
    return table(spark, folder, "bbl").select(F.concat("brand", F.lit("_"), "location").alias("pair")).filter("pair is not null").distinct()


@query("SELECT source, count(DISTINCT user_name) AS users, max(CASE WHEN user_name IS NULL THEN 1 ELSE 0 END) AS unnamed FROM documents GROUP BY source")
def q_distinct_photos(spark, folder):
    return table(spark, folder, "documents").groupBy("source").agg(F.countDistinct("user_name").alias("users"), F.max(F.when(F.col("user_name").isNull(), 1).otherwise(0)).alias("unnamed"))


@query(
    r"""SELECT lower(tag) AS tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '#([A-Za-z0-9_]+)', 1)) AS tag FROM documents) GROUP BY 1"""
)
def q_mention_counts(spark, folder):
    tags = table(spark, folder, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("#([A-Za-z0-9_]+)"), 1)).alias("tag"))
    return tags.groupBy(F.lower("tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"))


@query(_X + " SELECT brand, location, count(DISTINCT struct_pack(f := file_name, n := frame_no)) AS frames FROM x WHERE brand IS NOT NULL AND location IS NOT NULL AND frame_no IS NOT NULL GROUP BY brand, location")
def q_frequency(spark, folder):
    t = numbered(spark, folder, "exposures").dropna(subset=["brand", "location", "frame_no"])
    return t.select("brand", "location", "file_name", "frame_no").distinct().groupBy("brand", "location").agg(F.count(F.lit(1)).alias("frames"))


@query(
    """
SELECT video, regexp_extract(path, '([^/.]*)[.]', 1) LIKE '%copy%' AS copied, count(*) AS n, round(count(*) / 3600.0, 3) AS hours
FROM shard_files GROUP BY ROLLUP (video, copied)"""
)
def q_folder_rollup(spark, folder):
    t = table(spark, folder, "shard_files").select("video", F.contains(F.regexp_extract("path", "([^/.]*)[.]", 1), F.lit("copy")).alias("copied"))
    return aggregate.levels(t, ["video", "copied"])


@query(_X + " SELECT frame_no, CAST(sum(duration) AS BIGINT) AS total FROM x WHERE brand = 'Roboudre' AND frame_no IS NOT NULL GROUP BY frame_no")
def q_frame_distribution(spark, folder):
    return aggregate.totals(numbered(spark, folder, "exposures").filter("brand = 'Roboudre'"), ["frame_no"], "duration", "total")


_SPAN = "s AS (SELECT file_name, CAST(arg_max(frame_no, row_id) - arg_min(frame_no, row_id) + coalesce(arg_max(coalesce(duration, 0), row_id), 0) AS BIGINT) AS total_frames FROM x WHERE frame_no IS NOT NULL GROUP BY file_name)"


@query(
    _X
    + f""", {_SPAN},
d AS (SELECT file_name, brand, location, CAST(sum(duration) AS BIGINT) AS total_duration FROM x WHERE file_name IS NOT NULL AND brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL)
SELECT file_name, brand, location, total_duration, total_frames,
  round(abs(ln(abs(CASE WHEN total_frames > 0 THEN total_duration / CAST(total_frames AS DOUBLE) ELSE 0 END) + 1e-10)), 3) AS avg_total_duration
FROM d JOIN s USING (file_name)"""
)
def q_log_exposure(spark, folder):
    t = numbered(spark, folder, "exposures").select("file_name", "brand", "location", "frame_no", F.col("duration").alias("d"), F.coalesce("duration", F.lit(0)).alias("duration0"), "row_id")
    span = aggregate.file_span(t, "file_name", "frame_no", "duration0", "row_id")
    sums = aggregate.totals(t, ["file_name", "brand", "location"], "d", "total_duration")
    ratio = F.when(F.col("total_frames") > 0, F.col("total_duration") / F.col("total_frames")).otherwise(0.0)
    return sums.join(span, "file_name").select("file_name", "brand", "location", "total_duration", "total_frames", numbers.log_measure(ratio).alias("avg_total_duration"))


@query(
    """
SELECT brand, location, round(CAST(sum(CAST(avg_total_duration AS DECIMAL(18, 3))) AS DOUBLE) / count(*), 3) AS accumulative_avg
FROM results_ledger WHERE isfinite(avg_total_duration) GROUP BY brand, location"""
)
def q_accumulative_avg(spark, folder):
    v = F.col("avg_total_duration")
    t = table(spark, folder, "results_ledger").filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return t.groupBy("brand", "location").agg(F.round(F.sum(v.cast("decimal(18,3)")).cast("double") / F.count(F.lit(1)), 3).alias("accumulative_avg"))


@query(
    """
WITH x AS (SELECT row_id, coalesce(solus, 0) AS solus, CASE WHEN location LIKE '%Overlay%' THEN 1 ELSE 0 END AS overlay, CASE WHEN total_hits > 5 THEN 1 END AS many FROM news_exposures)
SELECT row_id, 'solus' AS sponsor, CAST(solus AS INTEGER) AS flag FROM x WHERE solus <> 0
UNION ALL SELECT row_id, 'overlay', overlay FROM x WHERE overlay <> 0 UNION ALL SELECT row_id, 'many', many FROM x WHERE many <> 0"""
)
def q_unpivot_flags(spark, folder):
    t = table(spark, folder, "news_exposures").select("row_id", "solus", F.when(F.contains("location", F.lit("Overlay")), 1).otherwise(0).alias("overlay"), F.when(F.col("total_hits") > 5, 1).alias("many"))
    return reshape.unpivot_flags(t, ["row_id"], ["solus", "overlay", "many"])


# -- order -----------------------------------------------------------------------------------------------------------

_ORD = "PARTITION BY file_name ORDER BY frame_no, row_id"
_RUN = f"""{_B}, y AS (SELECT *, CASE WHEN brand = lag(brand) OVER ({_ORD}) THEN 0 ELSE 1 END AS new FROM x WHERE frame_no IS NOT NULL),
z AS (SELECT *, CAST(sum(new) OVER ({_ORD} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM y)"""


def _batters(spark: SparkSession, folder: str) -> DataFrame:
    return numbered(spark, folder, "batters").filter("frame_no is not null")


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return sequences.run_index(_batters(spark, folder).select("row_id", "file_name", "brand", "frame_no"), ["file_name"], ["frame_no", "row_id"], ["brand"], frames("frame_no"))


@query(_RUN + " SELECT row_id, run, CAST(row_number() OVER (PARTITION BY file_name, run ORDER BY frame_no, row_id) AS INTEGER) AS pos FROM z")
def q_run_index(spark, folder):
    return _runs(spark, folder).select("row_id", "run", "pos")


@query(_RUN + " SELECT row_id, CASE WHEN run % 2 = 1 THEN 'Top ' || CAST((run + 1) // 2 AS VARCHAR) ELSE 'Bottom ' || CAST(run // 2 AS VARCHAR) END AS inning FROM z")
def q_half_innings(spark, folder):
    return _runs(spark, folder).select("row_id", sequences.half_innings(F.col("run")).alias("inning"))


@query(_RUN + " SELECT row_id, CASE WHEN run % 2 = 1 THEN 'Top ' || CAST(7 + (run - 1) // 2 AS VARCHAR) ELSE 'Bottom ' || CAST(7 + run // 2 AS VARCHAR) END AS inning FROM z")
def q_half_innings_base7(spark, folder):
    return _runs(spark, folder).select("row_id", sequences.half_innings(F.col("run"), 7).alias("inning"))


@query(f"{_B} SELECT row_id, last_value(location IGNORE NULLS) OVER ({_ORD} ROWS UNBOUNDED PRECEDING) AS location FROM x WHERE frame_no IS NOT NULL")
def q_forward_fill(spark, folder):
    return sequences.forward_fill(_batters(spark, folder), ["file_name"], ["frame_no", "row_id"], ["location"], frames("frame_no")).select("row_id", "location")


@query(
    f"""{_B} SELECT row_id, CASE WHEN count(location) OVER ({_ORD} ROWS UNBOUNDED PRECEDING) = 0
  THEN first_value(location IGNORE NULLS) OVER ({_ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE location END AS location FROM x WHERE frame_no IS NOT NULL"""
)
def q_leading_fill(spark, folder):
    return sequences.leading_fill(_batters(spark, folder).select("row_id", "file_name", "frame_no", "location"), ["file_name"], ["frame_no", "row_id"], ["location"]).select("row_id", "location")


@query(
    f"""SELECT row_id, location, next_value FROM ({_B} SELECT row_id, location, frame_no, lead(location) OVER ({_ORD}) AS next_value, lead(frame_no) OVER ({_ORD}) AS nf FROM x WHERE frame_no IS NOT NULL)
WHERE nf = frame_no AND coalesce(location <> next_value, true)"""
)
def q_adjacent_conflict(spark, folder):
    return sequences.adjacent_conflicts(_batters(spark, folder), ["file_name"], ["frame_no", "row_id"], "frame_no", "location", frames("frame_no")).select("row_id", "location", "next_value")


def _merge_sql(source: str, keys: str, offset: str, first: str, last: str, average: str) -> str:
    cols = "".join(f", arg_min({c}, o) AS {c}" for c in first.split()) + "".join(f", arg_max({c}, o) AS {c}" for c in last.split())
    some = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""
WITH a AS (SELECT *, {offset} AS o FROM {source}),
b AS (SELECT * FROM a WHERE o IS NOT NULL AND {some} QUALIFY row_number() OVER (PARTITION BY {keys}, o ORDER BY row_id DESC) = 1),
c AS (SELECT *, o - row_number() OVER (PARTITION BY {keys} ORDER BY o) AS island FROM b),
d AS (SELECT {keys}, min(o) AS first_offset, count(*) AS duration, CAST(sum(total_hits) AS BIGINT) AS hits, arg_max(total_hits, o) AS own{cols} FROM c GROUP BY {keys}, island)
SELECT * EXCLUDE (own), {average} AS average_hits FROM d"""


_ODD = "CASE WHEN hits % duration = 0 THEN CAST(own AS DOUBLE) ELSE round(hits / CAST(duration AS DOUBLE), 3) END"
_TENTH = "floor(hits / CAST(duration AS DOUBLE) * 10 + 0.5) / 10.0"


@query(_merge_sql("exposures", "file_name, brand, location", "TRY_CAST(regexp_extract(frame, '([0-9]+)[^0-9]*$', 1) AS BIGINT)", "screen_time screen_location", "screen_size_pct", _ODD))
def q_consecutive_merge(spark, folder):
    t = numbered(spark, folder, "exposures")
    return sequences.merge_consecutive(t, ["file_name", "brand", "location"], "frame_no", "total_hits", ["screen_time", "screen_location"], ["screen_size_pct"], "row_id", stretch=frames("frame_no"))


@query(_merge_sql("news_exposures", "brand, location, air_date, channel", "frame", "screen_location", "screen_size_pct", _TENTH))
def q_consecutive_merge_dated(spark, folder):
    t = table(spark, folder, "news_exposures")
    return sequences.merge_consecutive(t, ["brand", "location", "air_date", "channel"], "frame", "total_hits", ["screen_location"], ["screen_size_pct"], "row_id", average="tenth", stretch=frames("frame"))


@query(_merge_sql("bbl", "file_name, brand, location", "frame", "screen_time", "size_pct", _TENTH))
def q_consecutive_merge_simple(spark, folder):
    t = table(spark, folder, "bbl")
    return sequences.merge_consecutive(t, ["file_name", "brand", "location"], "frame", "total_hits", ["screen_time"], ["size_pct"], "row_id", average="tenth", stretch=frames("frame"))


@query(
    f"""
WITH x AS (SELECT *, {_NO} FROM exposures),
y AS (SELECT file_name, frame_no, row_id, 1 - least(abs(screen_size_pct - lead(screen_size_pct) OVER ({_ORD})) / 15, 1) AS score FROM x WHERE frame_no IS NOT NULL),
z AS (SELECT *, CASE WHEN lag(score) OVER ({_ORD}) >= 0.98 THEN 0 ELSE 1 END AS new FROM y),
r AS (SELECT *, sum(new) OVER ({_ORD} ROWS UNBOUNDED PRECEDING) AS run FROM z)
SELECT file_name, first_value AS first_image, n AS n_images FROM (SELECT file_name, run, arg_min(row_id, struct_pack(a := frame_no, b := row_id)) AS first_value, count(*) AS n FROM r GROUP BY file_name, run) WHERE n > 1"""
)
def q_similarity_runs(spark, folder):
    t = numbered(spark, folder, "exposures").filter("frame_no is not null").select("file_name", "frame_no", "row_id", "screen_size_pct")
    order = ["frame_no", "row_id"]
    t = Ordering(["file_name"], order, frames("frame_no")).neighbour(t, {"screen_size_pct": "next_size"}, behind=True, keep=True)
    t = t.withColumn("score", 1 - F.least(F.abs(F.col("screen_size_pct") - F.col("next_size")) / 15, F.lit(1.0)))
    return sequences.similarity_runs(t, ["file_name"], order, "score", "row_id", 0.98, frames("frame_no"))


@query(f"{_X} SELECT row_id, CAST(row_number() OVER (PARTITION BY file_name ORDER BY frame_no NULLS FIRST, row_id) AS BIGINT) AS art_id FROM x")
def q_row_ids(spark, folder):
    t = numbered(spark, folder, "exposures").select("row_id", "file_name", "frame_no")
    return Ordering(["file_name"], ["frame_no", "row_id"], frames("frame_no")).row_number(t, "art_id").select("row_id", "art_id")


@query(f"{_X} SELECT row_id, CAST(row_number() OVER (PARTITION BY file_name, brand ORDER BY frame_no NULLS FIRST, row_id) AS BIGINT) AS hit FROM x")
def q_running_hits(spark, folder):
    t = numbered(spark, folder, "exposures").select("row_id", "file_name", "brand", "frame_no")
    return Ordering(["file_name", "brand"], ["frame_no", "row_id"], frames("frame_no")).row_number(t, "hit").select("row_id", "hit")


@query("SELECT brand, row_number() OVER (ORDER BY r) - 1 AS id FROM (SELECT brand, min(row_id) AS r FROM results_ledger WHERE brand IS NOT NULL GROUP BY brand)")
def q_first_seen_ids(spark, folder):
    return sequences.first_seen_ids(table(spark, folder, "results_ledger"), "brand", "row_id")


@query(
    f"""
WITH e AS (SELECT file_name, arg_max({_NO.replace(' AS frame_no', '')}, row_id) AS last_e FROM exposures WHERE {_NO.replace(' AS frame_no', '')} IS NOT NULL GROUP BY file_name),
b AS (SELECT file_name, arg_max({_NO.replace(' AS frame_no', '')}, row_id) AS last_b FROM batters WHERE {_NO.replace(' AS frame_no', '')} IS NOT NULL GROUP BY file_name)
SELECT b.file_name, last_b, last_e, last_b < last_e AS complete FROM b JOIN e ON b.file_name = 'batters_' || e.file_name"""
)
def q_first_last(spark, folder):
    e = numbered(spark, folder, "exposures").filter("frame_no is not null").groupBy("file_name").agg(F.max_by("frame_no", "row_id").alias("last_e"))
    b = _batters(spark, folder).groupBy("file_name").agg(F.max_by("frame_no", "row_id").alias("last_b"))
    return b.join(e.select(F.concat(F.lit("batters_"), "file_name").alias("file_name"), "last_e"), "file_name").withColumn("complete", F.col("last_b") < F.col("last_e"))


@query(
    """
WITH g AS (SELECT video, list_sort(list(path) FILTER (path LIKE '%copy%')) AS a, list_sort(list(path) FILTER (path NOT LIKE '%copy%')) AS b FROM shard_files GROUP BY video),
h AS (SELECT *, coalesce(len(a), 0) AS na, coalesce(len(b), 0) AS nb FROM g),
i AS (SELECT *, unnest(range(greatest(na, nb))) AS i FROM h WHERE greatest(na, nb) > 1)
SELECT video, CAST(i AS INTEGER) AS i, CASE WHEN na > 0 THEN a[i % na + 1] END AS left_name, CASE WHEN nb > 0 THEN b[i % nb + 1] END AS right_name FROM i"""
)
def q_round_robin(spark, folder):
    return sequences.round_robin(table(spark, folder, "shard_files"), "video", F.contains("path", F.lit("copy")), "path")


@query("SELECT doc_id, count(*) OVER (PARTITION BY md5(text)) > 1 AS is_duplicate FROM documents")
def q_duplicate_split(spark, folder):
    return sequences.duplicate_split(table(spark, folder, "documents").select("doc_id", F.md5("text").alias("h")), "h").select("doc_id", "is_duplicate")


@query("SELECT text_md5, n, first_doc FROM (SELECT md5(text) AS text_md5, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1) WHERE n > 1")
def q_md5_duplicates(spark, folder):
    return table(spark, folder, "documents").filter("text is not null").groupBy(F.md5("text").alias("text_md5")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query(
    f"""
{_X}, r AS (SELECT file_name, min(frame_no) AS a, max(frame_no) AS b FROM x WHERE frame_no IS NOT NULL GROUP BY file_name),
p AS (SELECT *, unnest(range(1, 8)) AS p, (b - a) // 7 AS step, CAST(round_even((b - a) / 7.0, 0) AS BIGINT) AS f FROM r),
q AS (SELECT *, CASE WHEN a + f + 6 * (step + 1) > b THEN 1 ELSE 0 END AS shift FROM p),
s AS (SELECT file_name, p AS person, CASE WHEN p = 1 THEN a ELSE a + f + 1 + (p - 2) * (step + 1) - shift END AS first_frame,
  CASE WHEN p = 7 THEN b WHEN p = 1 THEN least(a + f, b) - shift ELSE least(a + f + (p - 1) * (step + 1), b) - shift END AS last_frame FROM q)
SELECT file_name, CAST(person AS INTEGER) AS person, first_frame, last_frame FROM s WHERE first_frame <= last_frame"""
)
def q_range_split(spark, folder):
    t = numbered(spark, folder, "exposures").filter("frame_no is not null").groupBy("file_name").agg(F.min("frame_no").alias("a"), F.max("frame_no").alias("b"), F.lit(7).alias("people"))
    return reshape.split_range(t, "a", "b", "people").select("file_name", "person", "first_frame", "last_frame")


@query(
    """
SELECT shard_id, CAST(least((rn - 1) // greatest(n // 4, 1), 3) AS INTEGER) AS part
FROM (SELECT shard_id, row_number() OVER (PARTITION BY video ORDER BY path, shard_id) AS rn, count(*) OVER (PARTITION BY video) AS n FROM shard_files)"""
)
def q_chunk_last(spark, folder):
    return reshape.chunks(table(spark, folder, "shard_files").select("shard_id", "video", "path"), ["video"], ["path", "shard_id"], 4).select("shard_id", "part")


@query("SELECT shard_id, CAST(ntile(4) OVER (PARTITION BY video ORDER BY path, shard_id) - 1 AS INTEGER) AS part FROM shard_files")
def q_chunk_first(spark, folder):
    return reshape.chunks(table(spark, folder, "shard_files").select("shard_id", "video", "path"), ["video"], ["path", "shard_id"], 4, "first").select("shard_id", "part")


@query(
    """
WITH RECURSIVE n AS (SELECT shard_id, video, n_bytes, row_number() OVER (PARTITION BY video ORDER BY modified_at, shard_id) AS i FROM shard_files),
r AS (SELECT shard_id, video, i, coalesce(n_bytes, 0) AS held, 0 AS part FROM n WHERE i = 1
  UNION ALL SELECT n.shard_id, n.video, n.i, CASE WHEN r.held > 0 AND r.held + coalesce(n.n_bytes, 0) > 20000 THEN coalesce(n.n_bytes, 0) ELSE r.held + coalesce(n.n_bytes, 0) END,
    CASE WHEN r.held > 0 AND r.held + coalesce(n.n_bytes, 0) > 20000 THEN r.part + 1 ELSE r.part END FROM r JOIN n ON n.video IS NOT DISTINCT FROM r.video AND n.i = r.i + 1)
SELECT shard_id, CAST(part AS INTEGER) AS part FROM r"""
)
def q_fill_bins(spark, folder):
    t = table(spark, folder, "shard_files").select("shard_id", "video", "modified_at", "n_bytes")
    return reshape.fill_bins(t, ["video"], ["modified_at", "shard_id"], "n_bytes", 20_000).select("shard_id", "part")


@query("SELECT row_id, CASE WHEN row_number() OVER (ORDER BY md5(row_id || '#42'), row_id) <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'val' END AS side FROM bbl")
def q_train_split(spark, folder):
    return reshape.take_exact(table(spark, folder, "bbl").select("row_id"), "row_id", 0.8)


@query(
    f"""{_B}, c AS (SELECT file_name, frame_no, location, count(*) AS n, min(row_id) AS r FROM x WHERE frame_no IS NOT NULL AND location IS NOT NULL GROUP BY ALL),
v AS (SELECT file_name, frame_no, arg_max(location, struct_pack(n := n, r := -r)) AS best, count(*) AS kinds FROM c GROUP BY file_name, frame_no)
SELECT row_id, CASE WHEN kinds > 1 THEN best ELSE location END AS location FROM x LEFT JOIN v ON x.file_name = v.file_name AND x.frame_no = v.frame_no WHERE x.frame_no IS NOT NULL"""
)
def q_majority_vote(spark, folder):
    t = _batters(spark, folder).select("row_id", "file_name", "frame_no", "location")
    return sequences.majority_vote(t, ["file_name", "frame_no"], "location", "row_id").select("row_id", "location")


@query(f"{_X} SELECT row_id, CASE WHEN count(*) OVER (PARTITION BY file_name, frame_no) = 1 THEN 1 ELSE 0 END AS solus FROM x WHERE frame_no IS NOT NULL")
def q_solus(spark, folder):
    t = numbered(spark, folder, "exposures").filter("frame_no is not null").select("row_id", "file_name", "frame_no")
    one = t.groupBy("file_name", "frame_no").agg(F.count(F.lit(1)).alias("n"))
    return t.join(one, ["file_name", "frame_no"]).select("row_id", F.when(F.col("n") == 1, 1).otherwise(0).alias("solus"))


@query(
    r"""
WITH t AS (SELECT shard_id, lower(path) AS p, video FROM shard_files),
k AS (SELECT shard_id, video, list_transform(regexp_extract_all(p, '([0-9]+|[^0-9]+)', 1), lambda x: CASE WHEN regexp_matches(x, '^[0-9]') THEN lpad(x, CAST(greatest(20, length(x)) AS INTEGER), '0') ELSE x END) AS k FROM t)
SELECT shard_id, CAST(row_number() OVER (PARTITION BY video ORDER BY k, shard_id) AS INTEGER) AS place FROM k"""
)
def q_natural_sort(spark, folder):
    t = table(spark, folder, "shard_files").select("shard_id", "video", natural_key(F.col("path")).alias("k"))
    return rank_in_group(t, ["video"], ["k", "shard_id"], "place").select("shard_id", F.col("place").cast("int").alias("place"))


# -- scalar families -------------------------------------------------------------------------------------------------


@query(
    r"""
SELECT row_id, regexp_replace(location, '^\s+|\s+$', '', 'g') AS stripped, regexp_replace(location, '[^\x20-\x7E]', ' ', 'g') AS ascii_only,
  regexp_replace(location, '[^A-z0-9 ]', '', 'g') AS letters, trim(regexp_replace(replace(replace(location, '  ', ''), '_', ''), '[0-9]+', '', 'g')) AS no_digits, ltrim(frame, '0') AS short_frame FROM exposures"""
)
def q_text_clean(spark, folder):
    c = F.col("location")
    return table(spark, folder, "exposures").select(
        "row_id",
        F.regexp_replace(c, "^\\s+|\\s+$", "").alias("stripped"),
        F.regexp_replace(c, "[^\\x20-\\x7E]", " ").alias("ascii_only"),
        F.regexp_replace(c, "[^A-z0-9 ]", "").alias("letters"),
        F.trim(F.regexp_replace(F.replace(F.replace(c, F.lit("  "), F.lit("")), F.lit("_"), F.lit("")), "[0-9]+", "")).alias("no_digits"),
        F.ltrim(F.col("frame"), F.lit("0")).alias("short_frame"),
    )


@query(
    r"""
SELECT DISTINCT file_name, split_part(file_name, '_', 1) AS first_part, TRY_CAST(regexp_extract(file_name, '([0-9]+)', 1) AS BIGINT) AS number, regexp_replace(file_name, '_([0-9]+)$', '-\1') AS dashed,
  trim(regexp_replace(regexp_replace(file_name, '_', ' ', 'g'), '([A-Z])', ' \1', 'g')) AS words, file_name || '_final.xlsx' AS target FROM exposures"""
)
def q_name_parse(spark, folder):
    f = F.col("file_name")
    return table(spark, folder, "exposures").select("file_name").distinct().select(
        f,
        F.split_part(f, F.lit("_"), F.lit(1)).alias("first_part"),
        F.regexp_extract(f, "([0-9]+)", 1).try_cast("bigint").alias("number"),
        F.regexp_replace(f, "_([0-9]+)$", "-$1").alias("dashed"),
        F.trim(F.regexp_replace(F.regexp_replace(f, "_", " "), "([A-Z])", " $1")).alias("words"),
        F.concat(f, F.lit("_final.xlsx")).alias("target"),
    )


@query(
    """
WITH x AS (SELECT row_id, screen_time, duration, CAST(split_part(screen_time, ':', 1) AS INTEGER) * 3600 + CAST(split_part(screen_time, ':', 2) AS INTEGER) * 60 + CAST(split_part(screen_time, ':', 3) AS INTEGER) AS s
  FROM bbl WHERE regexp_full_match(screen_time, '[0-9]{1,2}:[0-9]{2}:[0-9]{2}'))
SELECT row_id, CAST(s AS INTEGER) AS seconds, printf('%02d:%02d:%02d', s // 3600, s // 60 % 60, s % 60) AS clock,
  printf('%02d:%02d:%02d', (82800 + 1800 + s) % 86400 // 3600, (82800 + 1800 + s) % 86400 // 60 % 60, (82800 + 1800 + s) % 86400 % 60) AS shown, printf('%d min %d sec', s // 60, s % 60) AS said FROM x"""
)
def q_screen_time(spark, folder):
    t = table(spark, folder, "bbl").select("row_id", times.seconds_of(F.col("screen_time")).alias("seconds")).filter("seconds is not null")
    return t.select("row_id", "seconds", times.clock(F.col("seconds")).alias("clock"), times.screen_time(F.lit("2330"), F.col("seconds")).alias("shown"), times.spoken(F.col("seconds")).alias("said"))


@query(
    """
SELECT row_id, strftime(strptime(air_date, '%d/%m/%Y'), '%Y-%m-%d') AS iso, CASE WHEN CAST(air_date[4:5] AS INTEGER) > 12 THEN air_date[4:5] || '/' || air_date[1:2] ELSE air_date[1:5] END || '/' || air_date[7:10] AS guessed
FROM news_exposures WHERE regexp_full_match(air_date, '[0-9]{2}/[0-9]{2}/[0-9]{4}')"""
)
def q_date_format(spark, folder):
    t = table(spark, folder, "news_exposures").filter(F.col("air_date").rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"))
    return t.select("row_id", F.date_format(times.day(F.col("air_date")), "yyyy-MM-dd").alias("iso"), times.guessed_day(F.regexp_replace("air_date", "/", "")).alias("guessed"))


@query(
    """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey % 640 AS DOUBLE) AS cx, CAST(l_orderkey % 480 AS DOUBLE) AS cy FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN cx < 160 THEN CASE WHEN cy < 240 THEN 'B' ELSE 'E' END
 WHEN cx < 320 THEN CASE WHEN cy < 120 THEN 'B' WHEN cy >= 360 THEN 'E' ELSE 'A' END WHEN cx < 480 THEN CASE WHEN cy < 120 THEN 'C' WHEN cy >= 360 THEN 'D' ELSE 'A' END
 ELSE CASE WHEN cy < 240 THEN 'C' ELSE 'D' END END AS zone FROM x"""
)
def q_zone(spark, folder):
    t = table(spark, folder, "lineitem")
    z = numbers.zone((F.col("l_partkey") % 640).cast("double"), (F.col("l_orderkey") % 480).cast("double"), F.lit(640.0), F.lit(480.0))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", z.alias("zone"))


@query(
    """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey % 500 AS DOUBLE) AS x0, CAST(l_suppkey % 300 AS DOUBLE) AS y0, CAST(l_partkey % 500 AS DOUBLE) + l_quantity AS x1, CAST(l_suppkey % 300 AS DOUBLE) + l_linenumber * 10 AS y1 FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(abs(x1 - x0) * abs(y1 - y0) / (640.0 * 480.0) * 100 * 1000 + 0.5) / 1000.0 AS pct, floor((x0 + x1) / 2 / 640.0 * 1000000 + 0.5) / 1000000.0 AS x_center, floor((y0 + y1) / 2 / 480.0 * 1000000 + 0.5) / 1000000.0 AS y_center,
  floor(abs(x1 - x0) / 640.0 * 1000000 + 0.5) / 1000000.0 AS width, floor(abs(y1 - y0) / 480.0 * 1000000 + 0.5) / 1000000.0 AS height, least(greatest(x1, 0), 520) AS clamped, CAST(least(1920, 730) AS INTEGER) AS shown_w, round(1080.0 * 730 / 1920, 3) AS shown_h FROM x"""
)
def q_box_geometry(spark, folder):
    x0, y0 = (F.col("l_partkey") % 500).cast("double"), (F.col("l_suppkey") % 300).cast("double")
    x1, y1 = x0 + F.col("l_quantity"), y0 + F.col("l_linenumber") * 10
    w, h = F.lit(640.0), F.lit(480.0)
    t = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))
    c = [F.col(n) for n in ("x0", "y0", "x1", "y1")]
    centre = numbers.centre_box(*c, w, h)
    shown = numbers.display_size(F.lit(1920), F.lit(1080.0))
    out = t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.box_percent(*c, w, h).alias("pct"), *centre, numbers.clamped(F.col("x1"), F.lit(520)).alias("clamped"), *shown)
    return out.withColumns({n: numbers.half_up(F.col(n), 6) for n in ("x_center", "y_center", "width", "height")}).withColumn("shown_h", F.round("shown_h", 3))


@query(
    """
WITH g AS (SELECT file_name, list_sort(list(DISTINCT location)) AS a, count(location) AS n FROM bbl WHERE location IS NOT NULL AND file_name IS NOT NULL GROUP BY file_name)
SELECT file_name, array_to_string(list_concat(['Global'], a), '|') AS places, n > len(a) AS repeated FROM g"""
)
def q_array_ops(spark, folder):
    t = table(spark, folder, "bbl").dropna(subset=["file_name", "location"])
    g = t.groupBy("file_name", "location").agg(F.count(F.lit(1)).alias("n")).groupBy("file_name").agg(F.array_sort(F.collect_list("location")).alias("a"), F.sum("n").alias("n"))
    return g.select("file_name", F.array_join(F.array_distinct(F.concat(F.array(F.lit("Global")), "a")), "|").alias("places"), (F.col("n") > F.size("a")).alias("repeated"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{\"event\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}' AS doc FROM events")
def q_json_ops(spark, folder):
    t = table(spark, folder, "events").withColumn("k", F.from_json("props", "k int")["k"])
    return t.select("event_id", "k", F.to_json(F.struct(F.col("event_id").alias("event"), "k")).alias("doc"))


@query("SELECT doc_id, user_name AS url_user FROM documents WHERE user_name IS NOT NULL")
def q_url_user(spark, folder):
    t = table(spark, folder, "documents").filter("user_name is not null").select("doc_id", F.concat(F.lit("https://example.org/"), "user_name", F.lit("/status/"), "doc_id", F.lit("?lang=en")).alias("url"))
    return t.select("doc_id", F.split_part(F.parse_url("url", F.lit("PATH")), F.lit("/"), F.lit(2)).alias("url_user"))


@query(
    """SELECT row_id, CASE WHEN isfinite(avg_total_duration) THEN avg_total_duration ELSE 0.0 END AS value, CAST(floor(CASE WHEN isfinite(avg_total_duration) THEN avg_total_duration ELSE 0 END) AS BIGINT) AS whole
FROM results_ledger"""
)
def q_finite(spark, folder):
    v = numbers.finite_or_zero(F.col("avg_total_duration"))
    return table(spark, folder, "results_ledger").select("row_id", v.alias("value"), F.floor(v).alias("whole"))


@query(r"SELECT row_id, regexp_replace(lower(regexp_replace(brand, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '^(.{0,3}).*$', '\1') AS prefix FROM exposures WHERE regexp_matches(brand, '(?i)^dra')")
def q_type_ahead(spark, folder):
    t = table(spark, folder, "exposures").filter(F.col("brand").rlike("(?i)^dra"))
    return t.select("row_id", F.regexp_replace(F.lower(strip_all(F.col("brand"))), "^(.{0,3}).*$", "$1").alias("prefix"))


@query(_X + " SELECT file_name, arg_min(frame_no, struct_pack(d := abs(frame_no - 1000), r := row_id)) AS closest FROM x WHERE frame_no IS NOT NULL GROUP BY file_name")
def q_closest(spark, folder):
    return columns.closest(numbered(spark, folder, "exposures"), ["file_name"], "frame_no", F.lit(1000), "row_id")


@query("SELECT row_id, file_name, brand FROM results_ledger ORDER BY row_id LIMIT 10 OFFSET 20")
def q_preview(spark, folder):
    return columns.preview(table(spark, folder, "results_ledger").select("row_id", "file_name", "brand"), ["row_id"], 20)


@query(
    r"""SELECT doc_id, CAST(CASE WHEN trim(text) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '[\t\n\x0b\f\r ]+', ' ', 'g')), ' ')) END AS INTEGER) AS words
FROM documents WHERE text IS NOT NULL"""
)
def q_word_count(spark, folder):
    return table(spark, folder, "documents").filter("text is not null").select("doc_id", word_count(F.col("text")).alias("words"))


QUERIES, SQL = query.queries, query.sql
