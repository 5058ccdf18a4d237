"""Joins, set operations, labels, rules and vectors over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.functions.numbers import pearson
from framewright.operators import fuzzy, joins, ontology, sequences, setops, vectors
from framewright.operators.stretches import frames
from framewright.queries.exposures import _NO, numbered
from framewright.queries.registry import Registry
from framewright.tables import table

query = Registry()

_EB = f"WITH e AS (SELECT *, {_NO} FROM exposures), b AS (SELECT *, {_NO} FROM batters)"


def _frames(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    e = numbered(spark, folder, "exposures").select("row_id", "file_name", "frame_no").filter("frame_no is not null")
    b = numbered(spark, folder, "batters").filter("frame_no is not null").select(F.regexp_replace("file_name", "^batters_", "").alias("file_name"), "frame_no", F.col("location").alias("player"), F.col("brand").alias("club"), F.col("row_id").alias("b_row"))
    return e, b


@query(_EB + " SELECT e.row_id, b.location AS player, b.brand AS club FROM e LEFT JOIN b ON b.file_name = 'batters_' || e.file_name AND b.frame_no = e.frame_no WHERE e.frame_no IS NOT NULL")
def q_frame_enrich(spark, folder):
    e, b = _frames(spark, folder)
    return joins.enrich(e, b.drop("b_row"), ["file_name", "frame_no"]).select("row_id", "player", "club")


@query(
    _EB
    + """, f AS (SELECT file_name, frame_no, arg_min(struct_pack(p := location, c := brand), row_id) AS x FROM b WHERE frame_no IS NOT NULL GROUP BY file_name, frame_no)
SELECT e.row_id, f.x.p AS player, f.x.c AS club FROM e LEFT JOIN f ON f.file_name = 'batters_' || e.file_name AND f.frame_no = e.frame_no WHERE e.frame_no IS NOT NULL"""
)
def q_first_match_lookup(spark, folder):
    e, b = _frames(spark, folder)
    return joins.first_match(e, b, ["file_name", "frame_no"], "b_row").select("row_id", "player", "club")


@query(
    """
WITH a AS (SELECT brand, count(*) AS seen FROM bbl WHERE brand IS NOT NULL GROUP BY brand), b AS (SELECT brand, count(*) AS aired FROM news_exposures WHERE brand IS NOT NULL GROUP BY brand)
SELECT brand, coalesce(seen, 0) AS seen, coalesce(aired, 0) AS aired FROM a FULL JOIN b USING (brand) WHERE brand IS DISTINCT FROM 'Roboudre'"""
)
def q_outer_report(spark, folder):
    count = lambda n, c: table(spark, folder, n).filter("brand is not null").groupBy("brand").agg(F.count(F.lit(1)).alias(c))
    out = joins.outer_report(count("bbl", "seen"), count("news_exposures", "aired"), "brand")
    return out.filter(~F.col("brand").eqNullSafe("Roboudre")).select("brand", F.coalesce("seen", F.lit(0)).cast("bigint").alias("seen"), F.coalesce("aired", F.lit(0)).cast("bigint").alias("aired"))


@query(
    """
WITH a AS (SELECT row_id, file_name, coalesce(TRY_CAST(ltrim(regexp_replace(frame, '[^0-9]', '', 'g'), '0') AS BIGINT), 0) AS k FROM exposures)
SELECT a.row_id, bbl.row_id AS other FROM a JOIN bbl ON a.file_name = bbl.file_name AND a.k = bbl.frame"""
)
def q_derived_key_join(spark, folder):
    a = table(spark, folder, "exposures").select("row_id", "file_name", joins.stripped_number(F.col("frame")).alias("k"))
    b = table(spark, folder, "bbl").select(F.col("row_id").alias("other"), "file_name", F.col("frame").alias("k"))
    return a.join(b, ["file_name", "k"]).select("row_id", "other")


@query(
    f"""
WITH u AS (SELECT 'batters_' || file_name || '#' || frame AS k, sum(total_hits) AS n FROM bbl GROUP BY 1),
b AS (SELECT row_id, file_name || '#' || {_NO.replace(' AS frame_no', '')} AS k, duration, total_hits FROM batters)
SELECT row_id, CAST(duration + coalesce(n, 0) AS BIGINT) AS duration, CAST(total_hits + coalesce(n, 0) AS BIGINT) AS total_hits FROM b LEFT JOIN u ON b.k = u.k"""
)
def q_additive_update(spark, folder):
    rows = numbered(spark, folder, "batters").select("row_id", F.concat("file_name", F.lit("#"), "frame_no").alias("k"), "duration", "total_hits")
    updates = table(spark, folder, "bbl").select(F.concat(F.lit("batters_"), "file_name", F.lit("#"), "frame").alias("k"), "total_hits")
    return joins.add_updates(rows, updates, "k", "total_hits", ["duration", "total_hits"]).select("row_id", "duration", "total_hits")


_HALVES = """
WITH a AS (SELECT brand, location, processed_at, CAST(avg_total_duration AS DECIMAL(18, 3)) AS v FROM results_ledger WHERE isfinite(avg_total_duration)),
o AS (SELECT brand, location, round(CAST(sum(v) AS DOUBLE) / count(*), 3) AS old_value FROM a WHERE processed_at < TIMESTAMP '2011-02-15' GROUP BY ALL),
n AS (SELECT brand, location, round(CAST(sum(v) AS DOUBLE) / count(*), 3) AS new_value FROM a WHERE processed_at >= TIMESTAMP '2011-02-15' GROUP BY ALL)
"""


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    v = F.col("avg_total_duration")
    t = table(spark, folder, "results_ledger").filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    mean = lambda d: d.groupBy("brand", "location").agg(F.round(F.sum(v.cast("decimal(18,3)")).cast("double") / F.count(F.lit(1)), 3).alias("value"))
    cut = F.lit("2011-02-15 00:00:00").cast("timestamp_ntz")
    return mean(t.filter(F.col("processed_at") < cut)), mean(t.filter(F.col("processed_at") >= cut))


@query(_HALVES + " SELECT brand, location, new_value, old_value, round(abs((new_value - old_value) / old_value) * 100, 3) AS difference FROM n JOIN o USING (brand, location) WHERE abs((new_value - old_value) / old_value) * 100 > 5")
def q_history_diff(spark, folder):
    old, new = _halves(spark, folder)
    return joins.history_diff(new, old, ["brand", "location"], "value", 5.0)


@query("SELECT DISTINCT brand, location FROM bbl b WHERE brand IS NOT NULL AND location IS NOT NULL AND NOT EXISTS (SELECT 1 FROM results_ledger r WHERE r.brand = b.brand AND r.location = b.location)")
def q_new_combos(spark, folder):
    new = table(spark, folder, "bbl").select("brand", "location").dropna().distinct()
    return joins.new_keys(new, table(spark, folder, "results_ledger"), ["brand", "location"])


@query(
    """
WITH a AS (SELECT brand, location, sum(duration) AS d, count(DISTINCT file_name) AS n FROM bbl WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL
 UNION ALL SELECT brand, location, sum(duration), count(DISTINCT file_name) FROM exposures WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY ALL)
SELECT brand, location, CAST(sum(d) AS BIGINT) AS total_duration, CAST(sum(n) AS BIGINT) AS file_count, round(CAST(sum(d) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 3) AS average_duration FROM a GROUP BY ALL"""
)
def q_cumulative_merge(spark, folder):
    def state(name: str) -> DataFrame:
        t = table(spark, folder, name).dropna(subset=["brand", "location"])
        return t.groupBy("brand", "location").agg(F.sum("duration").alias("total_duration"), F.countDistinct("file_name").alias("file_count"))

    return joins.cumulative_merge(state("bbl"), state("exposures"), ["brand", "location"])


@query(
    """
WITH k AS (SELECT video, path, CASE WHEN path LIKE '%copy%' THEN 'copy' WHEN path LIKE '%bak%' THEN 'bak' ELSE 'plain' END AS kind FROM shard_files)
SELECT video, min(path) FILTER (kind = 'plain') AS plain, min(path) FILTER (kind = 'copy') AS copy, min(path) FILTER (kind = 'bak') AS bak FROM k GROUP BY video"""
)
def q_pair_pivot(spark, folder):
    kind = F.when(F.contains("path", F.lit("copy")), "copy").when(F.contains("path", F.lit("bak")), "bak").otherwise("plain")
    return joins.pair_by_kind(table(spark, folder, "shard_files").select("video", "path", kind.alias("kind")), "video", "kind", "path", ["plain", "copy", "bak"])


@query(
    r"""
WITH a AS (SELECT DISTINCT 'brand' AS field, brand AS x FROM exposures WHERE brand IS NOT NULL UNION ALL SELECT DISTINCT 'location', location FROM exposures WHERE location IS NOT NULL),
b AS (SELECT field, x, array_to_string(list_sort(string_split(trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')), ' ') AS s FROM a)
SELECT DISTINCT p.field, least(p.x, q.x) AS first_label, greatest(p.x, q.x) AS second_label FROM b p JOIN b q ON p.field = q.field AND p.x <> q.x AND p.s <> '' AND q.s <> '' AND length(p.s) <= length(q.s) AND contains(q.s, p.s)"""
)
def q_misspellings(spark, folder):
    t = table(spark, folder, "exposures")
    parts = [fuzzy.contained_pairs(t, c).select(F.lit(c).alias("field"), "first_label", "second_label") for c in ("brand", "location")]
    return parts[0].unionByName(parts[1])


@query()
def q_fuzzy_top2(spark, folder):
    t = table(spark, folder, "exposures")
    parts = [fuzzy.likely_misspellings(t, c, apart).withColumn("field", F.lit(c)) for c, apart in (("brand", 10.0), ("location", 5.0))]
    return parts[0].unionByName(parts[1])


@query(
    f"""
WITH b AS (SELECT DISTINCT file_name, {_NO} FROM batters)
SELECT p.file_name, p.frame_no AS pos_a, q.frame_no AS pos_b FROM b p JOIN b q ON p.file_name = q.file_name AND abs(p.frame_no - q.frame_no) BETWEEN 1 AND 3"""
)
def q_band_join(spark, folder):
    t = numbered(spark, folder, "batters").select("file_name", "frame_no").dropna().distinct()
    return joins.within_band(t, ["file_name"], "frame_no", 3).select("file_name", "pos_a", "pos_b")


@query(f"SELECT * FROM (SELECT row_id, lead(row_id) OVER (PARTITION BY file_name ORDER BY {_NO.replace(' AS frame_no', '')} NULLS FIRST, row_id) AS next_value FROM batters) WHERE next_value IS NOT NULL")
def q_next_pair(spark, folder):
    t = numbered(spark, folder, "batters").select("row_id", "file_name", "frame_no")
    return joins.next_pairs(t, ["file_name"], ["frame_no", "row_id"], "row_id", frames("frame_no")).select("row_id", "next_value")


@query(
    """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS d FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, vec_id, round(d, 6) AS distance, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS r FROM d) WHERE r <= 10"""
)
def q_knn(spark, folder):
    t = table(spark, folder, "embeddings")
    return vectors.nearest(t, t.filter("vec_id % 20 = 0"), "vec_id", 10).withColumn("distance", F.round("distance", 6))


@query(
    """
WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT p.label, p.vec_id, round(sum(list_cosine_similarity(p.e, q.e)), 4) AS centrality FROM v p JOIN v q ON p.label = q.label GROUP BY p.label, p.vec_id"""
)
def q_cosine_rank(spark, folder):
    t = vectors.centrality(table(spark, folder, "embeddings").select("label", "vec_id", "embedding"), "label")
    return t.select("label", "vec_id", F.round("centrality", 4).alias("centrality"))


@query()
def q_kmeans_rank(spark, folder):
    t = vectors.kmeans(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    out = vectors.centrality(t.select("cluster", "vec_id", "embedding"), "cluster")
    return out.withColumn("place", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("centrality"), "vec_id")))


@query(
    """
WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL),
p AS (SELECT a.label, a.vec_id AS first_id, b.vec_id AS second_id, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id)
SELECT label, first_id, second_id, round(s, 6) AS similarity FROM p WHERE s > 0.2"""
)
def q_cluster_pairs(spark, folder):
    # The vectors of the test tables are far apart: 0.2 is passed by some pairs in a hundred, and by no pair at 0.97.
    return vectors.alike_in_clusters(table(spark, folder, "embeddings"), "label", "vec_id", 0.2).withColumn("similarity", F.round("similarity", 6))


@query(
    """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT q.label, q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS d FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) <= 10),
n AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, query_id, vec_id) AS i FROM k),
r AS (SELECT label, i, query_id, vec_id, true AS taken, [vec_id] AS claimed FROM n WHERE i = 1
  UNION ALL SELECT n.label, n.i, n.query_id, n.vec_id, NOT list_contains(claimed, n.query_id) AND NOT list_contains(claimed, n.vec_id),
    CASE WHEN NOT list_contains(claimed, n.query_id) AND NOT list_contains(claimed, n.vec_id) THEN list_append(claimed, n.vec_id) ELSE claimed END FROM r JOIN n ON n.label = r.label AND n.i = r.i + 1)
SELECT label, query_id, vec_id FROM r WHERE taken"""
)
def q_greedy_groups(spark, folder):
    t = table(spark, folder, "embeddings")
    near = vectors.nearest(t, t.filter("vec_id % 20 = 0"), "vec_id", 10).join(t.select(F.col("vec_id").alias("query_id"), "label"), "query_id")
    return sequences.greedy_groups(near, ["label"], "query_id", "vec_id", ["distance", "query_id", "vec_id"])


@query(
    """
WITH v AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, lead(e) OVER (PARTITION BY label ORDER BY vec_id) AS f FROM v),
u AS (SELECT vec_id, unnest(e) AS a, unnest(f) AS b FROM n WHERE f IS NOT NULL)
SELECT vec_id, round(corr(a, b), 6) AS r FROM u GROUP BY vec_id"""
)
def q_histogram_corr(spark, folder):
    t = table(spark, folder, "embeddings").withColumn("f", F.lead("embedding").over(Window.partitionBy("label").orderBy("vec_id"))).filter("f is not null")
    return t.select("vec_id", F.round(pearson(F.col("embedding"), F.col("f")), 6).alias("r"))


@query("SELECT row_id FROM bbl WHERE file_name IN (SELECT file_name FROM exposures)")
def q_semi_ids(spark, folder):
    return joins.semi(table(spark, folder, "bbl"), table(spark, folder, "exposures"), "file_name").select("row_id")


@query("SELECT DISTINCT file_name FROM exposures WHERE file_name NOT IN (SELECT file_name FROM results_ledger WHERE file_name IS NOT NULL)")
def q_processed_skip(spark, folder):
    return joins.new_keys(table(spark, folder, "exposures").select("file_name").distinct(), table(spark, folder, "results_ledger"), ["file_name"])


_PAIRS = [("Roboudre", "Tunnel Headgear"), ("Gupripeil", "Finish Gantry Carpet"), ("Graskyhu", "Warmup Hoarding")]


@query(
    "SELECT file_name || '/' || frame AS image, count(*) AS boxes FROM bbl WHERE file_name IS NOT NULL AND frame IS NOT NULL AND (" + " OR ".join(f"(brand = '{b}' AND location = '{x}')" for b, x in _PAIRS) + ") GROUP BY 1"
)
def q_nested_filter(spark, folder):
    from framewright.operators.reshape import nest_boxes

    t = table(spark, folder, "bbl").dropna(subset=["file_name", "frame"]).select(F.concat("file_name", F.lit("/"), "frame").alias("image"), "brand", F.col("location").alias("tpoint"), "row_id")
    nested = nest_boxes(t, "image", ["brand", "tpoint"], ["row_id"])
    return joins.keep_boxes(nested, _PAIRS).select("image", F.size("annotations").cast("bigint").alias("boxes"))


@query(
    """
SELECT f.file_name, n.name AS brand FROM (SELECT DISTINCT file_name FROM exposures WHERE file_name IS NOT NULL) f
CROSS JOIN (SELECT DISTINCT name FROM reference_names WHERE kind = 'brand') n WHERE NOT EXISTS (SELECT 1 FROM exposures e WHERE e.file_name = f.file_name AND e.brand = n.name)"""
)
def q_missing_brand_by_file(spark, folder):
    listed = table(spark, folder, "reference_names").filter("kind = 'brand'").select(F.col("name").alias("brand"))
    t = table(spark, folder, "exposures").select("file_name", "brand").filter("file_name is not null")
    return joins.missing_per_file(listed, t, t, "brand", "file_name")


@query("SELECT name AS brand FROM reference_names WHERE kind = 'brand' EXCEPT SELECT brand FROM bbl")
def q_missing_brands(spark, folder):
    listed = table(spark, folder, "reference_names").filter("kind = 'brand'").select(F.col("name").alias("brand")).distinct()
    return joins.new_keys(listed, table(spark, folder, "bbl"), ["brand"])


@query(
    """
WITH h AS (SELECT shard_id, path, md5(content) AS h FROM shard_files WHERE content <> ''),
g AS (SELECT h FROM h GROUP BY h HAVING count(*) > 1 AND bool_or(path LIKE '%copy%')) SELECT shard_id, h FROM h WHERE h IN (SELECT h FROM g)"""
)
def q_group_semi(spark, folder):
    t = table(spark, folder, "shard_files").filter("content <> ''").select("shard_id", "path", F.md5("content").alias("h"))
    return joins.group_semi(t, "h", F.contains("path", F.lit("copy"))).select("shard_id", "h")


@query(
    """
WITH a AS (SELECT brand, location, row_id, row_number() OVER (PARTITION BY brand, location ORDER BY processed_at, row_id) AS i FROM results_ledger),
b AS (SELECT brand, location, row_id AS other, row_number() OVER (PARTITION BY brand, location ORDER BY as_of, row_id) AS i FROM accumulated_averages)
SELECT row_id, other FROM a JOIN b USING (brand, location, i)"""
)
def q_zip_join(spark, folder):
    a = table(spark, folder, "results_ledger").select("brand", "location", "row_id", "processed_at")
    b = table(spark, folder, "accumulated_averages").select("brand", "location", F.col("row_id").alias("other"), "as_of")
    return joins.zip_rows(a, b, ["brand", "location"], ["processed_at", "row_id"], ["as_of", "other"]).select("row_id", "other")


@query(
    """
SELECT e.file_name, b.file_name AS other FROM (SELECT DISTINCT file_name FROM exposures) e JOIN (SELECT DISTINCT file_name FROM batters) b ON contains(b.file_name, e.file_name)"""
)
def q_contains_join(spark, folder):
    e = table(spark, folder, "exposures").select("file_name")
    b = table(spark, folder, "batters").select(F.col("file_name").alias("other"))
    return joins.contained_in(e, b, "file_name", "other")


@query(
    """
WITH c AS (SELECT brand, list_sort(list(DISTINCT location)) AS tpoints FROM results_ledger WHERE brand IS NOT NULL AND location IS NOT NULL GROUP BY brand)
SELECT t AS tpoint, ref_id, brand FROM (SELECT brand, unnest(tpoints) AS t FROM c) JOIN reference_names r ON r.kind = 'location' AND r.name = t"""
)
def q_explode_lookup(spark, folder):
    once = table(spark, folder, "results_ledger").select("brand", "location").dropna().distinct()
    conns = once.groupBy("brand").agg(F.array_sort(F.collect_list("location")).alias("tpoints"))
    ids = table(spark, folder, "reference_names").filter("kind = 'location'").select(F.col("name").alias("tpoint"), "ref_id")
    return conns.select("brand", F.explode("tpoints").alias("tpoint")).join(ids, "tpoint").select("tpoint", "ref_id", "brand")


@query(
    """
SELECT source, count(*) AS n, count(place) AS places, count(screen_location) AS zones FROM (
 SELECT 'bbl' AS source, place, NULL AS screen_location FROM bbl UNION ALL SELECT 'exposures', NULL, screen_location FROM exposures UNION ALL SELECT 'batters', NULL, screen_location FROM batters) GROUP BY source"""
)
def q_union_sources(spark, folder):
    parts = [table(spark, folder, n).withColumn("source", F.lit(n)) for n in ("bbl", "exposures", "batters")]
    parts = [p.select("source", *[c for c in ("place", "screen_location") if c in p.columns]) for p in parts]
    out = setops.union_by_name(*parts)
    return out.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("place").alias("places"), F.count("screen_location").alias("zones"))


@query(
    """
WITH a AS (SELECT file_name, brand, location, duration, 1 AS a, 0 AS b FROM bbl UNION ALL SELECT file_name, brand, location, duration, 0, 1 FROM exposures)
SELECT file_name, brand, location, duration FROM a GROUP BY ALL HAVING sum(a) = 1 AND sum(b) = 0"""
)
def q_exactly_once_diff(spark, folder):
    cols = ["file_name", "brand", "location", "duration"]
    return setops.only_once_in(table(spark, folder, "bbl").select(*cols), table(spark, folder, "exposures").select(*cols))


_DIFF = """
WITH k AS (SELECT regexp_extract(path, '^(.*part-[0-9]+)', 1) AS k, path, content FROM shard_files WHERE content <> ''),
a AS (SELECT k, min(content) AS t FROM k WHERE path LIKE '%copy%' GROUP BY k), b AS (SELECT k, min(content) AS t FROM k WHERE path NOT LIKE '%copy%' GROUP BY k),
x AS (SELECT k, string_split(t, chr(10)) AS l FROM a WHERE k IN (SELECT k FROM b)), y AS (SELECT k, string_split(t, chr(10)) AS l FROM b WHERE k IN (SELECT k FROM a)),
la AS (SELECT k, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM x), lb AS (SELECT k, unnest(l) AS line, unnest(range(len(l))) AS line_no FROM y)
SELECT k, '-' AS side, CAST(line_no AS INTEGER) AS line_no, line FROM la WHERE NOT EXISTS (SELECT 1 FROM lb WHERE lb.k = la.k AND lb.line = la.line)
UNION ALL SELECT k, '+', CAST(line_no AS INTEGER), line FROM lb WHERE NOT EXISTS (SELECT 1 FROM la WHERE lb.k = la.k AND lb.line = la.line)"""


@query(_DIFF)
def q_line_diff(spark, folder):
    t = table(spark, folder, "shard_files").filter("content <> ''").select(F.regexp_extract("path", "^(.*part-[0-9]+)", 1).alias("k"), "content", F.contains("path", F.lit("copy")).alias("c"))
    a = t.filter("c").groupBy("k").agg(F.min("content").alias("t"))
    b = t.filter("not c").groupBy("k").agg(F.min("content").alias("t"))
    return setops.line_diff(a.join(b, "k", "left_semi"), b.join(a, "k", "left_semi"), "k", "t")


@query("SELECT brand FROM bbl WHERE brand IS NOT NULL UNION SELECT brand FROM exposures WHERE brand IS NOT NULL")
def q_union_ids(spark, folder):
    one = lambda n: table(spark, folder, n).select("brand").filter("brand is not null")
    return one("bbl").union(one("exposures")).distinct()


@query(
    """
WITH a AS (SELECT file_name, location, string_agg(DISTINCT brand, '|' ORDER BY brand) AS b FROM bbl WHERE file_name IS NOT NULL AND location IS NOT NULL AND brand IS NOT NULL GROUP BY ALL),
e AS (SELECT file_name, location, string_agg(DISTINCT brand, '|' ORDER BY brand) AS b FROM exposures WHERE file_name IS NOT NULL AND location IS NOT NULL AND brand IS NOT NULL GROUP BY ALL)
SELECT a.file_name, a.location, coalesce(e.b, a.b) AS brands FROM a LEFT JOIN e USING (file_name, location) WHERE a.file_name IN (SELECT file_name FROM e)
UNION ALL SELECT file_name, location, b FROM e WHERE file_name IN (SELECT file_name FROM a) AND NOT EXISTS (SELECT 1 FROM a WHERE a.file_name = e.file_name AND a.location = e.location)"""
)
def q_map_upsert(spark, folder):
    def maps(name: str, col: str) -> DataFrame:
        t = table(spark, folder, name).select("file_name", "location", "brand").dropna().distinct()
        per = t.groupBy("file_name", "location").agg(F.array_sort(F.collect_list("brand")).alias("b"))
        return per.groupBy("file_name").agg(F.map_from_entries(F.collect_list(F.struct("location", "b"))).alias(col))

    both = maps("bbl", "local").join(maps("exposures", "incoming"), "file_name")
    return both.select("file_name", F.explode(setops.merged_map(F.col("local"), F.col("incoming"))).alias("location", "b")).select("file_name", "location", F.array_join("b", "|").alias("brands"))


RULES_TEXT = "Spartans\n\tTunnel side <= tunnel headgear|tunnel backcloth\n\tGantry <= finish^gantry\n\tDugout <= dugout\n\t$$$ game <= segundos|seconds|frames|sekunden\n\t*** noise <= press^office\nHosts\n\tWarm up <= warmup hoarding|warmup backcloth|warmup\n\t$$$ game <= replay|camera|cámara"
_RULES = ontology.parse_rules(RULES_TEXT)


def _mentions_sql() -> str:
    """One step a keyword, longest first: does it and a secondary phrase stand in what is left, and what is left then."""
    ready = ontology.Mentions(_RULES)
    post = "lower(coalesce(text, ''))"
    for r in ready.unwanted:
        post = f"replace({post}, '{r.alternative}', '')"
    steps = [f"s0 AS MATERIALIZED (SELECT doc_id, {post} AS p, lower(coalesce(user_name, '')) AS n FROM documents)"]
    for k, r in enumerate(ready.plain, 1):
        second = " OR ".join(f"contains(p, '{x}') OR contains(replace(n, '_', ''), '{x}')" for x in ready.second.get(r.team, [])) or "false"
        hit = f"(contains(p, '{r.alternative}') OR contains(n, '{r.alternative}')) AND ({second})"
        left = "".join(f", CASE WHEN {hit} THEN replace({c}, '{r.alternative}', '') ELSE {c} END AS {c}" for c in "pn")
        steps.append(f"s{k} AS MATERIALIZED (SELECT * EXCLUDE (p, n){left}, {hit} AS h{k} FROM s{k - 1})")
    every = " UNION ALL ".join(f"SELECT doc_id, {k} AS k, '{r.team}' AS team, '{r.official}' AS official, '{r.alternative}' AS keyword FROM s{len(ready.plain)} WHERE h{k}" for k, r in enumerate(ready.plain, 1))
    return f"WITH {', '.join(steps)}, a AS ({every}) SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) AS INTEGER) AS text_id, team, official, keyword FROM a"


@query(_mentions_sql())
def q_ontology_mentions(spark, folder):
    return ontology.find_mentions(table(spark, folder, "documents"), _RULES, "doc_id", "text", "user_name")


@query(
    "SELECT DISTINCT doc_id, official FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{r.official}' AS official FROM documents WHERE contains(lower(text), '{r.alternative}')" for r in _RULES if r.kind == "keyword")
    + ")"
)
def q_ontology_contains(spark, folder):
    return ontology.contains_rules(table(spark, folder, "documents"), _RULES, "doc_id", "text")


@query("SELECT row_id, CASE WHEN contains(lower(location), 'overlay') THEN 'Graphic' WHEN contains(lower(location), 'backcloth') THEN 'Cloth' ELSE location END AS label FROM bbl")
def q_ontology_relabel(spark, folder):
    rules = [("backcloth", "Cloth"), ("overlay", "Graphic")]
    return table(spark, folder, "bbl").select("row_id", ontology.relabel(F.col("location"), rules).alias("label"))


QUERIES, SQL = query.queries, query.sql
