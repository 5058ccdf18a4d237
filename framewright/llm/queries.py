"""The queries of this package over the test tables: p1, p2 and p7 to p10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.text import last_number
from framewright.llm import canonical, encoding, leakage, runs, spans, tokenize
from framewright.tables import table


def _at_bats(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "batters").withColumn("frame_no", last_number(F.col("frame")))
    return runs.collapse_runs(t, "file_name", "frame_no", "duration", "row_id", ["brand", "location"])


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return _at_bats(spark, folder).filter("n >= 2").select("file_name", F.col("first").alias("first_frame"), F.col("last").alias("last_frame"))


def p1_events(spark: SparkSession, folder: str) -> DataFrame:
    return _at_bats(spark, folder).select("file_name", "brand", "location", F.col("first").alias("first_frame"), F.col("last").alias("last_frame"), F.col("n").alias("n_rows"), F.col("total").alias("duration"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    typed = table(spark, folder, "bbl")
    return canonical.map_fields(typed, "row_id", ["brand", "location"], table(spark, folder, "reference_names")).select("row_id", "field", "ref_id")


def p7_restored(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.damaged_fields(table(spark, folder, "news_exposures"), "row_id", "channel", ["brand", "location"])


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_restored(spark, folder).select("row_id", "field")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, folder, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"), "doc_id", "item_id")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_pairs(table(spark, folder, "documents"), "doc_id", "text")


def p10_shared(spark: SparkSession, folder: str) -> DataFrame:
    return spans.shared_chars(table(spark, folder, "documents"), "doc_id", "text")


QUERIES = {"p1_found": p1_found, "p1_events": p1_events, "p2_found": p2_found, "p7_found": p7_found, "p7_restored": p7_restored, "p8_ids": p8_ids, "p9_found": p9_found, "p10_found": p10_found, "p10_shared": p10_shared}

_P10 = """
WITH d AS (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS i FROM documents WHERE length(text) >= 300),
w AS (SELECT DISTINCT doc_id, md5(substring(text, i, 300)) AS h FROM d)
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM w a JOIN w b ON a.h = b.h AND a.doc_id < b.doc_id"""

_P10_SHARED = """
WITH t AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n FROM documents WHERE length(text) >= 300),
c AS (SELECT md5(text) AS m, min(doc_id) AS class_id, count(*) AS copies FROM t GROUP BY 1),
d AS (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS i FROM t), w AS (SELECT doc_id, i, md5(substring(text, i, 300)) AS h FROM d),
s AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1),
p AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM w WHERE h IN (SELECT h FROM s)),
k AS (SELECT doc_id, CAST(sum(least(300, coalesce(j - i, 300))) AS BIGINT) AS shared FROM p GROUP BY doc_id)
SELECT t.doc_id, class_id, copies, CASE WHEN copies > 1 THEN n ELSE shared END AS shared_chars FROM t JOIN c ON md5(t.text) = c.m LEFT JOIN k ON k.doc_id = t.doc_id WHERE copies > 1 OR shared IS NOT NULL"""

#: NFKC isn't in SQL: what the texts hold of ligatures, wide and raised characters is spelt out.  Fixed values.
_FOLDED = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl", "ß": "ss", "²": "2", "³": "3", "¹": "1", "½": "1/2", "™": "tm", "№": "no", "…": "...", "ª": "a", "º": "o", "\u00ad": "\u00ad"}
_WIDE = "translate(lower(nfc_normalize(text)), '" + "".join(chr(0xFEE0 + i) for i in range(0x30, 0x7B) if chr(i).isalnum()) + "', '" + "".join(chr(i) for i in range(0x30, 0x7B) if chr(i).isalnum()) + "')"


def _words(source: str) -> str:
    text = _WIDE
    for a, b in _FOLDED.items():
        text = f"replace({text}, '{a}', '{b}')"
    return f"regexp_extract_all({text}, '[\\p{{L}}\\p{{M}}\\p{{N}}]+') AS w FROM {source} WHERE text IS NOT NULL"


_P9 = f"""
WITH d AS (SELECT doc_id, {_words("documents")}), i AS (SELECT item_id, {_words("eval_items")}),
a AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: md5(array_to_string(w[k:k + 11], ' ')))) AS h FROM d WHERE len(w) >= 12),
b AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: md5(array_to_string(w[k:k + 11], ' ')))) AS h FROM i WHERE len(w) >= 12)
SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (h)"""

#: As ``labels.plain``; fixed values: letters that don't decompose.
_PLAIN_LETTERS = {"ß": "ss", "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}


def _plain(c: str) -> str:
    text = f"lower({c})"
    for a, b in _PLAIN_LETTERS.items():
        text = f"replace({text}, '{a}', '{b}')"
    return f"regexp_replace(strip_accents({text}), '[^\\p{{L}}\\p{{N}}]', '', 'g')"


# Rare forms mean the most frequent form within a letter of theirs; of slips that may mean two labels this reading takes
# the more frequent one, where the operator looks at the neighbours.
_P1_RUNS = f"""
WITH t AS (SELECT * EXCLUDE (row_id), min(row_id) AS r FROM batters WHERE brand IS NOT NULL AND location IS NOT NULL AND duration >= 1 GROUP BY ALL),
x AS (SELECT file_name AS e, TRY_CAST(regexp_extract(frame, '([0-9]+)[^0-9]*$', 1) AS BIGINT) AS p, duration AS d, r, brand, location, {_plain("brand")} AS b, {_plain("location")} AS l FROM t),
y AS (SELECT * FROM x WHERE p IS NOT NULL AND e IS NOT NULL),
f AS (SELECT e, 'b' AS k, b AS form, count(*) AS n FROM y GROUP BY ALL UNION ALL SELECT e, 'l', l, count(*) FROM y GROUP BY ALL),
g0 AS (SELECT *, regexp_replace(form, '[^0-9]', '', 'g') AS s FROM f),
near AS (SELECT a.e, a.k, a.form, count(*) AS deg FROM g0 a JOIN g0 q ON a.e = q.e AND a.k = q.k AND a.s = q.s AND a.form <> q.form AND abs(length(a.form) - length(q.form)) <= 1 AND levenshtein(a.form, q.form) = 1 GROUP BY ALL),
g AS (SELECT g0.*, coalesce(deg, 0) AS deg FROM g0 LEFT JOIN near USING (e, k, form)),
c AS (SELECT a.e, a.k, a.form, arg_min(q.form, struct_pack(n := -q.n, g := -q.deg, f := q.form)) AS means FROM g a JOIN g q
  ON a.e = q.e AND a.k = q.k AND a.s = q.s AND a.form <> q.form AND abs(length(a.form) - length(q.form)) <= 1 AND levenshtein(a.form, q.form) = 1
  AND (q.n > a.n OR (q.n = a.n AND (q.deg > a.deg OR (q.deg = a.deg AND q.form < a.form)))) AND (a.n < 3 OR a.n <= 0.2 * q.n) GROUP BY ALL),
m AS (SELECT g.e, g.k, g.form, coalesce(c2.means, c.means, g.form) AS means FROM g LEFT JOIN c ON c.e = g.e AND c.k = g.k AND c.form = g.form LEFT JOIN c c2 ON c2.e = g.e AND c2.k = g.k AND c2.form = c.means),
z AS (SELECT y.*, mb.means AS mb, ml.means AS ml FROM y JOIN m mb ON mb.e = y.e AND mb.k = 'b' AND mb.form = y.b JOIN m ml ON ml.e = y.e AND ml.k = 'l' AND ml.form = y.l),
o AS (SELECT *, CASE WHEN mb = lag(mb) OVER w AND ml = lag(ml) OVER w THEN 0 ELSE 1 END AS new FROM z WINDOW w AS (PARTITION BY e ORDER BY p, r)),
h AS (SELECT *, sum(new) OVER (PARTITION BY e ORDER BY p, r ROWS UNBOUNDED PRECEDING) AS block FROM o),
i AS (SELECT *, CASE WHEN p <= max(p + d - 1) OVER (PARTITION BY e, block ORDER BY p, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS apart FROM h),
j AS (SELECT *, sum(apart) OVER (PARTITION BY e, block ORDER BY p, r ROWS UNBOUNDED PRECEDING) AS run FROM i)"""
_P1 = _P1_RUNS + " SELECT e AS file_name, min(p) AS first_frame, max(p + d - 1) AS last_frame FROM j GROUP BY e, block, run HAVING count(*) >= 2"
_P1_EVENTS = _P1_RUNS + """,
u AS (SELECT e, 'b' AS k, b AS form, brand AS label, count(*) AS n FROM y GROUP BY ALL UNION ALL SELECT e, 'l', l, location, count(*) FROM y GROUP BY ALL),
v AS (SELECT e, k, form, arg_min(label, struct_pack(n := -n, l := label)) AS shown FROM u GROUP BY ALL),
a AS (SELECT e, mb, ml, min(p) AS first_frame, max(p + d - 1) AS last_frame, count(*) AS n_rows, CAST(sum(d) AS BIGINT) AS duration FROM j GROUP BY e, block, run, mb, ml)
SELECT a.e AS file_name, vb.shown AS brand, vl.shown AS location, first_frame, last_frame, n_rows, duration
FROM a JOIN v vb ON vb.e = a.e AND vb.k = 'b' AND vb.form = mb JOIN v vl ON vl.e = a.e AND vl.k = 'l' AND vl.form = ml"""



# SQL's distances count bytes: letters of two bytes become one of one byte that plain forms don't hold.  Fixed values.
_CYRILLIC, _GREEK = "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρσςτυφχψω"
_ONE_BYTE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*+"


def _one_byte(c: str) -> str:
    return f"translate({c}, '{_CYRILLIC}{_GREEK}', '{_ONE_BYTE[: len(_CYRILLIC)]}{_ONE_BYTE[: len(_GREEK)]}')"


def _word_list(c: str) -> str:
    """As ``canonical.words_of``."""
    text = rf"regexp_replace({c}, '(^|[^\p{{L}}\p{{N}}])(\p{{L}})[.](\p{{L}})[.](?:(\p{{L}})[.])?', '\1\2\3\4 ', 'g')"
    text = f"replace(replace(replace(replace({text}, '&', ' and '), '™', ' tm '), '®', ' '), '_', ' ')"
    split = rf"regexp_extract_all({text}, '[\p{{L}}\p{{M}}\p{{N}}'']+')"
    return f"list_filter(list_transform({split}, lambda x: {_one_byte(_plain('x'))}), lambda x: x <> '' AND x <> 'and')"


def _mistypable(n: str) -> str:
    return f"CASE WHEN {n} < 4 THEN 0 WHEN {n} < 6 THEN 1 ELSE 2 END"


_SPELT = r"regexp_replace(strip_accents(lower({})), '[^\p{{L}}\p{{N}}]', '', 'g')"
# Every value against every name: the distances alone, without the similarity that the operator looks at first.
_P2 = rf"""
WITH cells AS (SELECT row_id, 'brand' AS kind, brand AS value FROM bbl UNION ALL SELECT row_id, 'location', location FROM bbl),
c AS (SELECT * FROM cells WHERE regexp_matches(value, '[^\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}]') AND NOT EXISTS (SELECT 1 FROM reference_names r WHERE r.kind = cells.kind AND r.name = cells.value)),
listed AS (SELECT kind, ref_id, unnest(list_concat([name], coalesce(string_split(alt_names, '|'), []))) AS name FROM reference_names),
n AS (SELECT *, {_word_list("name")} AS nw FROM listed), nn AS (SELECT *, array_to_string(nw, '') AS cn, {_one_byte(_SPELT.format("name"))} AS sn FROM n),
w AS (SELECT kind, value, {_word_list("value")} AS fw FROM (SELECT DISTINCT kind, value FROM c)),
s AS (SELECT kind, value, fw[1:len(fw) - k] AS fw, array_to_string(fw[1:len(fw) - k], '') AS compact, array_to_string(list_transform(fw[len(fw) - k + 1:], lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN '#' ELSE x END), ' ') AS tail
  FROM w, range(1, 4) t(k) WHERE k < len(fw)),
t AS (SELECT s.kind, tail FROM s JOIN nn ON s.kind = nn.kind AND s.compact = nn.cn JOIN w ON w.kind = s.kind AND w.value = s.value
  WHERE NOT EXISTS (SELECT 1 FROM nn x WHERE x.kind = s.kind AND x.cn = array_to_string(w.fw, '')) GROUP BY ALL HAVING count(DISTINCT ref_id) >= 3),
f AS (SELECT kind, value, fw, 0 AS extra FROM w WHERE len(fw) > 0 UNION ALL SELECT kind, value, fw, 1 FROM s JOIN t USING (kind, tail)),
g AS (SELECT *, array_to_string(fw, '') AS cf, {_one_byte(_SPELT.format("value"))} AS sf FROM f),
p AS (SELECT g.kind, value, extra, ref_id, fw, nw, cf, cn, sf, sn, {_mistypable("least(length(cf), length(cn))")} AS most, {_mistypable("length(sn)")} AS most_spelt FROM g JOIN nn ON g.kind = nn.kind),
d AS (SELECT *, CASE WHEN abs(length(cf) - length(cn)) <= most THEN least(damerau_levenshtein(cf, cn), CASE WHEN len(fw) > 1 AND len(nw) > 1 THEN
    least(damerau_levenshtein(array_to_string(list_reverse(fw), ''), cn), damerau_levenshtein(array_to_string(list_sort(fw), ''), array_to_string(list_sort(nw), ''))) END) END AS d0 FROM p),
e AS (SELECT *, CASE WHEN d0 <= most THEN d0
    WHEN len(fw) = len(nw) AND len(fw) > 1 AND length(fw[-1]) >= 3 AND length(fw[-1]) < length(nw[-1]) AND starts_with(nw[-1], fw[-1]) AND damerau_levenshtein(array_to_string(fw[:-2], ''), array_to_string(nw[:-2], '')) <= 1
      THEN damerau_levenshtein(array_to_string(fw[:-2], ''), array_to_string(nw[:-2], '')) + 0.5
    WHEN regexp_matches(value, '[^\x00-\x7f]') AND abs(length(sf) - length(sn)) <= most_spelt AND damerau_levenshtein(sf, sn) <= most_spelt THEN damerau_levenshtein(sf, sn) END AS d FROM d),
b AS (SELECT kind, value, arg_min(ref_id, struct_pack(d := d, x := extra, r := ref_id)) AS ref_id FROM e WHERE d IS NOT NULL GROUP BY kind, value)
SELECT row_id, c.kind AS field, CAST(coalesce(b.ref_id, -1) AS BIGINT) AS ref_id FROM c LEFT JOIN b ON b.kind = c.kind AND b.value = c.value"""

SQL = {"p1_found": _P1, "p2_found": _P2, "p1_events": _P1_EVENTS, "p10_found": _P10, "p10_shared": _P10_SHARED, "p9_found": _P9}
