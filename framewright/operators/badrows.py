"""Loading delimited lines strictly, and the lines left over with the reason.

The strict load keeps each line's offset and yields only lines that conform in every field.  The offsets it didn't yield
are what an anti-join leaves of the raw lines, and only that remainder is diagnosed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright import schemas

DELIMITERS = ("\t", ";", ",")
#: What each of the nine fields has to match as a whole, as Java regular expressions.
_VISIBLE = "[\\s\\p{Z}\\p{C}]*+(?s:.+)"
_WHOLE = "0*[1-9][0-9]*"
_NUMBER = "[0-9]+(\\.[0-9]+)?"
FIELD_PATTERNS = {
    "brand": _VISIBLE,
    "location": _VISIBLE,
    "screen_time": "([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]",
    "duration": _WHOLE,
    "screen_location": "[A-E]",
    "screen_size_pct": _NUMBER,
    "total_hits": _WHOLE,
    "average_hits": _NUMBER,
    "frame": "(?s)(.*_)?[0-9]+",
}


def split_quoted(line: str, sep: str) -> list[str] | None:
    """The fields of a line, or None where its quoting is broken."""
    out: list[str] = []
    i, n = 0, len(line)
    while True:
        if i < n and line[i] == '"':
            i += 1
            parts = []
            while True:
                j = line.find('"', i)
                if j < 0:
                    return None
                parts.append(line[i:j])
                if line[j + 1 : j + 2] == '"':
                    parts.append('"')
                    i = j + 2
                    continue
                i = j + 1
                break
            if i < n and line[i] != sep:
                return None
            out.append("".join(parts))
        else:
            j = line.find(sep, i)
            j = n if j < 0 else j
            if '"' in line[i:j]:
                return None
            out.append(line[i:j])
            i = j
        if i >= n:
            return out
        i += 1


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split_quoted(line: pd.Series, sep: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else split_quoted(x, s) for x, s in zip(line, sep, strict=True)], dtype=object)


def delimiters(lines: DataFrame, file: str, line_no: str, raw: str) -> DataFrame:
    """One row per file with its delimiter: the one its header has most of; without header, that of all its lines."""
    n = [F.length(raw) - F.length(F.translate(F.col(raw), d, "")) for d in DELIMITERS]
    head = F.col(line_no) == 1
    agg = [F.sum(F.when(head, c)).alias(f"h{i}") for i, c in enumerate(n)] + [F.sum(c).alias(f"a{i}") for i, c in enumerate(n)]
    per = lines.groupBy(file).agg(*agg)

    def most(p: str) -> Column:
        a, b, c = (F.coalesce(f"{p}{i}", F.lit(0)) for i in range(3))
        return F.when(F.greatest(a, b, c) == 0, None).when((a >= b) & (a >= c), DELIMITERS[0]).when(b >= c, DELIMITERS[1]).otherwise(DELIMITERS[2])

    return per.select(F.col(file).alias("_file"), F.coalesce(most("h"), most("a"), F.lit(DELIMITERS[0])).alias("_sep"))


def _fields(lines: DataFrame, raw: str) -> DataFrame:
    """With ``_f``, the fields, null where the quoting is broken.

    Lines without a quote are split in the JVM; of them only a null goes through the Arrow batches of the others.  The
    fields come out of a generator, so that what is tested on them doesn't split the line again for each test.
    """
    body = F.regexp_replace(F.coalesce(F.col(raw), F.lit("")), "\r\\z", "")
    out = lines.withColumn("_body", F.explode(F.array(body)))
    quoted = F.contains("_body", F.lit('"'))
    sep = F.when(F.col("_sep") == "\t", F.split("_body", "\t", -1)).when(F.col("_sep") == ";", F.split("_body", ";", -1)).otherwise(F.split("_body", ",", -1))
    out = out.withColumn("_q", _split_quoted(F.when(quoted, F.col("_body")), F.col("_sep")))
    return out.withColumn("_f", F.explode(F.array(F.when(quoted, F.col("_q")).otherwise(sep)))).drop("_q", "_body")


def _values_hold() -> Column:
    ok = F.lit(True)
    for i, (name, p) in enumerate(FIELD_PATTERNS.items()):
        x = F.get("_f", F.lit(i))
        ok = ok & x.rlike(f"\\A(?:{p})\\z")
        if name == "screen_size_pct":
            ok = ok & F.coalesce(x.try_cast("double") <= 100, F.lit(False))
    return F.coalesce(ok, F.lit(False))


def _data_lines(lines: DataFrame, file: str, line_no: str, raw: str) -> DataFrame:
    seps = delimiters(lines, file, line_no, raw)
    body = lines.filter(~F.coalesce(F.col(line_no) == 1, F.lit(False)))
    return body.join(seps, F.col(file).eqNullSafe(F.col("_file")), "left").drop("_file")


def strict_load(lines: DataFrame, offset: str = "line_id", file: str = "file_name", line_no: str = "line_no", raw: str = "raw") -> DataFrame:
    """The conforming lines as the nine exposure columns, with offset and file.

    Header lines (line 1 of a file) are no rows.  Numbers too large for their column come out null in that column.
    """
    got = _fields(_data_lines(lines.select(offset, file, line_no, raw), file, line_no, raw), raw)
    got = got.filter(F.col("_f").isNotNull() & (F.size("_f") == 9) & _values_hold())
    cols = [F.get("_f", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schemas.EXPOSURE.fields)]
    return got.select(F.col(offset), F.col(file), *cols)


def rejected_lines(lines: DataFrame, offset: str = "line_id", file: str = "file_name", line_no: str = "line_no", raw: str = "raw") -> DataFrame:
    """Offset and reason (``quoting``, else ``column_count``, else ``value``) of every line that isn't loaded.

    A null line counts as an empty one: a wrong column count.  A line without offset can't be subtracted and is judged
    by the diagnosis alone.  Files without header take the delimiter their lines have most of.
    """
    slim = lines.select(offset, file, line_no, raw)
    loaded = strict_load(slim, offset, file, line_no, raw).select(F.col(offset).alias("_done"))
    rest = _data_lines(slim, file, line_no, raw).join(loaded, F.col(offset) == F.col("_done"), "left_anti")
    rest = _fields(rest, raw)
    reason = F.when(F.col("_f").isNull(), "quoting").when(F.size("_f") != 9, "column_count").when(~_values_hold(), "value")
    return rest.select(F.col(offset), reason.alias("reason")).filter("reason is not null")
