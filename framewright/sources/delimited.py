"""Delimited text: plain, with an encoding fallback, with a sniffed delimiter, with stray NUL bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewright import schemas
from framewright.operators.badrows import DELIMITERS


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = schemas.EXPOSURE, sep: str = "\t", encoding: str = "UTF-8") -> DataFrame:
    """Rows in the schema's columns by position, the header left out, with the file's name."""
    t = spark.read.csv(path, sep=sep, header=True, schema=schema, encoding=encoding, enforceSchema=True)
    return t.withColumn("source_file", F.col("_metadata.file_name"))


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """As ``read_tsv``, but lines that don't fit the schema are skipped.  ``badrows`` tells which and why."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema, encoding=encoding, mode="DROPMALFORMED")


def read_decoded(spark: SparkSession, path: str, schema: T.StructType = schemas.EXPOSURE, sep: str = "\t") -> DataFrame:
    """Each file is UTF-8 as a whole, or else Latin-1 as a whole.  Quoted fields may not hold line ends."""
    files = spark.read.format("binaryFile").load(path)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    lines = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.posexplode(F.split(text, "\r\n|\n|\r")).alias("line_no", "line"))
    rows = lines.filter((F.col("line_no") > 0) & (F.col("line") != ""))
    parsed = F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {"sep": sep})
    return rows.select("source_file", "line_no", parsed.alias("r")).select("source_file", "line_no", "r.*")


def sniff(spark: SparkSession, path: str) -> str:
    """The delimiter that a file's first line has most of; a comma where it has none."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    best = max(DELIMITERS, key=line.count)
    return best if line.count(best) else ","


def read_sniffed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_tsv(spark, path, schema, sep=sniff(spark, path))


def read_without_nul(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Lines are parsed after NUL characters were taken out of them; a line of the schema's names is a header."""
    lines = spark.read.text(path).select(F.translate("value", "\x00", "").alias("line")).filter("line <> ''")
    header = sep.join(schema.names).lower()
    rows = lines.filter(F.lower(F.col("line")) != header)
    return rows.select(F.from_csv("line", schema.simpleString()[7:-1].replace(":", " "), {"sep": sep}).alias("r")).select("r.*")


def list_files(spark: SparkSession, path: str, suffix: str | None = None, contains: str | None = None, recursive: bool = True) -> DataFrame:
    """Columns path, name, n_bytes, modified_at of the files below a folder, without reading them."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if suffix:
        r = r.option("pathGlobFilter", f"*{suffix}")
    t = r.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified_at"))
    return t.filter(F.contains("name", F.lit(contains))) if contains else t


def total_size(files: DataFrame) -> DataFrame:
    """Bytes and gigabytes (two digits) of listed files."""
    out = files.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))
    return out.withColumn("gigabytes", F.round(F.col("n_bytes") / F.pow(F.lit(1024), F.lit(3)), 2))


def unread(files: DataFrame, ledger: DataFrame, name: str = "name") -> DataFrame:
    """Files whose name isn't in the ledger yet."""
    return files.join(ledger.select(F.col("file_name").alias(name)).distinct(), name, "left_anti")
