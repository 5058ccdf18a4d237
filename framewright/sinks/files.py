"""Writing tables, reports and label files; moving files as data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.session import Output


class TableFolder:
    """A workbook's sheets as Parquet tables of one folder.

    A table that is replaced while it is read is written beside itself first and then put in its place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def names(self) -> list[str]:
        fs, at = self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(at(self.path))) if fs.exists(at(self.path)) else []

    def replace(self, name: str, df: DataFrame) -> None:
        fs, at = self._fs()
        fresh, old = f"{self.path}/.{name}-{uuid.uuid4().hex}", f"{self.path}/{name}"
        df.write.parquet(fresh)
        fs.delete(at(old), True)
        if not fs.rename(at(fresh), at(old)):
            raise OSError(f"can't put {name} in place")

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        fs, at = self._fs()
        for n in names:
            fs.delete(at(f"{self.path}/{n}"), True)


def write_tsv(df: DataFrame, path: str, sep: str = "\t", encoding: str = "UTF-8") -> None:
    """Delimited text with a header per file; blanks at the ends of a field stay."""
    df.write.mode("overwrite").csv(path, sep=sep, header=True, encoding=encoding, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_file(spark: SparkSession, path: str, data: bytes) -> None:
    """One file with these bytes."""
    with Output(spark, path) as f:
        f.write(data)


def write_json_documents(df: DataFrame, path: str) -> None:
    """One JSON object a row."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def brand_report(df: DataFrame, brand: str = "brand", location: str = "location") -> DataFrame:
    """One text per brand: ``#brand`` and its sorted touchpoints, one a line."""
    once = df.dropna(subset=[brand, location]).select(brand, location).distinct()
    out = once.groupBy(brand).agg(F.array_sort(F.collect_list(location)).alias("t"))
    return out.select(F.concat(F.lit("#"), F.col(brand), F.lit("\n"), F.array_join("t", "\n")).alias("value"))


def write_text(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").text(path)


def label_lines(df: DataFrame) -> DataFrame:
    """Columns image, value: class, centre and size with six digits, as detectors read them."""
    return df.select("image", F.format_string("%d %.6f %.6f %.6f %.6f", "class_id", "x_center", "y_center", "width", "height").alias("value"))


def write_labels(df: DataFrame, path: str) -> None:
    """One folder per image with its lines."""
    label_lines(df).write.mode("overwrite").partitionBy("image").text(path)


def insert_new(df: DataFrame, url: str, name: str, keys: list[str], properties: dict[str, str] | None = None) -> None:
    """Appends to a database table the rows whose keys it lacks."""
    spark = df.sparkSession
    held = spark.read.jdbc(url, name, properties=properties or {}).select(*keys)
    df.dropDuplicates(keys).join(held, keys, "left_anti").write.jdbc(url, name, mode="append", properties=properties or {})


def move_manifest(files: DataFrame, name: str, folder: str, order: list[str] | None = None) -> DataFrame:
    """Columns src, dst, action: every file into one folder, a number behind names that come again.

    Files of one name are numbered in the order of their paths (or of ``order``).
    """
    from framewright.functions.names import collision_safe

    w = Window.partitionBy(F.col(name)).orderBy(*(order or ["path"]))
    dst = F.concat(F.lit(f"{folder.rstrip('/')}/"), collision_safe(F.col(name), F.row_number().over(w)))
    return files.select(F.col("path").alias("src"), dst.alias("dst"), F.lit("copy").alias("action"))
