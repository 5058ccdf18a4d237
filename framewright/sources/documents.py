"""HTML tables, word-processor paragraphs, archives, annotation documents, pictures."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import schemas


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def html_tables(html: str | None) -> list[list[list[str]]]:
    p = _Tables()
    p.feed(html or "")
    return p.tables


def _explode(df: DataFrame, key: str, value: str, parse, shape: str, types: list[pa.DataType]) -> DataFrame:
    """(key, value) to the rows that ``parse`` makes of each value, behind the key."""
    names = [x.split()[0] for x in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, v in enumerate(b.column(1).to_pylist()):
                for r in parse(v):
                    at.append(i)
                    rows.append(r)
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, value).mapInArrow(run, f"`{key}` {kind}, {shape}")


def roster(pages: DataFrame, key: str, html: str, column: str = "Name") -> DataFrame:
    """Columns key, table_no, row_no, name, cells: rows of every HTML table that has the column."""

    def parse(text: str | None) -> Iterator[tuple]:
        for t, rows in enumerate(html_tables(text)):
            if rows and column in rows[0]:
                at = rows[0].index(column)
                for r, cells in enumerate(rows[1:]):
                    yield t, r, cells[at] if at < len(cells) else None, cells

    return _explode(pages, key, html, parse, "table_no int, row_no int, name string, cells array<string>", [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string())])


def paragraphs(data: bytes | None) -> Iterator[tuple[int, str]]:
    """The paragraphs of a docx file."""
    if data:
        w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for i, p in enumerate(ElementTree.fromstring(z.read("word/document.xml")).iter(f"{w}p")):
                yield i, "".join(t.text or "" for t in p.iter(f"{w}t"))


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path)
    return _explode(files, "path", "content", paragraphs, "line_no int, line string", [pa.int32(), pa.string()])


def archive_entries(data: bytes | None) -> Iterator[tuple]:
    """Name, folder, size of each file of a zip archive; a broken archive has one row of nulls."""
    try:
        with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
            for e in z.infolist():
                if not e.is_dir():
                    yield e.filename, e.filename.rpartition("/")[0], e.file_size, True
    except zipfile.BadZipFile:
        yield None, None, None, False


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Columns path, entry, folder, n_bytes, readable.  Only zip archives: others need a program that isn't here."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return _explode(files, "path", "content", archive_entries, "entry string, folder string, n_bytes bigint, readable boolean", [pa.string(), pa.string(), pa.int64(), pa.bool_()])


def read_annotations(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Annotation documents, one nested object a file, or a line."""
    return spark.read.json(path, schema=schemas.ANNOTATIONS, multiLine=not lines)


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Columns image_name, hash (MD5 of the content)."""
    t = spark.read.format("binaryFile").load(path)
    return t.select(F.element_at(F.split("path", "/"), -1).alias("image_name"), F.md5("content").alias("hash"))


def read_pictures(spark: SparkSession, path: str) -> DataFrame:
    """Pictures that can be decoded, as rows of Spark's image source, with their size as ``WxH``."""
    t = spark.read.format("image").option("dropInvalid", True).load(path)
    return t.select("image", F.element_at(F.split("image.origin", "/"), -1).alias("name"), F.concat_ws("x", "image.width", "image.height").alias("size"))
