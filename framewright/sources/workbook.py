"""Workbooks (xlsx), read and written with the standard library on whatever file system the path names."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from itertools import chain, islice
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType

from framewright.session import Output

_AT_ONCE = 5000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_names(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """The cells of a sheet as text, row by row.  A name that isn't there as written is looked up without case."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        sheets = [(s.get("name"), s.get(f"{_REL}id")) for s in book.iter(f"{_MAIN}sheet")]
        if isinstance(sheet, int):
            rid = sheets[sheet][1]
        else:
            exact = [r for n, r in sheets if n == sheet] or [r for n, r in sheets if n.lower() == sheet.lower()]
            if not exact:
                raise KeyError(f"no sheet {sheet!r}")
            rid = exact[0]
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = rels[rid].lstrip("/")
        target = target if target.startswith("xl/") else f"xl/{target}"
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        with z.open(target) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for c in row.iter(f"{_MAIN}c"):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    v, kind = c.find(f"{_MAIN}v"), c.get("t")
                    if kind == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    elif v is not None:
                        cells[at] = shared[int(v.text)] if kind == "s" else v.text
                yield cells
                row.clear()


def _cells(sheet: str | int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows = enumerate(sheet_rows(data, sheet))
                next(rows, None)
                while some := list(islice(rows, _AT_ONCE)):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array([n for n, _ in some], pa.int64()), pa.array([c for _, c in some], pa.list_(pa.string()))], names=["source_file", "row_no", "cells"])

    return run


def read_sheet(spark: SparkSession, path: str, schema: StructType, sheet: str | int = 0) -> DataFrame:
    """One sheet (by name, or by place) of a workbook, or of each workbook of a folder, its header left out.

    Cells come by position; one that isn't of its column's type is null.  Behind the columns stand source_file and
    row_no.  A workbook is read by one task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "content")
    rows = files.mapInArrow(_cells(sheet), "source_file string, row_no bigint, cells array<string>")

    def cell(i: int, kind: DataType) -> Column:
        c = F.get("cells", F.lit(i))
        return c if isinstance(kind, StringType) else (c.try_cast("double") if isinstance(kind, IntegralType) else c).try_cast(kind)

    return rows.select(*[cell(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)], "source_file", "row_no")


#: Rows of a sheet, its header included, that spreadsheet programs open.
SHEET_ROWS = 1 << 20


def write_workbook(sheets: dict[str, DataFrame], path: str, most_rows: int = SHEET_ROWS) -> list[str]:
    """A workbook for handing over: one sheet per table, each with its header; returns the sheets' names.

    A table of more rows than a sheet may have goes on in further sheets, ``name (2)`` and so on.  Rows come to the
    driver one partition at a time and go straight to the file.
    """

    def cell(v: object) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    names: list[str] = []
    spark = next(iter(sheets.values())).sparkSession
    with Output(spark, path) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for name, df in sheets.items():
            rows, more = df.toLocalIterator(), True
            nth = 0
            while more:
                nth += 1
                names.append(name if nth == 1 else f"{name} ({nth})")
                with z.open(f"xl/worksheets/sheet{len(names)}.xml", "w") as f:
                    f.write(f'{head}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData><row>{"".join(map(cell, df.columns))}</row>'.encode())
                    n = 1
                    for row in islice(rows, most_rows - 1):
                        f.write(f"<row>{''.join(map(cell, row))}</row>".encode())
                        n += 1
                    f.write(b"</sheetData></worksheet>")
                ahead = list(islice(rows, 1)) if n == most_rows else []
                rows, more = chain(ahead, rows), bool(ahead)
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>{listed}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="r{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
    return names
