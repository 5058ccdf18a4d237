"""Line-oriented lists: brands with touchpoints, preferences, pairs, class ids, detection labels.

These files are small texts whose lines mean something in order; each is parsed as one text per file, many files in
parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def brand_list(text: str) -> dict[str, list[str]]:
    """``#brand`` lines, each followed by its touchpoints.

    A brand that comes again starts over; lines before the first brand are dropped; blank lines are touchpoints.
    """
    out: dict[str, list[str]] = {}
    now: list[str] | None = None
    for line in text.splitlines():
        if line.startswith("#"):
            now = out[line[1:].strip()] = []
        elif now is not None:
            now.append(line.strip())
    return out


def listed_brands(text: str) -> set[str]:
    """The first word behind each ``#``."""
    return set(re.findall(r"#(\w+)", text))


@dataclass
class Preferences:
    file_name: str | None = None
    annotator: str | None = None
    touchpoints: dict[str, list[str]] = field(default_factory=dict)


def preferences(text: str) -> Preferences:
    """``-- group``, ``#brand``, touchpoints, ``*global``, ``%comment``, ``//Filename:`` and ``//Annotator:`` lines.

    Keys are ``group__brand``; every brand's touchpoints begin with the global ones and hold each once.  A group line
    without a name ends the reading.
    """
    p = Preferences()
    group, key, general, own = "", None, [], {}
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line.startswith("%"):
            continue
        if line.startswith("//"):
            name, _, value = line[2:].partition(":")
            if name.strip().lower() == "filename":
                p.file_name = value.strip()
            elif name.strip().lower() == "annotator":
                p.annotator = value.strip()
        elif line.startswith("--"):
            group = line.lstrip("-").strip()
            if not group:
                break
        elif line.startswith("#"):
            key = f"{group}__{line[1:].strip()}"
            own.setdefault(key, [])
        elif line.startswith("*"):
            general.append(line[1:].strip())
        elif key is not None:
            own[key].append(line)
    p.touchpoints = {k: list(dict.fromkeys([*general, *v])) for k, v in own.items()}
    return p


def renamed(touchpoints: dict[str, list[str]], key: str, old: str, new: str | None) -> dict[str, list[str]]:
    """A copy in which a brand's touchpoint is renamed, or deleted where ``new`` is None."""
    out = {k: list(v) for k, v in touchpoints.items()}
    out[key] = [new if t == old else t for t in out.get(key, []) if not (t == old and new is None)]
    return out


def pairs(text: str) -> list[tuple[str, str]]:
    """``brand-touchpoint`` per line with exactly one dash; any other line is an error."""
    out = []
    for n, line in enumerate(text.splitlines(), 1):
        if line.strip():
            parts = line.strip().split("-")
            if len(parts) != 2:
                raise ValueError(f"line {n}: not one dash: {line!r}")
            out.append((parts[0].strip(), parts[1].strip()))
    return out


def class_ids(text: str) -> dict[str, int]:
    """``0: label`` per line."""
    return {name.strip(): int(n) for n, _, name in (line.partition(": ") for line in text.splitlines() if ": " in line)}


def detections(text: str) -> list[tuple[float, ...]]:
    """Class, centre, size and maybe confidence per line; another number of fields is an error."""
    out = []
    for n, line in enumerate(text.splitlines(), 1):
        f = line.split()
        if f:
            if len(f) not in (5, 6):
                raise ValueError(f"line {n}: {len(f)} fields")
            out.append(tuple(map(float, f)))
    return out


def _parsed(spark: SparkSession, path: str, parse, shape: str, kinds: list[pa.DataType], folder: bool = False) -> DataFrame:
    """source_file (or the folder of each file) and the rows that ``parse`` makes of each file's text."""
    names = ["source_file", *(x.split()[0] for x in shape.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, *r) for f, text in zip(*(c.to_pylist() for c in b.columns), strict=True) for r in parse(text or "")]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), *kinds], strict=True)], names=names)

    name = F.element_at(F.split("_metadata.file_path", "/"), -2) if folder else F.col("_metadata.file_name")
    texts = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(name.alias("source_file"), "value")
    return texts.mapInArrow(run, f"source_file string, {shape}")


def read_brand_lists(spark: SparkSession, path: str) -> DataFrame:
    """Columns source_file, brand, at (position in the list), location of many brand lists."""
    parse = lambda text: ((brand, i, t) for brand, ts in brand_list(text).items() for i, t in enumerate(ts))
    return _parsed(spark, path, parse, "brand string, at int, location string", [pa.string(), pa.int32(), pa.string()])


def read_listed_brands(spark: SparkSession, path: str) -> DataFrame:
    """Columns source_file, brand: the first word behind each ``#``, once a file."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source_file"), F.explode(F.regexp_extract_all("value", F.lit("(?U)#(\\w+)"), 1)).alias("brand"))
    return texts.distinct()


def read_preferences(spark: SparkSession, path: str) -> DataFrame:
    """Columns source_file, file_name, annotator, group_brand, at, touchpoint; a brand without touchpoints has no row."""

    def parse(text: str) -> Iterator[tuple]:
        p = preferences(text)
        for key, ts in p.touchpoints.items():
            for i, t in enumerate(ts):
                yield p.file_name, p.annotator, key, i, t

    return _parsed(spark, path, parse, "file_name string, annotator string, group_brand string, at int, touchpoint string", [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()])


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Columns source_file, brand, touchpoint.  A line without exactly one dash ends the reading with an error."""
    return _parsed(spark, path, pairs, "brand string, touchpoint string", [pa.string(), pa.string()])


def read_class_ids(spark: SparkSession, path: str) -> DataFrame:
    """Columns source_file, label, class_id."""
    return _parsed(spark, path, lambda text: class_ids(text).items(), "label string, class_id bigint", [pa.string(), pa.int64()])


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Columns image (the folder's ``image=`` name), class_id, x_center, y_center, width, height, confidence (or null)."""
    parse = lambda text: ((int(d[0]), *d[1:5], d[5] if len(d) > 5 else None) for d in detections(text))
    kinds = [pa.int64(), *[pa.float64()] * 5]
    out = _parsed(spark, path, parse, "class_id bigint, x_center double, y_center double, width double, height double, confidence double", kinds, folder=True)
    return out.withColumn("source_file", F.url_decode(F.regexp_replace("source_file", "^image=", ""))).withColumnRenamed("source_file", "image")


# -- editing preferences as maps of brand to touchpoints -------------------------------------------------------------


def add_touchpoint(held: Column, brand: Column, touchpoint: Column, at: int = 1) -> Column:
    """Puts a touchpoint at a place of a brand's list (1-based) unless it is there; a new brand gets a list of its own."""
    now = F.coalesce(F.try_element_at(held, brand), F.array().cast("array<string>"))
    new = F.when(F.array_contains(now, touchpoint), now).otherwise(F.array_insert(now, at, touchpoint))
    return F.map_concat(F.map_filter(held, lambda k, _: k != brand), F.create_map(brand, new))


def rename_touchpoint(held: Column, brand: Column, old: Column, new: Column) -> Column:
    return F.transform_values(held, lambda k, v: F.when(k == brand, F.transform(v, lambda x: F.when(x == old, new).otherwise(x))).otherwise(v))


def delete_touchpoint(held: Column, brand: Column, old: Column) -> Column:
    return F.transform_values(held, lambda k, v: F.when(k == brand, F.array_remove(v, old)).otherwise(v))


def rename_brand(held: Column, old: Column, new: Column) -> Column:
    """The brand under another name; one that already has that name gives way."""
    kept = F.map_filter(held, lambda k, _: (k != new) | (old == new) | ~F.coalesce(F.map_contains_key(held, old), F.lit(False)))
    return F.transform_keys(kept, lambda k, _: F.when(k == old, new).otherwise(k))


def delete_brand(held: Column, brand: Column) -> Column:
    return F.map_filter(held, lambda k, _: k != brand)
