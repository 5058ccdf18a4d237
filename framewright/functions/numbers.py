"""Numbers, boxes and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(c: Column, digits: int) -> Column:
    """Rounded with halves towards plus infinity."""
    return F.floor(c * 10**digits + 0.5) / float(10**digits)


def log_measure(ratio: Column) -> Column:
    """The absolute logarithm of a ratio, to three digits; a ratio of zero gives the largest value."""
    return F.round(F.abs(F.ln(F.abs(ratio) + 1e-10)), 3)


def percent_change(new: Column, old: Column) -> Column:
    """How far ``new`` is from ``old`` in percent of it; infinite where ``old`` is zero and ``new`` isn't."""
    return F.when(old != 0, F.abs((new - old) / old) * 100).when(new != 0, F.lit(float("inf")))


def finite_or_zero(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def padded(number: Column, width: Column) -> Column:
    """Zero padding that never cuts."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(width, F.length(text)), "0")


def box_percent(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column) -> Column:
    return half_up(F.abs(x1 - x0) * F.abs(y1 - y0) / (w * h) * 100, 3)


def zone(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """The letter of the part of the picture that holds a box's centre."""
    inner_left = F.when(cy < h / 4, "B").when(cy >= 3 * h / 4, "E").otherwise("A")
    inner_right = F.when(cy < h / 4, "C").when(cy >= 3 * h / 4, "D").otherwise("A")
    left, right = F.when(cy < h / 2, "B").otherwise("E"), F.when(cy < h / 2, "C").otherwise("D")
    return F.when(cx < w / 4, left).when(cx < w / 2, inner_left).when(cx < 3 * w / 4, inner_right).otherwise(right)


def centre_box(x0: Column, y0: Column, x1: Column, y1: Column, w: Column, h: Column) -> list[Column]:
    """Corners to centre and size, each as a share of the picture."""
    return [((x0 + x1) / 2 / w).alias("x_center"), ((y0 + y1) / 2 / h).alias("y_center"), (F.abs(x1 - x0) / w).alias("width"), (F.abs(y1 - y0) / h).alias("height")]


def corner_box(xc: Column, yc: Column, bw: Column, bh: Column, w: Column, h: Column) -> list[Column]:
    return [((xc - bw / 2) * w).alias("x0"), ((yc - bh / 2) * h).alias("y0"), ((xc + bw / 2) * w).alias("x1"), ((yc + bh / 2) * h).alias("y1")]


def clamped(c: Column, top: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0)), top)


def kept_edge(a: Column, b: Column, top: Column, least: int = 10) -> Column:
    """The clamped ends of a box's edge as an array; null where less than ``least`` is left of it."""
    x, y = clamped(F.least(a, b), top), clamped(F.greatest(a, b), top)
    return F.when(y - x >= least, F.array(x, y))


def display_size(w: Column, h: Column, most: int = 730) -> list[Column]:
    shown = F.least(w, F.lit(most))
    return [shown.alias("shown_w"), (h * shown / w).alias("shown_h")]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def pearson(a: Column, b: Column) -> Column:
    """Correlation of two arrays of one length; null where one is constant."""
    n = F.size(a)
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double"))
    num = n * dot(a, b) - total(a) * total(b)
    den = F.sqrt(n * dot(a, a) - total(a) * total(a)) * F.sqrt(n * dot(b, b) - total(b) * total(b))
    return F.when(den > 0, num / den)
