"""Pictures as arrays (height x width x channels): histograms, slices, templates, crops.

Frames come from Spark's image source or from arrays; the measures are plain numpy so that an Arrow UDF can apply them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Pearson correlation of two histograms; equal constant ones count as 1, others as 0."""
    x, y = a.astype(float).ravel() - a.mean(), b.astype(float).ravel() - b.mean()
    n = np.sqrt((x * x).sum() * (y * y).sum())
    return float((x * y).sum() / n) if n else float(np.array_equal(a, b))


def histogram(part: np.ndarray, bins: int) -> np.ndarray:
    """How many pixels fall into each combination of the channels' bins."""
    at = part.reshape(-1, part.shape[-1]).astype(np.int64) * bins // 256
    return np.bincount(at @ bins ** np.arange(part.shape[-1])[::-1], minlength=bins ** part.shape[-1])


def region_similarity(a: np.ndarray, b: np.ndarray, grid: int = 3, bins: int = 8) -> float:
    """Mean correlation of the colour histograms of a grid of regions, laid out by the first picture's size."""
    h, w = a.shape[0] // grid, a.shape[1] // grid
    cells = [(slice(r * h, (r + 1) * h), slice(c * w, (c + 1) * w)) for r in range(grid) for c in range(grid)]
    return float(np.mean([correlation(histogram(a[s], bins), histogram(b[s], bins)) for s in cells]))


def strict_similarity(a: np.ndarray, b: np.ndarray, slices: int = 20, bins: int = 32, least: float = 0.9) -> float:
    """The score of the first horizontal slice below ``least``, else of the last one."""
    h = max(1, a.shape[0] // slices)
    score = 1.0
    for i in range(slices):
        x, y = a[i * h : (i + 1) * h], b[i * h : (i + 1) * h]
        if not x.size or not y.size:
            break
        score = correlation(histogram(x, bins), histogram(y, bins))
        if score < least:
            break
    return score


def template_score(picture: np.ndarray, template: np.ndarray) -> float:
    """The largest normalised correlation of the template at any place of a grey picture."""
    windows = np.lib.stride_tricks.sliding_window_view(picture.astype(float), template.shape)
    t = template.astype(float) - template.mean()
    centred = windows - windows.mean(axis=(-1, -2), keepdims=True)
    den = np.sqrt((centred**2).sum(axis=(-1, -2)) * (t**2).sum())
    with np.errstate(invalid="ignore", divide="ignore"):
        return float(np.nan_to_num((centred * t).sum(axis=(-1, -2)) / den).max())


def any_template(picture: np.ndarray, templates: list[np.ndarray], least: float) -> int:
    """Index of the first template that matches, or -1."""
    return next((i for i, t in enumerate(templates) if template_score(picture, t) >= least), -1)


def crop(picture: np.ndarray, x: int, y: int, w: int, h: int) -> np.ndarray:
    return picture[y : y + h, x : x + w]


def decode(image: dict) -> np.ndarray | None:
    """The array of a row of Spark's image source; None where the picture couldn't be read."""
    if not image or image["height"] is None or image["height"] < 0:
        return None
    return np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])


def measure_pairs(pairs: DataFrame, measure: Callable[[np.ndarray, np.ndarray], float] = region_similarity) -> DataFrame:
    """(target, compared, a, b), with a and b image structs, to (target, compared, score); unreadable ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                p, q = decode(x), decode(y)
                if p is not None and q is not None:
                    at.append(i)
                    out.append(measure(p, q))
            k = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(k), b.column(1).take(k), pa.array(out, pa.float64())], names=["target_image", "compared_image", "score"])

    return pairs.select("target", "compared", "a", "b").mapInArrow(run, "target_image string, compared_image string, score double")


def match_templates(pictures: DataFrame, templates: list[np.ndarray], least: float) -> DataFrame:
    """(name, image) to name, template, score: the first template that scores ``least`` or more, and its score.

    Where none does, template is -1 and score the best of all.  Pictures are compared in grey (the mean of their
    channels); unreadable ones, and those smaller than a template, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, which, score = [], [], []
            for i, x in enumerate(b.column(1).to_pylist()):
                p = decode(x)
                if p is None or any(p.shape[0] < t.shape[0] or p.shape[1] < t.shape[1] for t in templates):
                    continue
                grey, found, best = p.mean(axis=-1), -1, -1.0
                for n, t in enumerate(templates):
                    best = max(best, got := template_score(grey, t))
                    if got >= least:
                        found, best = n, got
                        break
                at.append(i)
                which.append(found)
                score.append(best)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(which, pa.int32()), pa.array(score, pa.float64())], names=["name", "template", "score"])

    return pictures.select("name", "image").mapInArrow(run, "name string, template int, score double")


def crop_pictures(pictures: DataFrame, x: int, y: int, w: int, h: int) -> DataFrame:
    """(name, image) to name, width, height, data: the part of each picture that a box holds; unreadable ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [(n, crop(p, x, y, w, h)) for n, i in zip(*(c.to_pylist() for c in b.columns), strict=True) if (p := decode(i)) is not None]
            cols = [pa.array([n for n, _ in parts], pa.string()), pa.array([p.shape[1] for _, p in parts], pa.int32()), pa.array([p.shape[0] for _, p in parts], pa.int32()), pa.array([p.tobytes() for _, p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["name", "width", "height", "data"])

    return pictures.select("name", "image").mapInArrow(run, "name string, width int, height int, data binary")
