"""Schemas of the tables the operators work on (names in snake case, types fixed, nothing inferred)."""

from __future__ import annotations

from pyspark.sql import types as T


def fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

#: One exposure: a brand at a location for ``duration`` frames.
EXPOSURE = fields(
    ("brand", _S),
    ("location", _S),
    ("screen_time", _S),
    ("duration", _I),
    ("screen_location", _S),
    ("screen_size_pct", _D),
    ("total_hits", _I),
    ("average_hits", _D),
    ("frame", _S),
)
#: The header that exposure exports carry, in column order.  Fixed values.
EXPOSURE_HEADER = (
    "Brand",
    "Location",
    "Time the brand is at screen",
    "Duration",
    "Screen Location",
    "Screen Size %",
    "Total Hits",
    "Average Hits",
    "Sequence Frame Number",
)
#: The pieces that a video's frame rows are delivered in.
PIECE_HEADER = ("Brand", "Location", "Duration", "Sequence Frame Number")
NEWS_EXPOSURE = fields(
    ("brand", _S),
    ("location", _S),
    ("channel", _S),
    ("air_date", _S),
    ("duration", _I),
    ("solus", _I),
    ("screen_location", _S),
    ("screen_size_pct", _D),
    ("total_hits", _I),
    ("average_hits", _D),
    ("frame", _L),
)
PHOTO_EXPOSURE = fields(("art_id", _S), ("photo_id", _S), ("photo_url", _S), ("sponsor", _S), ("touchpoint", _S), ("percentage", _D), ("hits", _D))
RESULTS_LEDGER = fields(("file_name", _S), ("brand", _S), ("location", _S), ("total_frames", _L), ("total_duration", _L), ("avg_total_duration", _D))
SIMILARITY_EDGE = fields(("target_image", _S), ("compared_image", _S), ("score", _D))
IMAGE_HASH = fields(("image_name", _S), ("hash", _S))
BOX = fields(("start_point", T.ArrayType(_D)), ("diag_point", T.ArrayType(_D)), ("group", _S), ("brand", _S), ("tpoint", _S), ("hits", _I))
IMAGE = T.StructType([T.StructField("imageName", _S), T.StructField("imageIndex", _I), T.StructField("width", _D), T.StructField("height", _D), T.StructField("annotations", T.ArrayType(BOX))])
ANNOTATIONS = T.StructType([T.StructField("project", _S), T.StructField("images", T.MapType(_S, IMAGE))])
