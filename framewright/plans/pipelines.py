"""The pipelines: player sheets, social reports, annotations to history, frame reduction and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators import aggregate, joins, reshape, sequences, setops
from framewright.operators.ordered import global_rank
from framewright.operators.stretches import Ordering, frames
from framewright.session import store


#: Frames of a bucket in which rows and the frames of batters meet.
_MEET = 1 << 8


def _last_and_gap(who: DataFrame, spans: DataFrame) -> DataFrame:
    """Per file the stretches of frames in which the same batter is the last one: lo, hi, here, fill.

    ``here`` are those at frame lo itself, null in the stretch before the first one, which the first one fills.
    """
    o = Ordering(["file"], ["frame_no"], frames("frame_no"))
    per = who.groupBy("file", "frame_no").agg(F.array_sort(F.collect_list(F.struct("row_id", "player", "inning"))).alias("here"))
    per = o.neighbour(o.neighbour(per, {"frame_no": "next"}, behind=True, keep=True), {"frame_no": "before"}).join(spans, "file")
    lo, hi = F.col("frame_no"), F.coalesce(F.col("next") - 1, F.greatest("stop", "frame_no"))
    own = F.struct(lo.alias("lo"), hi.alias("hi"), F.col("here"), F.element_at("here", -1).alias("fill"))
    lead = F.struct(F.col("start").alias("lo"), (lo - 1).alias("hi"), F.lit(None).cast(per.schema["here"].dataType).alias("here"), F.get("here", F.lit(0)).alias("fill"))
    return per.select("file", F.explode(F.array_compact(F.array(own, F.when(F.col("before").isNull() & (F.col("start") < lo), lead)))).alias("x")).select("file", "x.*")


def with_batters(rows: DataFrame, who: DataFrame) -> DataFrame:
    """What expanding the rows to frames and giving each frame its batters comes to, without expanding them.

    ``rows`` have file, frame_no, duration (1 or more); ``who`` has file, frame_no, row_id, player, inning.  A frame that
    has batters takes each of them; another one takes the last of those before it, or else the first of the file.  Out
    comes a row for each part of a row with one batter: player, inning, part_first, part_frames behind its columns.  Files
    without batters have none.
    """
    last = F.col("frame_no") + F.col("duration") - 1
    spans = rows.groupBy("file").agg(F.min("frame_no").alias("start"), F.max(last).alias("stop"))
    bucket = lambda a, b: F.explode(F.sequence(F.floor(a / _MEET), F.floor(b / _MEET))).alias("_bucket")
    stretches = _last_and_gap(who, spans).select("*", bucket(F.col("lo"), F.col("hi")))
    at_lo = F.col("_bucket") == F.floor(F.col("lo") / _MEET)
    stretches = stretches.withColumn("here", F.when(at_lo, F.col("here")))
    both = rows.select("*", bucket(F.col("frame_no"), last)).join(stretches, ["file", "_bucket"])
    first = F.greatest(F.col("frame_no"), F.col("lo"), F.col("_bucket") * _MEET)
    stop = F.least(last, F.col("hi"), F.col("_bucket") * _MEET + _MEET - 1)
    both = both.withColumns({"_first": first, "_stop": stop}).filter("_first <= _stop")
    part = lambda who, first, n: F.struct(who["player"].alias("player"), who["inning"].alias("inning"), first.alias("part_first"), n.cast("bigint").alias("part_frames"))
    begins = F.col("here").isNotNull() & (F.col("_first") == F.col("lo"))
    here = F.transform("here", lambda x: part(x, F.col("_first"), F.lit(1)))
    rest = F.when(F.col("_stop") > F.col("_first"), part(F.col("fill"), F.col("_first") + 1, F.col("_stop") - F.col("_first")))
    parts = F.when(begins, F.concat(here, F.array_compact(F.array(rest)))).otherwise(F.array(part(F.col("fill"), F.col("_first"), F.col("_stop") - F.col("_first") + 1)))
    return both.select(*rows.columns, F.explode(parts).alias("_x")).select(*rows.columns, "_x.*")


def player_sheet(homeplate: DataFrame, batters: DataFrame, base: int = 1) -> DataFrame:
    """Exposures per player and half inning.

    Both tables have file, frame_no, row_id, brand, location, duration, screen_time, screen_location, screen_size_pct,
    average_hits.  Batters' runs of equal clubs number the half innings.  The rows of either table take the players of
    their frames (see ``with_batters``), rows alike but for their frame become one, labels of players are dropped, and
    players of one frame made one by majority (of equally frequent ones that of the least row).  A batter without a
    player has the last one before, or else the first of the file.
    """
    by, order = ["file"], ["frame_no", "row_id"]
    runs = sequences.run_index(batters.filter("frame_no is not null"), by, order, ["brand"], frames("frame_no"))
    who = runs.select(*by, *order, F.col("location").alias("player"), sequences.half_innings(F.col("run"), base).alias("inning"))
    who = sequences.leading_fill(sequences.forward_fill(who, by, order, ["player"], frames("frame_no")), by, order, ["player"])
    both = setops.union_by_name(homeplate, batters).filter("frame_no is not null and duration >= 1 and not location rlike '[0-9]\\\\s*-\\\\s*'")
    keys = ["file", "brand", "location", "screen_time", "screen_location", "screen_size_pct", "average_hits", "player", "inning"]
    parts = with_batters(both, who).withColumns({"frame_no": F.col("part_first"), "duration": F.col("part_frames"), "total_hits": F.col("part_frames")})
    out = store(reshape.compact(parts, keys, ["duration", "total_hits"], "frame_no").withColumn("row", F.struct(*keys)))
    out = sequences.majority_vote(out, ["file", "frame_no"], "player", "row")
    return sequences.majority_vote(out, ["file", "frame_no"], "inning", "row").drop("row")


def social_report(article: DataFrame, text: DataFrame, photo: DataFrame) -> DataFrame:
    """Articles with their text mentions and photo exposures, photos without sponsor left out, numbered.

    article: art_id, user, url, followers; text: art_id, sponsor, touchpoint; photo: art_id, photo_url, sponsor,
    touchpoint, percentage.
    """
    parts = setops.union_by_name(text.withColumn("src", F.lit(0)), photo.withColumn("src", F.lit(1)))
    full = joins.outer_report(article, parts, "art_id")
    # The joined rows all carry their article's columns already, so there is nothing to fill forward.
    full = full.withColumn("url", F.coalesce("photo_url", "url")).filter(~F.col("sponsor").eqNullSafe("photo"))
    ids = global_rank(full.select("art_id").distinct(), ["art_id"], "report_id")
    return full.join(ids, "art_id").select("report_id", "art_id", "user", "url", "followers", "sponsor", "touchpoint", "percentage")


def exposures_of(annotations: DataFrame) -> DataFrame:
    """Annotation documents to merged exposures: one row per brand, touchpoint and run of frames."""
    boxes = reshape.explode_annotations(annotations)
    frame = F.coalesce(F.regexp_extract("imageName", "([0-9]+)", 1).try_cast("bigint"), F.col("imageIndex").cast("bigint"))
    rows = boxes.withColumn("offset", frame).withColumn("row_id", F.struct("imageIndex", "start_point"))
    return sequences.merge_consecutive(rows, ["project", "group", "brand", "tpoint"], "offset", "hits", ["imageName"], [], "row_id")


def checked_against_history(exposures: DataFrame, ledger: DataFrame, percent: float = 25.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new ledger rows, combinations off by more than ``percent``, combinations never seen) of files not in the ledger.

    ``ledger`` is the whole ledger: a file with any row in it isn't new, and history is the mean of all its values that
    can be a logarithm of ``normalised_exposure`` (finite, below 24).
    """
    v = F.col("avg_total_duration")
    fresh = exposures.join(ledger.select("file_name").distinct(), "file_name", "left_anti")
    rows = aggregate.normalised_exposure(fresh, "file_name", ["brand", "location"], "frame_no", "duration", "row_id")
    # Values have three digits: their sum is exact as a decimal, in whatever order it is made.
    mean = lambda t: t.groupBy("brand", "location").agg(F.round(F.sum(v.cast("decimal(18,3)")).cast("double") / F.count(F.lit(1)), 3).alias("value"))
    new, old = mean(rows), mean(ledger.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 24)))
    return rows, joins.history_diff(new, old, ["brand", "location"], "value", percent), joins.new_keys(new, old, ["brand", "location"])


def reduced_frames(edges: DataFrame, by: list[str], order: list[str], least: float = 0.98) -> DataFrame:
    """Runs of alike frames from edges (target_image, compared_image, score): the first stands for all of its run."""
    return sequences.similarity_runs(edges, by, order, "score", "target_image", least)


def restored_durations(rows: DataFrame, runs: DataFrame, frame: str = "frame") -> DataFrame:
    """Durations of rows annotated on reduced frames, with the frames that their run stood for added back.

    ``runs`` has first_image and n_images; see ``joins.add_runs`` for how names and frames meet.  A row that no run
    meets stays.
    """
    return joins.add_runs(rows, runs, frame, "first_image", "n_images", ["duration", "total_hits"])
