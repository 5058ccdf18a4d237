"""Times of day and dates as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_of(c: Column) -> Column:
    """``HH:MM:SS`` to seconds; null where it isn't that."""
    p = F.split(c, ":")
    ok = c.rlike("^[0-9]{1,2}:[0-9]{2}:[0-9]{2}$")
    return F.when(ok, F.get(p, F.lit(0)).cast("int") * 3600 + F.get(p, F.lit(1)).cast("int") * 60 + F.get(p, F.lit(2)).cast("int"))


def clock(seconds: Column, wrap: int | None = None) -> Column:
    """Seconds to ``HH:MM:SS``; hours go on beyond 24 unless wrapped at ``wrap`` seconds."""
    s = F.pmod(seconds, F.lit(wrap)) if wrap else seconds
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def start_time(c: Column) -> Column:
    """A start time ``HHMM``; anything else, and hours or minutes beyond a day, count as ``0000``."""
    return F.when(c.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$"), c).otherwise("0000")


def screen_time(start: Column, frame: Column) -> Column:
    """Start time ``HHMM`` plus a frame a second, within a day."""
    s = start_time(start)
    return clock(F.substring(s, 1, 2).cast("int") * 3600 + F.substring(s, 3, 2).cast("int") * 60 + frame, 86400)


def day(c: Column) -> Column:
    """``dd/MM/yyyy`` to a date; null where it isn't one."""
    return F.when(c.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_date(c, "dd/MM/yyyy") if hasattr(F, "try_to_date") else F.to_date(c, "dd/MM/yyyy"))


def guessed_day(digits: Column) -> Column:
    """Eight digits ``ddMMyyyy`` as ``dd/MM/yyyy``; day and month are swapped where the month is beyond 12."""
    d, m, y = F.substring(digits, 1, 2), F.substring(digits, 3, 2), F.substring(digits, 5, 4)
    return F.when(m.cast("int") > 12, F.concat_ws("/", m, d, y)).otherwise(F.concat_ws("/", d, m, y))


def spoken(seconds: Column) -> Column:
    """Minutes and seconds in words."""
    return F.format_string("%d min %d sec", F.floor(seconds / 60), seconds % 60)


def start_of_frame(c: Column) -> tuple[Column, Column]:
    """Start time and second of a frame named ``..._HHMM_second``; null where it isn't so named."""
    ok = c.rlike("_[0-9]{4}_[0-9]+$")
    parts = F.split(c, "_")
    return F.when(ok, F.element_at(parts, -2)), F.when(ok, F.element_at(parts, -1).try_cast("bigint"))
