"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space of any kind, as a Java regular expression.
_SPACE = "[\\s\\x1c-\\x1f]"


def strip_all(c: Column) -> Column:
    """Without white space of any kind (blanks, tabs, no-break and ideographic spaces ...) at both ends."""
    return F.regexp_replace(c, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def has_visible(c: Column) -> Column:
    """True where the text holds a character that is not white space; null counts as false."""
    return F.coalesce(c.rlike("(?U)[^\\s\\x1c-\\x1f]"), F.lit(False))


def last_number(c: Column) -> Column:
    """The last run of ASCII digits as a long; null where there is none or where it exceeds a long."""
    return F.regexp_extract(c, "([0-9]+)[^0-9]*\\z", 1).try_cast("bigint")


def first_number(c: Column) -> Column:
    """The first run of ASCII digits as a long; null where there is none."""
    return F.regexp_extract(c, "([0-9]+)", 1).try_cast("bigint")


def word_count(c: Column) -> Column:
    """Words between blanks; ``n photo`` counts n; ``__`` can't be told and is null."""
    photos = F.regexp_extract(c, "^([0-9]+) photos?$", 1).try_cast("int")
    words = F.size(F.split(F.trim(F.regexp_replace(c, "\\s+", " ")), " "))
    return F.when(c == "__", None).when(photos.isNotNull(), photos).when(F.trim(c) == "", 0).otherwise(words).cast("int")
