"""File names: natural order, base names, clean-up rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(c: Column) -> Column:
    """An array to order by: runs of digits compare as numbers, everything else without case."""
    parts = F.regexp_extract_all(F.lower(c), F.lit("([0-9]+|[^0-9]+)"), 1)
    return F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), F.lpad(x, F.greatest(F.lit(20), F.length(x)), "0")).otherwise(x))


def base_name(c: Column) -> Column:
    """The text before the first dash, without ``reduced_`` and a part number."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(c, "-", 1), "^reduced_", ""), "_?part ?[0-9]+$", "")


def stem(c: Column) -> Column:
    """The name without folder and suffix."""
    return F.regexp_replace(F.substring_index(c, "/", -1), "\\.[^.]*$", "")


def unnumbered(c: Column) -> Column:
    """The stem without a number, or a number in brackets, at its end."""
    return F.regexp_replace(stem(c), "[ _-]*(\\(?[0-9]+\\)?)$", "")


def without_any(c: Column, pieces: list[str]) -> Column:
    """Each piece taken out, one after the other."""
    for p in pieces:
        c = F.replace(c, F.lit(p), F.lit(""))
    return c


def names_country(c: Column, countries: list[str]) -> Column:
    """Whether a name holds one of the countries, whatever its case; a null name holds none."""
    return F.coalesce(F.upper(c).rlike("|".join(x.upper() for x in countries)), F.lit(False))


def dashed_digits(c: Column) -> Column:
    """A dash between digits becomes an underscore; a dash and a word at the end are dropped."""
    return F.regexp_replace(F.regexp_replace(c, "([0-9])-([0-9])", "$1_$2"), "-[A-Za-z]+$", "")


def spaced_camel(c: Column) -> Column:
    """Blanks before capitals."""
    return F.trim(F.regexp_replace(c, "([A-Z])", " $1"))


def suffix(c: Column) -> Column:
    return F.lower(F.substring_index(c, ".", -1))


def collision_safe(name: Column, place: Column) -> Column:
    """``base.ext`` for the first of a name, ``base_n.ext`` for the n-th repetition (place 1, 2, ...)."""
    numbered = F.regexp_replace(name, "(\\.[^.]*)?$", "")
    return F.when(place <= 1, name).otherwise(F.concat(numbered, F.lit("_"), (place - 1).cast("string"), F.regexp_extract(name, "(\\.[^.]*)?$", 0)))
