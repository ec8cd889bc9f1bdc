"""Lenient casts for all-string tables. Nothing here raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date formats accepted, first hit wins.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd/MM/yyyy")
MONTH_DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "M/d/yyyy")

_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)\s*$"


def imdb_id(raw: Column) -> Column:
    """``tt`` + at least seven digits; longer ids keep all of them, null stays null."""
    text = raw.cast("string")
    return F.concat(F.lit("tt"), F.when(F.length(text) >= 7, text).otherwise(F.lpad(text, 7, "0")))


def digits_only_int(c: Column) -> Column:
    """Int if the text is all digits, else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def _whole_number(c: Column, type_name: str) -> Column:
    # "862.0" -> 862, ".5" -> 0: sign and digits before the point, the rest is cut.
    sign = F.regexp_extract(c, r"^\s*([+-]?)", 1)
    digits = F.regexp_extract(c, r"^\s*[+-]?([0-9]*)", 1)
    value = F.concat(sign, F.lit("0"), digits).try_cast("decimal(38,0)").try_cast(type_name)
    return F.when(c.rlike(_NUMBER), value)


def lenient_int(c: Column) -> Column:
    return _whole_number(c, "int")


def lenient_long(c: Column) -> Column:
    return _whole_number(c, "bigint")


def lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def _first_date(c: Column, formats: tuple[str, ...]) -> Column:
    """A failed try costs far more than a good one, so what lacks the mark of a format is not tried."""

    def tried(f: str) -> Column:
        possible = c.contains(next(mark for mark in "-,/" if mark in f))
        # A day never has three digits: what ends in a year does not begin with one.
        possible = possible & ~c.rlike("/[1-9][0-9]{2,}$") if f == "yyyy/MM/dd" else possible
        return F.when(possible, F.try_to_date(c, f))

    return F.coalesce(*[tried(f) for f in formats])


def parse_date(c: Column) -> Column:
    """Numeric dates: ISO, slashed ISO, US, then European order."""
    return _first_date(c, DATE_FORMATS)


def parse_month_date(c: Column) -> Column:
    """Dates with a month name, or short US dates."""
    return _first_date(c, MONTH_DATE_FORMATS)
