"""Text columns: cleaning, tokens, flags, JSON arrays."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stopwords import ENGLISH


# Unicode white space.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The characters that cleaning keeps, ``a-zA-Z0-9\s``. Named one by one they are looked
# up in a table of bits; ranges are compared one after the other.
KEPT = string.ascii_letters + string.digits + r" \t\n\x0B\f\r"


def strip(c: Column) -> Column:
    """Both ends freed of any Unicode white space."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_review(c: Column, glue: bool = True) -> Column:
    """Letters, digits and white space only.

    Everything else is deleted, which glues ``coming-of-age`` to one word.
    ``glue=False`` puts a space in its place, except for list brackets and
    apostrophes, which are always deleted.
    """
    if glue:
        return F.regexp_replace(c, f"[^{KEPT}]+", "")
    return F.regexp_replace(F.regexp_replace(c, r"[\[\]']+", ""), f"[^{KEPT}]", " ")


def pieces_of(c: Column) -> Column:
    """Lower-case pieces between single white-space characters, blank ones included."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s")


def is_word(piece: Column, stop_words: Iterable[str] = ENGLISH) -> Column:
    """Neither blank nor a stop word in any case."""
    stop = sorted({w.lower() for w in stop_words})
    return (piece != "") & ~piece.isin(stop) if stop else piece != ""


def words_of(c: Column, stop_words: Iterable[str] = ENGLISH) -> Column:
    """The words of a text, stop words out; null text gives none."""
    stop_words = list(stop_words)
    return F.filter(pieces_of(c), lambda w: is_word(w, stop_words))


def is_positive(sentiment: Column) -> Column:
    """1.0 for ``positive`` in any case, else 0.0, null included."""
    return F.when(F.lower(sentiment) == "positive", 1.0).otherwise(0.0)


def escape_quotes(c: Column) -> Column:
    """A backslash before every double quote."""
    return F.replace(c, F.lit('"'), F.lit('\\"'))


def json_names(c: Column, field: str = "name", type_name: str = "string") -> Column:
    """One field of every object in a JSON array; single quotes are accepted."""
    parsed = F.from_json(c, f"array<struct<`{field}`: {type_name}>>")
    return F.transform(parsed, lambda x: x[field])


def resolve_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Rename columns that match a wanted name in another case."""
    by_lower = {c.lower(): c for c in df.columns}
    for name in wanted:
        found = by_lower.get(name.lower())
        if found and found != name:
            df = df.withColumnRenamed(found, name)
    return df
