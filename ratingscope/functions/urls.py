"""URL slugs and the title test that goes with them."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Fixed value: the review page of a film.
URL_TEMPLATE = "https://www.rottentomatoes.com/m/{slug}/reviews"

# Characters that count as a space, and the one that is dropped.
SPACE_LIKE = "×·–…™" + string.punctuation
DROPPED = "’"


def slug_squeezed(title: Column) -> Column:
    """Lower-case; apostrophes gone, ``&`` as ``and``, other runs as one ``_``."""
    text = F.regexp_replace(strip(title), "[’']", "")
    text = F.replace(text, F.lit("&"), F.lit("and"))
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]+", "_"))


def slug_plain(title: Column) -> Column:
    """Lower-case with ``_`` for each space."""
    return F.lower(F.translate(strip(title), " ", "_"))


def is_clean_title(title: Column) -> Column:
    """Only letters, digits and space once the known punctuation counts as space."""
    text = F.translate(strip(title), SPACE_LIKE + DROPPED, " " * len(SPACE_LIKE))
    return text.rlike(r"(?U)^[\p{L}\p{N}\s]*$")


def review_url(slug: Column, template: str = URL_TEMPLATE) -> Column:
    head, tail = template.split("{slug}")
    return F.concat(F.lit(head), slug, F.lit(tail))
