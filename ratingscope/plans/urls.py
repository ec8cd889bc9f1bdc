"""Review page addresses for movie titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.urls import URL_TEMPLATE, is_clean_title, review_url, slug_plain, slug_squeezed
from ..operators.batches import BATCH_ROWS, assign_batches


def review_urls(
    movies: DataFrame,
    *,
    order: list[str] | None = None,
    template: str = URL_TEMPLATE,
    rows: int = BATCH_ROWS,
) -> DataFrame:
    """``title``, ``imdb_id``, ``url`` and batch number ``part``.

    Position is by ``order`` (default ``imdb_id``, then title). A null title has no url.
    """
    urls = movies.select(
        strip(F.col("title")).alias("title"),
        "imdb_id",
        review_url(slug_squeezed(F.col("title")), template).alias("url"),
        *[F.col(c).alias(f"_by_{c}") for c in order or []],
    )
    by = [f"_by_{c}" for c in order or []] + ["imdb_id", "title"]
    return assign_batches(urls, by, rows).select("title", "imdb_id", "url", "part")


def route_titles(movies: DataFrame, template: str = URL_TEMPLATE) -> DataFrame:
    """``clean`` titles with a plain-slug ``url``; the others without."""
    clean = F.coalesce(is_clean_title(F.col("title")), F.lit(False))
    return movies.select(
        strip(F.col("title")).alias("title"),
        "imdb_id",
        clean.alias("clean"),
        F.when(clean, review_url(slug_plain(F.col("title")), template)).alias("url"),
    )
