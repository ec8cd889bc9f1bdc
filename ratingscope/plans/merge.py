"""Reviews with the class of their movie."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.joins import not_broadcast
from ..operators.reports import match_report
from ..sources.readers import require_columns


def attach_category(
    reviews: DataFrame,
    categories: DataFrame,
    *,
    key: str = "imdb_id",
    category: str = "category",
    required: tuple[str, ...] = ("title",),
    files: bool | str | list[str] = False,
) -> tuple[DataFrame, DataFrame]:
    """All review rows with ``category`` where the movie has one, and the match report.

    The category list is not de-duplicated: a movie listed twice doubles its rows. It has a row
    for each movie, so it is not broadcast.
    ``files`` adds the number of files that hold reviews to the report, or with a path the
    number of all files there.
    """
    require_columns(reviews, [*required, key])
    merged = reviews.join(not_broadcast(categories.select(key, category)), key, "left")
    return merged, match_report(reviews, merged, category, files)
