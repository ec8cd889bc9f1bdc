"""Word tables per critic/audience class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import not_broadcast
from ..operators.reports import stop_word_report
from ..operators.words import avg_tfidf, drop_stop_words, top_words, word_frequency
from ..workdir import materialized


def category_words(reviews: DataFrame, clusters: DataFrame, **options) -> DataFrame:
    """``side, category, word, word_occurrences, total_word_occurrences``.

    ``reviews`` holds ``imdb_id``, ``reviews_c`` and ``reviews_u``; ``clusters`` holds
    ``imdb_id`` and ``category``. Options as in :func:`count_words`.
    """
    known = clusters.select("imdb_id", "category").where(
        F.col("imdb_id").isNotNull() & F.col("category").isNotNull()
    )
    texts = reviews.select("imdb_id", "reviews_c", "reviews_u").where(F.col("imdb_id").isNotNull())
    return word_frequency(texts.join(not_broadcast(known), "imdb_id"), **options)


def clean_word_table(
    counts: DataFrame,
    stop_words: DataFrame,
    by: tuple[str, ...] = ("side", "category"),
    work_dir: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts without listed words, the report on them, and the top words for a cloud.

    The counts are written once, so the three tables do not read the texts again.
    """
    counts = materialized(counts, "word-counts", work_dir)
    kept = drop_stop_words(counts, stop_words)
    return kept, stop_word_report(counts, stop_words, list(by)), top_words(kept, by=by)


def word_weights(reviews: DataFrame, clusters: DataFrame, text: str = "reviews_u", **options) -> DataFrame:
    """``category, word, avg_tfidf`` of one review side."""
    known = clusters.select("imdb_id", "category").where(
        F.col("imdb_id").isNotNull() & F.col("category").isNotNull()
    )
    texts = reviews.select("imdb_id", text).where(F.col("imdb_id").isNotNull())
    return avg_tfidf(texts.join(not_broadcast(known), "imdb_id"), text, ["category"], **options)
