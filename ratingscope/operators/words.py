"""Word statistics of critic and audience reviews."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH
from ..functions.text import clean_review, is_word, pieces_of, words_of
from ..sources.readers import small_table
from .dedupe import first_rows

# Fixed value: words shown per (side, category).
TOP_WORDS = 100
# Fixed value: removed words shown.
SAMPLE_ROWS = 20


def count_words(
    reviews: DataFrame,
    *,
    category: str = "category",
    critic: str = "reviews_c",
    audience: str = "reviews_u",
    mode: str = "independent",
    glue: bool = True,
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """``side, category, word, word_occurrences``.

    ``independent`` counts each side on its own. ``paired`` gives the counts of
    critic words x audience words of the same row: a word counts once for every
    word of the other side, and a row with one side empty counts nothing. The
    products are sums of weights; no pair is ever formed.
    """
    if mode not in ("independent", "paired"):
        raise ValueError(f"unknown mode {mode!r}")
    stop_words = list(stop_words)
    texts = {"c": clean_review(F.col(critic), glue), "u": clean_review(F.col(audience), glue)}
    if mode == "independent":
        pieces = {side: pieces_of(text) for side, text in texts.items()}
        weights = {side: F.lit(1) for side in texts}
    else:
        pieces = {side: words_of(text, stop_words) for side, text in texts.items()}
        weights = {"c": F.size("u"), "u": F.size("c")}
    rows = reviews.select(F.col(category).alias("category"), *[p.alias(s) for s, p in pieces.items()])
    sides = [
        F.struct(F.lit(s).alias("side"), F.col(s).alias("pieces"), weights[s].cast("long").alias("weight"))
        for s in texts
    ]
    words = (
        rows.select("category", F.explode(F.array(*sides)).alias("s"))
        .where("s.weight > 0")
        .select("s.side", "category", "s.weight", F.explode("s.pieces").alias("word"))
        .where(is_word(F.col("word"), stop_words))
    )
    return words.groupBy("side", "category", "word").agg(F.sum("weight").alias("word_occurrences"))


def with_totals(counts: DataFrame) -> DataFrame:
    """``total_word_occurrences`` of each (side, category) on every row.

    The totals have one row per side and category; adaptive execution broadcasts
    them once it has seen their size.
    """
    totals = counts.groupBy("side", "category").agg(
        F.sum("word_occurrences").alias("total_word_occurrences")
    )
    return counts.join(totals, ["side", "category"]).select(
        "side", "category", "word", "word_occurrences", "total_word_occurrences"
    )


def word_totals(counts: DataFrame, categories: Iterable[str]) -> DataFrame:
    """``side, category, total_word_occurrences`` of both sides and all named categories, 0 if empty."""
    pairs = [(side, c) for c in categories for side in ("c", "u")]
    known = small_table(counts.sparkSession, pairs, "side string, category string")
    none = known.withColumn("word_occurrences", F.lit(0).cast("long"))
    both = counts.select("side", "category", "word_occurrences").unionByName(none)
    return both.groupBy("side", "category").agg(F.sum("word_occurrences").alias("total_word_occurrences"))


def word_frequency(reviews: DataFrame, **options) -> DataFrame:
    """:func:`count_words` with the total of the side and category on every row."""
    return with_totals(count_words(reviews, **options))


def _listed(words: DataFrame, word: str) -> Column:
    return F.lower(F.col(word)) == words["_stop"]


def _stop(stop_words: DataFrame) -> DataFrame:
    return stop_words.select(F.lower("word").alias("_stop")).distinct()


def drop_stop_words(counts: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """Rows whose word is not on the list, in any case; a null word stays."""
    stop = _stop(stop_words)
    return counts.join(stop, _listed(stop, word), "left_anti")


def removed_words(counts: DataFrame, stop_words: DataFrame, word: str = "word") -> DataFrame:
    """The rows that :func:`drop_stop_words` takes out."""
    stop = _stop(stop_words)
    return counts.join(stop, _listed(stop, word), "left_semi")


def removed_sample(
    counts: DataFrame,
    stop_words: DataFrame,
    n: int = SAMPLE_ROWS,
    by: Iterable[str] = ("side", "category"),
    weight: str = "word_occurrences",
) -> DataFrame:
    """The first ``n`` removed rows: by group, heaviest word first."""
    return first_rows(removed_words(counts, stop_words), [*by, F.desc(weight), "word"], n)


def drop_tagged_words(
    words: DataFrame, tags: DataFrame, dropped: Iterable[str] = ("ADJ", "JJ", "JJR", "JJS")
) -> DataFrame:
    """Words not tagged as adjective in a ``(word, tag)`` table, in any case."""
    bad = tags.where(F.col("tag").isin(list(dropped)))
    return drop_stop_words(words, bad)


def top_words(
    counts: DataFrame,
    weight: str = "word_occurrences",
    n: int = TOP_WORDS,
    by: Iterable[str] = ("side", "category"),
) -> DataFrame:
    """The ``n`` heaviest words of each group, with ``rank`` and weight relative to the first.

    Spark keeps the first ``n`` of each group in each task before the shuffle.
    """
    by = list(by)
    ranked = Window.partitionBy(*by).orderBy(F.desc(weight), F.asc("word"))
    best = counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)
    heaviest = F.max(weight).over(Window.partitionBy(*by))
    return best.withColumn("relative_weight", F.col(weight) / heaviest)


def avg_tfidf(
    rows: DataFrame,
    text: str,
    by: Iterable[str] = (),
    *,
    glue: bool = True,
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """Mean TF-IDF of each word over the rows that hold it: ``word``, ``avg_tfidf``.

    tf is the count in the row, idf = ln((rows + 1) / (rows with the word + 1)), both
    within the ``by`` group. As idf is fixed per word, the mean needs only the total
    count and the number of rows: one aggregation by word, never by row and word.
    """
    kept = list(by)
    by = kept or ["_all"]
    if not kept:
        rows = rows.withColumn("_all", F.lit(1))
    # In the sorted words of a row, the first of each run stands for the document.
    sorted_words = F.sort_array(pieces_of(clean_review(F.col(text), glue))).alias("_words")
    words = rows.select(*by, sorted_words).select(*by, "_words", F.posexplode("_words").alias("_at", "word"))
    is_first = (F.col("_at") == 0) | (F.get("_words", F.col("_at") - 1) != F.col("word"))
    counts = (
        words.where(is_word(F.col("word"), list(stop_words)))
        .groupBy(*by, "word")
        .agg(F.count(F.lit(1)).alias("_hits"), F.count_if(is_first).alias("_docs"))
    )
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = sizes.select(*[F.col(b).alias(f"_of_{b}") for b in by], "_rows")
    same = reduce(and_, [F.col(b).eqNullSafe(F.col(f"_of_{b}")) for b in by])
    idf = F.log((F.col("_rows") + 1) / (F.col("_docs") + 1))
    weights = counts.join(sizes, same).withColumn("avg_tfidf", F.col("_hits") / F.col("_docs") * idf)
    return weights.select(*kept, "word", "avg_tfidf")
