"""Counts that describe a run: reviews per movie, matches, removed words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_positive, resolve_columns
from ..sources.readers import empty
from .words import _stop

REVIEW_SCHEMA = "imdb_id string, rev_count int, rev_pos_share double, rev_avg_len double"


def review_aggregates(reviews: DataFrame) -> DataFrame:
    """Reviews, share of positive ones and mean length per ``imdb_id``.

    Column names may be in any case. A source without ``imdb_id`` gives the empty
    table, so that a left join leaves nulls.
    """
    if "imdb_id" not in [c.lower() for c in reviews.columns]:
        return empty(reviews.sparkSession, REVIEW_SCHEMA)
    reviews = resolve_columns(reviews, ["imdb_id", "review", "sentiment"])
    return reviews.groupBy("imdb_id").agg(
        F.count(F.lit(1)).cast("int").alias("rev_count"),
        F.avg(is_positive(F.col("sentiment"))).alias("rev_pos_share"),
        F.avg(F.length("review")).alias("rev_avg_len"),
    )


def match_report(rows: DataFrame, merged: DataFrame, matched: str, files: bool | str | list[str] = False) -> DataFrame:
    """One row: ``total`` rows before the join; ``matched``, ``unmatched`` after it.

    ``files=True`` adds the number of files that hold rows, for a table read straight from files.
    A path or a list of paths adds the number of files there, empty ones included.
    """
    if not isinstance(files, bool):
        both = match_report(rows, merged, matched).unionByName(listed_files(rows.sparkSession, files), allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in ("total", "matched", "unmatched", "files")])
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    from_file = F.col("_metadata.file_path") if files else F.lit(None).cast("string")
    before = rows.select(one.alias("total"), zero.alias("matched"), zero.alias("unmatched"), from_file.alias("_file"))
    hit = F.col(matched).isNotNull().cast("long")
    after = merged.select(
        zero.alias("total"), hit.alias("matched"), (one - hit).alias("unmatched"), F.lit(None).cast("string").alias("_file")
    )
    sums = [F.coalesce(F.sum(c), zero).alias(c) for c in ("total", "matched", "unmatched")]
    return before.unionAll(after).agg(*sums, *([F.count_distinct("_file").alias("files")] if files else []))


def file_report(rows: DataFrame) -> DataFrame:
    """One row: ``files`` that hold rows. For a table read straight from files."""
    return rows.select(F.col("_metadata.file_path").alias("file")).agg(
        F.count_distinct("file").alias("files")
    )


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row: ``files`` at a path, whatever they hold.

    They come from the list of names that any scan makes. No file is opened, and empty ones,
    which scans leave out, count.
    """
    names = spark.read.format("binaryFile").load(path).inputFiles()
    return spark.range(1).select(F.lit(len(names)).cast("long").alias("files"))


def stop_word_report(
    counts: DataFrame, stop_words: DataFrame, by: list[str], word: str = "word"
) -> DataFrame:
    """Rows ``before``, ``after`` and ``removed`` per group, and overall with nulls in ``by``."""
    stop = _stop(stop_words).withColumn("_hit", F.lit(True))
    marked = counts.join(stop, F.lower(F.col(word)) == stop["_stop"], "left")
    removed = F.count_if(F.col("_hit").isNotNull())
    sizes = marked.groupBy(*by).agg(F.count(F.lit(1)).alias("before"), removed.alias("removed"))
    whole = sizes.groupingSets([[F.col(c) for c in by], []], *by).agg(
        F.sum("before").alias("before"), F.sum("removed").alias("removed")
    )
    return whole.select(*by, "before", (F.col("before") - F.col("removed")).alias("after"), "removed")
