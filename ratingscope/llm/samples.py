"""Bounded samples of labelled rows for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workdir import materialized

# Labelled rows a model is fitted on, about.
ROWS = 20_000


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept from fitting; false for rows without an id."""
    return F.coalesce(fold_of(doc_id, folds) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, *, folds: int, fold: int, rows: int = ROWS, work_dir: str | None = None) -> DataFrame:
    """About ``rows`` labelled documents outside ``fold``: ``text, n_chars, label, part``.

    The share that gives ``rows`` of them is chosen by a hash of the id, so a rerun chooses
    alike, and only the chosen ids (a bounded list) are broadcast. ``part`` is 0 to 9, a
    second hash of the id. Of rows that repeat an id one text stays; an id with two labels
    has the larger one.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id"), folds, fold))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.length("text").cast("long")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), n_chars.alias("n_chars")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min(F.struct("text", "n_chars", "label")).alias("one"))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10)).alias("part")
    return materialized(one.select("one.*", part), f"sample-{label}", work_dir)
