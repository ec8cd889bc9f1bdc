"""A training-data pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``documents``.

Edge cases. Rows travel as one struct beside what a stage adds, so further columns of any name
come through unchanged (the last stage has columns of its own). Null and empty texts are not
toxic, hold no secrets and no words, so the mix takes them zero to three times like any other
document of their source; all of them are one near-duplicate group, of which one stays. Rows
without a doc_id are compared like others and dropped sooner than rows with one. Repeated rows of one
doc_id and text become one row. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingscope.llm import bpe, mixing, secrets, simhash, toxicity
from ratingscope.llm.queries import VOCABULARY
from ratingscope.workdir import materialized


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5, by a model fitted on the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels, folds=5, fold=0)
    return docs.where(toxicity.toxicity(F.col("text"), model)["score"] < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; ``n_chars`` follows the new text."""
    spans = secrets.scan_secrets(docs).where(F.size("spans") > 0).select("doc_id", "text_hash", "spans").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("row_hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
    text = secrets.redacted(F.col("row.text"), F.col("spans"))
    joined = rows.join(spans, same, "left").select("row", "spans", F.when(F.col("spans").isNotNull(), text).alias("new"))
    marked = F.col("row").withField("text", F.col("new")).withField("n_chars", F.length("new").cast("long"))
    return joined.select(F.when(F.col("spans").isNull(), F.col("row")).otherwise(marked).alias("row")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed = mixing.mix_sources(docs).where("copies > 0").select("doc_id", "source", "row_hash", "copies").distinct()
    rows = docs.select(F.struct("*").alias("row"), mixing.random_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("row_hash"))
    taken = rows.join(mixed, same).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    both = docs.select("doc_id", "source", "lang", "text", bpe.encode_and_decode(F.col("text"), path, pattern).alias("b")).select("*", "b.*")
    same = F.coalesce("text", F.lit("")).cast("binary") == F.col("decoded")
    return both.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("exact"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_copies), ("secret_scans", redact_secrets), ("mixing", mix), ("bpe", encode)]

# SQL cannot express the stages; tests/llm/test_other_ops.py checks every stage and run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
