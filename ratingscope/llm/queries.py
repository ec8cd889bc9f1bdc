"""The driver's queries for the operators of this folder, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, classifier, divergence, gnat, lines, mixing, pages, repeats, samples, secrets, simhash, toxicity, warc

VOCABULARY = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, folder, "labels"), folds=5, fold=0)
    scored = docs.select("doc_id", toxicity.toxicity(F.col("text"), model).alias("t"))
    held = samples.held_out(F.col("doc_id"), 5, 0)
    return scored.select("doc_id", held.alias("held_out"), F.col("t.score").alias("score"), (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.size("t.passages").alias("n_passages"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    base = secrets.joined(F.col("base"))
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(base, 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op3_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_table(spark, folder, "embeddings"))


def op4_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return lines.quality_rules(docs, lines.fit_lines(docs, _table(spark, folder, "labels")))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    both = _table(spark, folder, "documents").select("doc_id", bpe.encode_and_decode(F.col("text"), path, pattern).alias("b")).select("doc_id", "b.*")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_html(spark: SparkSession, folder: str) -> DataFrame:
    table = _table(spark, folder, "pages")
    model = pages.fit_labeller(table)
    return table.select("page_id", "url", pages.main_text(F.col("html"), model).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = classifier.fit_quality(docs, _table(spark, folder, "labels"), folds=3, fold=1)
    scored = docs.select("doc_id", classifier.quality(F.col("text"), F.col("n_chars"), model).alias("score"))
    held = samples.held_out(F.col("doc_id"), 3, 1)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_vectors(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = gnat.compress(_table(spark, folder, "embeddings"))
    return gnat.with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, folder, "documents"))


def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_secrets, op3_ann, op4_lines, op5_bpe, op6_warc, op7_html, op8_simhash, op9_mixing, op10_classifier, op11_vectors, op12_divergence, op13_repeats)}

# What SQL can express; the others are tested against brute force in tests/llm.
ORACLE = {
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE octet_length(b) >= 100 GROUP BY d)
SELECT p.page_id, octet_length(b)::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NULL OR p.page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NOT NULL AND p.page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
""",
    "op9_mixing": mixing.SQL,
    "op11_vectors": gnat.SQL,
    "op12_divergence": divergence.SQL,
    "op13_repeats": repeats.SQL,
}
