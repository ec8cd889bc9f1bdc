"""Plain forms of rewritten operators, to measure the rewrites against."""

from __future__ import annotations

import ast

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratingscope import functions as rf
from ratingscope.functions.text import words_of
from ratingscope.operators import keep_one
from ratingscope.operators.batches import BATCH_ROWS

from .queries import _credit_texts, _part_titles, table


def or_join(spark, sf):
    links = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    movies = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") * 2).alias("first_key"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("second_key"),
        "c_name",
    )
    either = (F.col("o_orderkey") == F.col("first_key")) | (F.col("o_custkey") == F.col("second_key"))
    return links.join(movies, either, "left")


def title_match(spark, sf):
    left, right = _part_titles(spark, sf)
    left = left.withColumn("a", rf.title_tokens(F.col("title")))
    right = right.withColumn("b", rf.title_tokens(F.col("found_title")))
    score = rf.match_score(
        rf.jaccard(F.col("a"), F.col("b")), rf.year_score(F.col("year"), F.col("found_year"))
    )
    pairs = left.join(right, F.abs(F.col("year") - F.col("found_year")) <= 1)
    scored = pairs.withColumn("match_score", score).where(F.col("match_score") >= 0.7)
    best = keep_one(scored, "p_partkey", [F.desc("match_score"), "found_title", "found_id"])
    return best.select("p_partkey", "found_title", "found_year", "found_id", "match_score")


def word_freq_paired(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("u"))
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("c")
    )
    words = asked.join(answered, ["conv_id", "turn"]).select(
        "turn", words_of(rf.clean_review(F.col("c"))).alias("cw"), words_of(rf.clean_review(F.col("u"))).alias("uw")
    )
    pairs = words.select("turn", "uw", F.explode("cw").alias("c_word")).select(
        "turn", "c_word", F.explode("uw").alias("u_word")
    )
    critic = pairs.groupBy("turn", F.col("c_word").alias("word")).count()
    return critic.unionAll(pairs.groupBy("turn", F.col("u_word").alias("word")).count())


def tfidf(spark, sf):
    """One group per document and word, then one per word."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    words = docs.select("doc_id", "lang", F.explode(words_of(rf.clean_review(F.col("text")))).alias("word"))
    counts = words.groupBy("lang", "doc_id", "word").agg(F.count(F.lit(1)).alias("tf"))
    held = counts.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("docs"))
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    idf = F.log((F.col("rows") + 1) / (F.col("docs") + 1))
    weighed = counts.join(held, ["lang", "word"]).join(sizes, "lang").withColumn("w", F.col("tf") * idf)
    return weighed.groupBy("lang", "word").agg(F.avg("w").alias("avg_tfidf"))


def batches(spark, sf):
    """One window over the whole table."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    at = F.row_number().over(Window.orderBy("o_custkey", "o_orderkey"))
    return orders.withColumn("part", F.floor((at - 1) / BATCH_ROWS).cast("int") + 1)


def credits(spark, sf):
    """A row-at-a-time Python function over the list text."""

    @F.udf("struct<cast:array<string>,directors:array<string>,writers:array<string>,producers:array<string>>")
    def read(cast, crew):
        actors = sorted(ast.literal_eval(cast), key=lambda a: a["order"])[:5]
        jobs = [(p["job"].lower(), p["name"].strip()) for p in ast.literal_eval(crew)]
        writes = [n for j, n in jobs if "writer" in j or "screenplay" in j]
        produces = [n for j, n in jobs if "producer" in j and "writer" not in j and "screenplay" not in j]
        return [a["name"] for a in actors], [n for j, n in jobs if j == "director"], writes, produces

    return _credit_texts(spark, sf).select("id", read("cast", "crew").alias("people"))


NAIVE = {
    "q_or_join": or_join, "q_title_match": title_match, "q_word_freq_paired": word_freq_paired,
    "q_tfidf": tfidf, "q_batches": batches, "q_credits": credits,
}
