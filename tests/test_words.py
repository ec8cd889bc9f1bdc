import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingscope import operators as op
from ratingscope.functions.stopwords import ENGLISH
from ratingscope.plans import category_words, clean_word_table, word_weights

VOCABULARY = ["The", "is", "film", "plot", "good", "bad", "don't", "slow-burn", "", "1994", "\n"]


def reviews(seed, n=60):
    rng = random.Random(seed)

    def text():
        if rng.random() < 0.15:
            return rng.choice([None, "", "[]", "['the', 'is']"])
        return "['" + " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, 12))) + "']"

    return [(f"t{rng.randint(0, 9)}" if rng.random() > 0.1 else None, f"T{i}", text(), text()) for i in range(n)]


CLUSTERS = [(f"t{i}", f"class{i % 3}") for i in range(8)] + [("t1", "class2"), (None, "class0"), ("t9", None)]


def tokens(text):
    kept = "".join(c for c in (text or "") if c.isascii() and (c.isalnum() or c.isspace()))
    return [w for w in kept.lower().split() if w not in ENGLISH]


def expected(rows, mode):
    counts = Counter()
    for imdb_id, _, c, u in rows:
        for key, category in CLUSTERS:
            if imdb_id is None or category is None or key != imdb_id:
                continue
            cw, uw = tokens(c), tokens(u)
            if mode == "paired":
                for a in cw:
                    for b in uw:
                        counts["c", category, a] += 1
                        counts["u", category, b] += 1
            else:
                counts.update([("c", category, a) for a in cw] + [("u", category, b) for b in uw])
    totals = Counter()
    for (side, category, _), n in counts.items():
        totals[side, category] += n
    return sorted((s, k, w, n, totals[s, k]) for (s, k, w), n in counts.items())


@pytest.mark.parametrize("mode", ["independent", "paired"])
@pytest.mark.parametrize("seed", [1, 2])
def test_category_words(spark, mode, seed):
    rows = reviews(seed)
    df = spark.createDataFrame(rows, "imdb_id string, title string, reviews_c string, reviews_u string")
    clusters = spark.createDataFrame(CLUSTERS, "imdb_id string, category string")
    got = category_words(df, clusters, mode=mode)
    assert got.columns == ["side", "category", "word", "word_occurrences", "total_word_occurrences"]
    assert sorted(map(tuple, got.collect())) == expected(rows, mode)


def test_unknown_mode(spark):
    df = spark.createDataFrame([("x", "a", "b")], "category string, reviews_c string, reviews_u string")
    with pytest.raises(ValueError):
        op.word_frequency(df, mode="both")


COUNTS = [("c", "x", "The", 5), ("c", "x", "film", 7), ("c", "x", None, 1), ("u", "x", "plot", 2), ("u", "y", "the", 3)]
SCHEMA = "side string, category string, word string, word_occurrences long"


def test_stop_words(spark):
    counts = spark.createDataFrame(COUNTS, SCHEMA)
    listed = spark.createDataFrame([("THE",), ("of",), ("the",)], "word string")
    kept, report, top = clean_word_table(counts, listed)
    assert sorted((r.word or "", r.side) for r in kept.collect()) == [("", "c"), ("film", "c"), ("plot", "u")]
    assert sorted((r.word, r.side) for r in op.removed_words(counts, listed).collect()) == [("The", "c"), ("the", "u")]
    assert sorted(map(tuple, report.collect()), key=str) == sorted(
        [("c", "x", 3, 2, 1), ("u", "x", 1, 1, 0), ("u", "y", 1, 0, 1), (None, None, 5, 3, 2)], key=str
    )
    assert {(r.side, r.word): (r.rank, round(r.relative_weight, 6)) for r in top.collect()} == {
        ("c", "film"): (1, 1.0), ("c", None): (2, round(1 / 7, 6)), ("u", "plot"): (1, 1.0)
    }


def test_top_words_are_pruned_before_the_shuffle(spark):
    counts = spark.range(5000).select(
        F.substring(F.lit("c"), 1, F.greatest("id", F.lit(1)).cast("int")).alias("side"),
        F.lit("x").alias("category"),
        F.concat(F.lit("w"), "id").alias("word"), (F.col("id") % 100).alias("word_occurrences"),
    )
    best = op.top_words(counts)
    assert best.count() == 100
    assert best.agg(F.min("word_occurrences")).first()[0] == 98
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_tagged_words(spark):
    words = spark.createDataFrame([("Red",), ("run",), ("big",), ("bigger",)], "word string")
    tags = spark.createDataFrame([("red", "ADJ"), ("run", "VB"), ("BIG", "JJ"), ("bigger", "JJR")], "word string, tag string")
    assert [r.word for r in op.drop_tagged_words(words, tags).collect()] == ["run"]


def tfidf(texts):
    docs = [Counter(tokens(t)) for t in texts]
    df = Counter(w for d in docs for w in d)
    sums = Counter()
    for d in docs:
        for w, n in d.items():
            sums[w] += n * math.log((len(docs) + 1) / (df[w] + 1))
    return {w: round(s / df[w], 9) for w, s in sums.items()}


def test_tfidf(spark):
    rows = reviews(5)
    df = spark.createDataFrame(rows, "imdb_id string, title string, reviews_c string, reviews_u string")
    got = {r.word: round(r.avg_tfidf, 9) for r in op.avg_tfidf(df, "reviews_u").collect()}
    assert got == tfidf([r[3] for r in rows])
    clusters = spark.createDataFrame([("t1", "x"), ("t2", "x"), ("t3", "y")], "imdb_id string, category string")
    got = {(r.category, r.word): round(r.avg_tfidf, 9) for r in word_weights(df, clusters).collect()}
    want = {
        (k, w): v
        for k, ids in (("x", ("t1", "t2")), ("y", ("t3",)))
        for w, v in tfidf([r[3] for r in rows if r[0] in ids]).items()
    }
    assert got == want


def test_totals_of_empty_categories(spark):
    counts = spark.createDataFrame([("c", "x", "a", 3), ("c", "x", "b", 1)], "side string, category string, word string, word_occurrences long")
    got = {(r.side, r.category): r.total_word_occurrences for r in op.word_totals(counts, ["x", "y"]).collect()}
    assert got == {("c", "x"): 4, ("u", "x"): 0, ("c", "y"): 0, ("u", "y"): 0}
