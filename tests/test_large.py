"""Work that grows with the tables: by how many tasks and how often they are read."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from driver import queries
from ratingscope.functions import casts
from ratingscope.operators import hot_keys, match, salted_join
from ratingscope.plans import abt, attach_category, category_words, word_weights
from ratingscope.sources import read_csv


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables of one file each."""

    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    save("part", [(i, "hot bolt", f"Brand#{i % 25 + 1}", "SMALL", 1 + i % 9, 900.0 + i) for i in range(60)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    save("lineitem", [(i % 60, 1.0 + i % 7) for i in range(300)], "l_partkey long, l_quantity double")
    save("events", [(i % 50, "purchase" if i % 3 else "view", '{"k": 1}') for i in range(200)], "user_id long, event_type string, props string")
    save("documents", [(i, f'line "{i}"\nand, more', "en" if i % 2 else "de", "web", 16) for i in range(600)], "doc_id long, text string, lang string, source string, n_chars long")
    return str(tmp_path)


def test_one_csv_is_written_by_as_many_tasks_as_the_table_is_read_by(spark, tables, monkeypatch):
    parts = []
    write = queries.write_one_csv
    monkeypatch.setattr(queries, "write_one_csv", lambda df, path: (parts.append(df.rdd.getNumPartitions()), write(df, path)))
    assert queries.roundtrip_one_csv(spark, tables).count() == 600
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "200")
        assert queries.roundtrip_one_csv(spark, tables).count() == 600
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert parts[0] == queries.ONE_CSV_PARTS < parts[1]


def test_multiline_csv_does_not_shuffle_its_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n" + '1,"a\nb"\n' * 50)
    plan = read_csv(spark, f"{tmp_path}/a.csv", multiline=True, parallel=True)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan
    assert not re.search(r"Exchange hashpartitioning\(path#\d+, start#\d+", plan)


def test_dates_equal_those_of_plain_tries(spark):
    texts = [
        "1995-05-25", "1995/05/25", "05/25/1995", "25/05/1995", "1995", "1995-05", "unknown", "", " 1995-05-25", "5/25/1995", "May 5, 1995",
        "September 15, 2001", "5/7/1995", "1995/05/250", "1995/05/025", "12/11/1995", "0012/11/12", "1995-05-25 10:00", "31/02/2001", "-,/", None,
        "+12345-01-02", "12345/01/02", "01/02/12345", "2000/01/100", "1/2-3,4",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    c = F.col("c")
    for parse, formats in ((casts.parse_date, casts.DATE_FORMATS), (casts.parse_month_date, casts.MONTH_DATE_FORMATS)):
        plain = F.coalesce(*[F.try_to_date(c, f) for f in formats])
        assert df.where(~parse(c).eqNullSafe(plain)).collect() == []


def test_dates_without_the_mark_of_a_format_are_not_tried(spark):
    df = spark.createDataFrame([("05/25/1995",)], "c string")
    # A try that fails makes an exception, so it stands behind a test of the text.
    plan = df.select(casts.parse_date(F.col("c")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") >= len(casts.DATE_FORMATS)


def test_movie_files_are_written_by_many_tasks(spark, tables):
    catalog = queries._abt_files(spark, tables)
    for name in ("links", "rotten_tomatoes_movies", "netflix", "credits", "movies_metadata"):
        found = glob.glob(f"{catalog.path(name)}/part-*".removeprefix("file:"))
        assert name == "movies_metadata" or len(found) > 1, name
        assert catalog.table(name).count() == 60


def _broadcast_joins(df):
    """The broadcast joins of a plan, without those of the pieces of multi-line files: one row for each."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in re.findall(r"Broadcast(?:HashJoin|NestedLoopJoin)[^\n]*", plan) if "_start#" not in x]


def test_movie_table_broadcasts_no_table(spark, tables, monkeypatch):
    """Small files may hold many rows, so what Spark reckons from their size does not send them to the driver."""
    found, names = [], []

    def seen(write):
        return lambda df, name, *more, **options: (names.append(name), found.extend(_broadcast_joins(df)), write(df, name, *more, **options))[-1]

    monkeypatch.setattr(abt, "materialized", seen(abt.materialized))
    monkeypatch.setattr(match, "written", seen(match.written))
    monkeypatch.setattr(queries, "write_csv", seen(queries.write_csv))
    result = queries.movie_table(spark, tables)
    assert result.count() == 60 and {"abt-base", "match-left", "match-best"} <= set(names)
    assert found + _broadcast_joins(result) == []


def test_salted_join_broadcasts_neither_side(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    hot = hot_keys(rows, ["k"], rows=5)
    for how in ("inner", "left"):
        joined = salted_join(rows, rows.withColumn("n", F.lit(1)), ["k"], None, spread_left=["k"], how=how)
        assert _broadcast_joins(joined) == []
    plan = salted_join(rows, rows.withColumn("n", F.lit(1)), ["k"], hot, spread_left=["k"])
    assert all("_hot_k" in x for x in _broadcast_joins(plan))


def test_classes_of_movies_are_not_broadcast(spark, tmp_path):
    """The list of classes has a row for each movie."""
    spark.createDataFrame([("tt1", "a"), ("tt2", "b"), (None, "c")], "imdb_id string, category string").write.parquet(f"{tmp_path}/classes")
    classes = spark.read.parquet(f"{tmp_path}/classes")
    reviews = spark.createDataFrame([("tt1", "t", "good film", None), ("tt3", "t", None, "bad")], "imdb_id string, title string, reviews_c string, reviews_u string")
    merged = attach_category(reviews, classes)[0]
    assert _broadcast_joins(merged) == []
    assert sorted((r.imdb_id, r.category) for r in merged.collect()) == [("tt1", "a"), ("tt3", None)]
    joined = [x for df in (category_words(reviews, classes), word_weights(reviews, classes, "reviews_c")) for x in _broadcast_joins(df)]
    assert not any("imdb_id" in x for x in joined)
