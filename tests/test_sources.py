import pytest
from pyspark.sql import functions as F

from ratingscope import workdir
from ratingscope.operators import listed_files, match_report
from ratingscope.sources import (
    Catalog,
    empty,
    preview,
    read_csv,
    read_parquet,
    read_word_list,
    require_columns,
    small_table,
    write_batches,
    write_csv,
    write_one_csv,
    write_parquet,
    write_quoted_csv,
    write_word_counts,
)

AWKWARD = [("1", 'He said "hi", twice', "line\nbreak"), ("2", None, "tab\there"), ("3", "plain", "back\\slash")]


@pytest.mark.parametrize("writer", [write_csv, write_quoted_csv])
def test_csv_with_quotes_and_breaks(spark, tmp_path, writer):
    df = spark.createDataFrame(AWKWARD, "id string, a string, b string")
    writer(df, f"{tmp_path}/x")
    back = read_csv(spark, f"{tmp_path}/x", multiline=True)
    assert back.columns == ["id", "a", "b"]
    assert sorted(map(tuple, back.collect())) == sorted(AWKWARD)


def test_quoted_csv_quotes_every_field(spark, tmp_path):
    write_quoted_csv(spark.createDataFrame([(1, "a")], "n int, s string"), f"{tmp_path}/x")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/x").collect()]
    assert set(lines) == {'"1","a"', '"n","s"'}


def test_tsv_and_column_choice(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("tconst\taverageRating\tnumVotes\ntt1\t5.5\t10\n")
    df = read_csv(spark, f"{tmp_path}/t.tsv", sep="\t", columns=["numVotes", "tconst"])
    assert df.collect() == [("10", "tt1")]
    with pytest.raises(ValueError, match="nothing"):
        read_csv(spark, f"{tmp_path}/t.tsv", sep="\t", columns=["nothing"])


def test_many_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"id,v\n{i},x\n")
    assert read_csv(spark, str(tmp_path)).count() == 3
    assert read_csv(spark, f"{tmp_path}/*.csv").count() == 3
    assert read_csv(spark, [f"{tmp_path}/part0.csv", f"{tmp_path}/part2.csv"]).count() == 2


def test_parquet_reads_only_the_columns_asked_for(spark, tmp_path):
    write_parquet(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), f"{tmp_path}/p")
    df = read_parquet(spark, f"{tmp_path}/p", ["c"])
    assert df.collect() == [(3,)]
    assert "ReadSchema: struct<c:int>" in df._jdf.queryExecution().executedPlan().toString()


def test_word_list(spark, tmp_path):
    (tmp_path / "words.txt").write_text("The, and ,,AND,  ,of,")
    words = sorted(r.word for r in read_word_list(spark, f"{tmp_path}/words.txt").collect())
    assert words == ["and", "of", "the"]


def test_small_helpers(spark, capsys):
    none = empty(spark, "a int, b string")
    assert none.count() == 0 and none.schema.simpleString() == "struct<a:int,b:string>"
    df = small_table(spark, [(1, "x")], "a int, b string")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="c, d"):
        require_columns(df, ["a", "c", "d"])
    preview(df, 1)
    shown = capsys.readouterr().out
    assert "root" in shown and "|x" in shown


def test_catalog(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), paths={"extra": f"{tmp_path}/e.csv"})
    assert len(catalog.names()) == 19
    assert catalog.path("links").endswith("/links.csv")
    with pytest.raises(KeyError):
        catalog.path("unknown")
    write_csv(spark.createDataFrame([("1", "2")], "tconst string, numVotes string"), catalog.path("imdb_ratings"), "\t")
    (tmp_path / "e.csv").write_text("k\n7\n")
    assert catalog.table("imdb_ratings").collect() == [("1", "2")]
    catalog.register("extra")
    assert spark.sql("SELECT k FROM extra").collect() == [("7",)]


def test_word_count_folders(spark, tmp_path):
    rows = [("c", "x", "a", 3, 4), ("c", "x", "b", 1, 4), ("u", "y", "a", 2, 2)]
    schema = "side string, category string, word string, word_occurrences long, total_word_occurrences long"
    write_word_counts(spark.createDataFrame(rows, schema), f"{tmp_path}/w")
    assert sorted(p.name for p in (tmp_path / "w" / "side=c").iterdir()) == ["category=x"]
    back = read_csv(spark, f"{tmp_path}/w/side=c/category=x")
    assert back.columns == ["word", "word_occurrences", "total_word_occurrences"]
    assert [r.word for r in back.collect()] == ["a", "b"]


def test_word_count_folders_of_empty_categories(spark, tmp_path):
    rows = [("c", "x", "a", 3, 3)]
    schema = "side string, category string, word string, word_occurrences long, total_word_occurrences long"
    write_word_counts(spark.createDataFrame(rows, schema), f"{tmp_path}/w", ["x", "y"])
    folders = sorted(str(p.relative_to(tmp_path / "w")) for p in (tmp_path / "w").glob("*/*") if p.is_dir())
    assert folders == [f"side={s}/category={c}" for s in "cu" for c in "xy"]
    none = read_csv(spark, f"{tmp_path}/w/side=u/category=y")
    assert none.columns == ["word", "word_occurrences", "total_word_occurrences"] and none.count() == 0
    assert [(r.word, r.side, r.category) for r in read_csv(spark, f"{tmp_path}/w").collect()] == [("a", "c", "x")]


def test_batch_folders(spark, tmp_path):
    df = spark.range(5).withColumn("part", F.ceil((F.col("id") + 1) / 2).cast("int"))
    write_batches(df, f"{tmp_path}/b")
    assert sorted(p.name for p in (tmp_path / "b").glob("part=*")) == ["part=1", "part=2", "part=3"]
    assert read_csv(spark, f"{tmp_path}/b/part=3").collect() == [("4",)]


def test_shared_folder_comes_from_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workdir.work_root(spark) == shared
    df = workdir.materialized(spark.range(3), "t")
    assert df.count() == 3
    assert all(f"{shared}/ratingscope/t-" in path for path in df.inputFiles())


def test_without_a_shared_folder_the_warehouse_holds_it():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, *default):
                return default[0] if default else "hdfs://host/warehouse"

    assert workdir.work_root(Session()) == "hdfs://host/warehouse/_work"


@pytest.mark.parametrize(("master", "warehouse", "fails"), [("spark://h:7077", "file:/home/x/wh", True), ("yarn", "/home/x/wh", True), ("local[2]", "file:/home/x/wh", False), ("yarn", "s3a://b/wh", False)])
def test_a_warehouse_on_one_machine_is_an_error_on_a_cluster(master, warehouse, fails):
    class Session:
        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, *default: default[0] if default else warehouse)

    Session.sparkContext.master = master
    if fails:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workdir.work_root(Session())
    else:
        assert workdir.work_root(Session()) == warehouse + "/_work"


def test_work_folder_is_gone_after_the_job(spark, tmp_path):
    with workdir.work_folder(spark, str(tmp_path)) as folder:
        df = workdir.materialized(spark.range(3), "t")
        assert all(folder in path for path in df.inputFiles()) and df.count() == 3
    assert list(tmp_path.iterdir()) == []


def test_quoted_fields_survive_without_multiline(spark, tmp_path):
    rows = [("tt1", 'Say "Hi", Bob'), ("tt2", "back\\slash, \\\"x"), ("tt3", '"'), ("tt4", "a,b")]
    df = spark.createDataFrame(rows, "id string, title string")
    write_csv(df, f"{tmp_path}/q")
    assert sorted(map(tuple, read_csv(spark, f"{tmp_path}/q").collect())) == rows


def test_other_columns_are_an_error(spark, tmp_path):
    for name, head in (("a", "id,title"), ("b", "title,id")):
        (tmp_path / "m").mkdir(exist_ok=True)
        (tmp_path / "m" / f"{name}.csv").write_text(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, f"{tmp_path}/m").collect()


def test_a_file_without_line_breaks_is_split(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "repeat('x', 20) as t").coalesce(1).write.option("header", True).csv(f"{tmp_path}/s")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
        assert read_csv(spark, f"{tmp_path}/s").rdd.getNumPartitions() > 3
        assert read_csv(spark, f"{tmp_path}/s", multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_word_list_is_freed_of_all_white_space(spark, tmp_path):
    (tmp_path / "w.txt").write_text("the,\tAnd , of\u00a0,,the")
    assert sorted(r.word for r in read_word_list(spark, f"{tmp_path}/w.txt").collect()) == ["and", "of", "the"]


@pytest.mark.parametrize("rows", [0, 1, 500])
def test_one_file_with_one_header(spark, tmp_path, rows):
    """Written by several tasks, in their order; what was there is replaced; no parts stay."""
    df = spark.range(rows, numPartitions=4).selectExpr("id", """concat('a "', id, '"\n, b') as `te"xt`""")
    for _ in range(2):
        write_one_csv(df, f"{tmp_path}/one.csv")
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.csv"]
    text = (tmp_path / "one.csv").read_text()
    assert text.startswith('"id","te""xt"\n') and text.count("te\"\"xt") == 1
    back = read_csv(spark, f"{tmp_path}/one.csv", multiline=True)
    assert [tuple(r) for r in back.collect()] == [(str(i), f'a "{i}"\n, b') for i in range(rows)]


def test_files_are_counted_by_listing(spark, tmp_path):
    write_csv(spark.range(10, numPartitions=3).toDF("id"), f"{tmp_path}/x")
    for name, text in (("empty.csv", ""), ("header.csv", "id\n")):
        (tmp_path / "x" / name).write_text(text)
    (tmp_path / "none").mkdir()
    assert listed_files(spark, f"{tmp_path}/x").first().files == 5
    assert listed_files(spark, f"{tmp_path}/none").first().files == 0
    rows = read_csv(spark, f"{tmp_path}/x")
    report = match_report(rows, rows.withColumn("hit", F.lit(1)), "hit", files=f"{tmp_path}/x").first()
    assert report.asDict() == {"total": 10, "matched": 10, "unmatched": 0, "files": 5}
