"""Sinks. All replace what is at the path and write in parallel."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """A CSV directory with header; doubled quotes inside quoted fields."""
    writer = df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
    writer.option("sep", sep).option("quote", '"').option("escape", '"').csv(path)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """A CSV directory with every field quoted."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .csv(path)
    )


def write_one_csv(df: DataFrame, path: str) -> None:
    """One CSV file with every field quoted, at ``path`` itself.

    Tasks write the rows in parallel as parts without headers, next to the file. The file system
    then joins header and parts in order: by its own ``concat`` where it has one, which moves no
    bytes, else by streams. No task and no driver memory holds the rows. A reader never sees half
    a file, as the joined one takes its name at the end.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    parts = jvm.org.apache.hadoop.fs.Path(f"{path}.parts-{uuid.uuid4().hex}")
    try:
        options = {"encoding": "UTF-8", "quote": '"', "escape": '"', "quoteAll": True}
        df.write.options(**options).option("header", False).csv(parts.toString())
        joined = jvm.org.apache.hadoop.fs.Path(parts, "_joined")
        names = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
        out = system.create(joined, True)
        out.write(bytearray((names + "\n").encode("utf-8")))
        out.close()
        found = [f.getPath() for f in system.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen() > 0]
        _append(spark, system, joined, sorted(found, key=lambda p: p.getName()))
        system.delete(target, True)
        if not system.rename(joined, target):
            raise OSError(f"could not name the joined file {path}")
    finally:
        system.delete(parts, True)


def _append(spark: SparkSession, system, joined, parts: list) -> None:
    """The bytes of ``parts`` after those of ``joined``."""
    if not parts:
        return
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
    for i, part in enumerate(parts):
        array[i] = part
    try:
        system.concat(joined, array)
        return
    except UnsupportedOperationException:
        pass
    # Without concat: all bytes go once through streams, to a new file.
    head = jvm.org.apache.hadoop.fs.Path(joined.getParent(), "_head")
    system.rename(joined, head)
    out = system.create(joined, True)
    try:
        for part in [head, *parts]:
            source = system.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            finally:
                source.close()
    finally:
        out.close()


def write_word_counts(counts: DataFrame, path: str, categories: Iterable[str] = ()) -> None:
    """Word counts below ``side=../category=..``, most frequent word first.

    Ranges, not hashes, spread the rows: one big category fills several tasks. Each side of
    a named category gets its folder even if it has no words: a file with the header alone.
    """
    order = ["side", "category", F.desc("word_occurrences"), "word"]
    (
        counts.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("side", "category")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    spark = counts.sparkSession
    columns = counts.drop("side", "category").schema
    for category in categories:
        for side in ("c", "u"):
            folder = f"{path}/side={side}/category={category}"
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
                write_csv(spark.createDataFrame([], columns), folder)


def write_batches(batches: DataFrame, path: str) -> None:
    """Numbered batches below ``part=1``, ``part=2``, ..."""
    (
        batches.write.mode("overwrite")
        .partitionBy("part")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def preview(df: DataFrame, rows: int = 5) -> None:
    """Schema and first rows on the console."""
    df.printSchema()
    df.show(rows, truncate=False)
