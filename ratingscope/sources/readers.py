"""Scans. Text files are read as strings only; types come later."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from .records import read_records


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = ",",
    multiline: bool = False,
    escape: str = '"',
    columns: Sequence[str] | None = None,
    parallel: bool = False,
) -> DataFrame:
    """CSV or TSV with a header: one file, a directory, a glob or a list of them.

    Quotes inside quoted fields are doubled, as the writers of this package write them;
    ``escape`` names another mark (a backslash, say). ``multiline=True`` also reads line
    breaks inside fields. Such a file is one task; with ``parallel=True`` it is cut into records
    by many (see :mod:`.records`; doubled quotes only, and without file metadata). A file whose
    header differs from the first one's is an error, not a shift.
    """
    if parallel and (not multiline or escape != '"'):
        raise ValueError("parallel is for multiline files with doubled quotes")
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    reader = reader.option("quote", '"').option("escape", escape).option("multiLine", multiline)
    df = reader.csv(path)
    if parallel:
        df = read_records(spark, path, df.columns, sep)
        return df if columns is None else require_columns(df, columns).select(*columns)
    # With the schema given, every file's header is held against it.
    df = reader.schema(df.schema).option("enforceSchema", False).csv(path)
    if columns is not None:
        require_columns(df, columns)
        df = df.select(*columns)
    return df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated words, trimmed, lower-case, each once; column ``word``."""
    words = spark.read.text(path).select(F.explode(F.split("value", ",")).alias("word"))
    words = words.select(F.lower(strip(F.col("word"))).alias("word"))
    return words.where(F.col("word") != "").distinct()


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def small_table(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A few local rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``df`` itself, or an error that lists the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
