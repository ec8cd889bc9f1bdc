"""Run driver queries and their SQL side by side.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, db, query, sql, folder):
    """Differences as text, empty if both results are equal."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return ("" if got else "no rows"), sum(got.values())
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", sum(got.values())
    if got != expected:
        more, less = got - expected, expected - got
        return (
            f"{sum(more.values())} only in Spark, {sum(less.values())} only in SQL; "
            f"{sorted(more, key=str)[:2]} / {sorted(less, key=str)[:2]}"
        ), sum(got.values())
    return "", sum(got.values())


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            difference, n = compare(spark, db, entry.queries()[name], entry.oracle_sql().get(name), folder)
        except Exception as error:
            difference, n = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += bool(difference)
        print(f"{name:24} {n:8} rows {time.time() - start:6.1f} s  {difference[:1500] or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
