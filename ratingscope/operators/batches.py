"""Positions in an order: fixed-size batches, and running totals.

No order is built in one task. Rows are sorted by ranges and written once, so that all later
passes see one order; each range is worked on alone, and what lies before it is an offset, from
a table with one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workdir import materialized

# Fixed value: rows per batch of the original export.
BATCH_ROWS = 1200


def _in_ranges(df: DataFrame, order: list[str | Column], name: str, work_dir: str | None) -> DataFrame:
    """``df`` with its range ``_task`` and its place ``_pos`` in the range."""
    # The task id sits in the upper bits and the row within the task in the lower 33.
    # The hash lets ranges split rows that are equal in ``order``.
    ranged = df.orderBy(*order, F.xxhash64(*df.columns)).withColumn("_at", F.monotonically_increasing_id())
    return materialized(ranged, name, work_dir).withColumns(
        {"_task": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND((1 << 33) - 1)}
    ).drop("_at")


def _offsets(sizes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Sums of ``columns`` over all smaller keys: one row for each task or file."""
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(key, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in columns])


def assign_batches(
    df: DataFrame, order: list[str | Column], rows: int = BATCH_ROWS, work_dir: str | None = None
) -> DataFrame:
    """``part`` = 1, 2, .. for each run of ``rows`` rows in the given order."""
    ranged = _in_ranges(df, order, "batch-rows", work_dir)
    offsets = _offsets(ranged.groupBy("_task").agg(F.count(F.lit(1)).alias("_size")), "_task", ["_size"])
    part = F.floor((F.col("_before__size") + F.col("_pos")) / rows).cast("int") + 1
    numbered = ranged.join(F.broadcast(offsets), "_task").withColumn("part", part)
    return numbered.drop("_task", "_pos", "_before__size")


def input_order_batches(spark: SparkSession, path: str, rows: int = BATCH_ROWS) -> DataFrame:
    """The rows of Parquet files with ``part`` = 1, 2, .. for each run of ``rows`` rows as they stand.

    Files count in the order of their paths. The place in a file is the one the scan reports, and
    the rows before it are a sum over files, so nothing is sorted, moved or written.
    """
    scan = spark.read.parquet(path)
    at = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = at.groupBy("_file").agg((F.max("_row") + 1).alias("_size"))
    # One row per file; Spark broadcasts it if it is small enough.
    numbered = at.join(_offsets(sizes, "_file", ["_size"]), "_file")
    part = F.floor((F.col("_before__size") + F.col("_row")) / rows).cast("int") + 1
    return numbered.withColumn("part", part).select(*scan.columns, "part")


def running_counts(
    df: DataFrame, order: list[str | Column], counters: Mapping[str, Column], work_dir: str | None = None
) -> DataFrame:
    """``df`` with, for each counter, the rows up to and with this one for which it holds.

    Rows that are equal in ``order`` stand by a hash of their content.
    """
    flags = {f"_is_{name}": F.coalesce(holds, F.lit(False)).cast("long") for name, holds in counters.items()}
    ranged = _in_ranges(df.withColumns(flags), order, "running-rows", work_dir)
    sizes = ranged.groupBy("_task").agg(*[F.sum(c).alias(c) for c in flags])
    offsets = F.broadcast(_offsets(sizes, "_task", list(flags)))
    # One group is the rows of one task.
    so_far = Window.partitionBy("_task").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumns({f: F.sum(f).over(so_far) for f in flags})
    totals = [(F.col(f"_is_{n}") + F.col(f"_before__is_{n}")).alias(n) for n in counters]
    return inside.join(offsets, "_task").select(*df.columns, *totals)
