"""The shared folder for tables that a job writes once and reads several times.

The folder is ``work_dir`` where one is given, else the one that ``spark.checkpoint.dir``
names, else a folder below ``spark.sql.warehouse.dir``, which a cluster shares as well. A
warehouse on the driver's own disk is shared with nobody, so on a cluster it is an error.

Results are lazy, so their intermediate tables must outlive the call that made them.
:func:`work_folder` removes them once the result is written::

    with work_folder(spark):
        write_parquet(build_abt(sources), out)
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_job: ContextVar[str | None] = ContextVar("ratingscope_job", default=None)


def work_root(spark: SparkSession) -> str:
    """The folder that all executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        if root.startswith(("/", "file:")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("executors do not share the warehouse on the driver's disk: set spark.checkpoint.dir")
    return root.rstrip("/")


@contextmanager
def work_folder(spark: SparkSession, work_dir: str | None = None) -> Iterator[str]:
    """One folder for all tables written inside the block, removed at its end."""
    path = f"{(work_dir or work_root(spark)).rstrip('/')}/job-{uuid.uuid4().hex}"
    before = _job.set(path)
    try:
        yield path
    finally:
        _job.reset(before)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def new_path(spark: SparkSession, name: str, work_dir: str | None = None) -> str:
    """A fresh path: in the job's folder, else in ``work_dir``, else in the shared one."""
    root = _job.get() or (work_dir.rstrip("/") if work_dir else f"{work_root(spark)}/ratingscope")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, name: str, work_dir: str | None = None) -> DataFrame:
    """``df`` written once as Parquet and read back, so later readers prune columns."""
    spark = df.sparkSession
    path = new_path(spark, name, work_dir)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffle_files_freed(spark: SparkSession) -> Iterator[None]:
    """Inside the block a query's shuffle files go as soon as its result is written.

    For steps whose shuffle is large beside the table they write.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)
