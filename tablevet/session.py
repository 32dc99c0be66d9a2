"""Session helpers: the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="tablevet-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder.

    A folder of this machine serves only a session without other machines; elsewhere executors would
    write to their own disks and later reads would miss rows, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _own_root()
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _noted:
        made.append(path)
    return path


_noted: list[list[str]] = []


@contextmanager
def noted_paths() -> Iterator[list[str]]:
    """The scratch paths that are given out inside the block."""
    made: list[str] = []
    _noted.append(made)
    try:
        yield made
    finally:
        _noted[:] = [other for other in _noted if other is not made]


def release(spark: SparkSession, paths: list[str], reader: DataFrame) -> list[str]:
    """Delete scratch paths that ``reader`` does not read; returns those that it does."""
    files = [f.split(":", 1)[-1].lstrip("/") for f in reader.inputFiles()] if paths else []
    kept = []
    for path in paths:
        bare = path.split(":", 1)[-1].strip("/") + "/"
        if any(f.startswith(bare) for f in files):
            kept.append(path)
            continue
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return kept


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query are deleted when it ends. For queries that write a
    table: nothing reads their shuffles again, and they would stay until the driver collects garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where several passes read the same expensive intermediate: the passes read columns of a
    Parquet table instead of repeating the shuffle, and a lost executor costs one re-read.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed_scan(df: DataFrame) -> DataFrame:
    """A map-only reading of files that gives the same rows with the same numbers at every pass.

    Spark packs files into tasks anew for each plan, by the executors it has then; here the tasks of the first
    plan are kept, so the rows need not be written to be numbered once.
    """
    spark = df.sparkSession
    rows = df._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, df._jdf.schema(), False), spark)
