"""Durable intermediate tables.

A table written here cuts lineage and survives the loss of executors.  The folder is the one
the session names in ``spark.checkpoint.dir``; a temporary folder is used only when Spark runs
in local mode and names none.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_LOCAL = "stayflow.localScratch"
_RUN = "stayflow.runScratch"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL, None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="stayflow-")
    spark.conf.set(_LOCAL, folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A new folder for one table, inside the run's folder if there is one."""
    folder = spark.conf.get(_RUN, None) or f"{scratch_dir(spark)}/stayflow"
    return f"{folder}/{uuid.uuid4().hex}"


@contextmanager
def scratch_of_run(spark: SparkSession) -> Iterator[str]:
    """Tables kept inside the ``with`` block are deleted at its end; publish before that."""
    folder = scratch_path(spark)
    before = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside the ``with`` block delete their own shuffle files when they end."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE)
        else:
            spark.conf.set(_FREE, before)


def keep(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader of the written rows.

    ``path`` is a new folder of the run unless given.  The shuffle files of the write are deleted
    when it ends: nothing reads them again, as the table outlives the executors.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    with _freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
