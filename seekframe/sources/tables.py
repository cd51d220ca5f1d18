"""Where tables come from and go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.plans.model import check_identifier


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{check_identifier(name)}.parquet")


_local: list[str] = []


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder that the driver and all executors share, below ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs inside one process (tests) a temporary folder is made, once.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="seekframe-"))
            atexit.register(shutil.rmtree, _local[0], True)
        root = f"file://{_local[0]}"
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_written: list[tuple[SparkSession, str]] = []


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A shared folder that goes when the driver ends."""
    path = shared_folder(spark, tag)
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _written:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may be gone already
            return


def settled(df: DataFrame, tag: str) -> DataFrame:
    """df, written to a scratch folder and read back: it is computed once, and survives the loss of any executor."""
    path = scratch_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def jdbc(spark: SparkSession, url: str, name: str, partition_column: str | None = None, bounds: tuple[int, int] = (0, 0), partitions: int = 1, **options: str) -> DataFrame:
    """A table of a relational database; read by ranges of a numeric column, if one is named. Needs its driver's jar."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", check_identifier(name)).options(**options)
    if partition_column:
        reader = reader.option("partitionColumn", check_identifier(partition_column)).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(check_identifier(name))


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types."""
    return df.dtypes


def write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()) -> None:
    """Parquet, laid out for pruning: by partition columns, and sorted within files by the usual filter columns."""
    if sort_by:
        df = df.repartition(*map(F.col, partition_by)) if partition_by else df
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path) if partition_by else df.write.mode("overwrite").parquet(path)


class SlowLog:
    """Runs actions and remembers those that took longer than ``least`` seconds: (name, seconds, plan)."""

    def __init__(self, least: float = 1.0, clock: Callable[[], float] = time.perf_counter):
        self.least, self.clock, self.entries = least, clock, []

    def run(self, name: str, df: DataFrame, action: Callable[[DataFrame], Any] = DataFrame.collect) -> Any:
        began = self.clock()
        try:
            return action(df)
        finally:
            if (seconds := self.clock() - began) > self.least:
                self.entries.append((name, seconds, df._jdf.queryExecution().simpleString()))
