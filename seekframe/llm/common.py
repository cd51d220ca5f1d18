"""Shared helpers: the shared folder, tables written there, and joins that stay splittable under skew."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of text up to which a table is broadcast; besides texts, its rows are a few longs.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20

#: Spark's setting by which a query's shuffle files are deleted when it has ended.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dir: list[str] = []
_written: list[tuple[SparkSession, str]] = []
_run: ContextVar[list[str] | None] = ContextVar("tables of this run", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs inside one process (tests) is a temporary folder made.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _local_dir:
        _local_dir.append(tempfile.mkdtemp(prefix="seekframe-"))
    return f"file://{_local_dir[0]}"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1) if uri.startswith("file:") else f"file://{uri}")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A new folder for files of tasks' own, in the shared folder."""
    path = f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    store, where = open_store(path)
    store.create_dir(where)
    _note(spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, so that any shared store will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _note(spark: SparkSession, path: str) -> None:
    _written.append((spark, path))
    if (mine := _run.get()) is not None:
        mine.append(path)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Collects the tables and folders that this thread writes inside the block; those of other threads aren't its own."""
    token = _run.set([])
    try:
        yield _run.get()
    finally:
        _run.reset(token)


def release(spark: SparkSession, paths: list[str], keep: str | None = None) -> None:
    """Remove tables and folders that were written, but for the one at ``keep``."""
    gone = {p for p in paths if p != keep}
    for path in gone:
        remove(spark, path)
    _written[:] = [x for x in _written if x[1] not in gone]


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session may be gone already
            return


def settle(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it back: cuts lineage, and survives the loss of any executor.

    The shuffles that made it aren't needed any more once it is written, so their files go then.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    _note(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def fresh(column: Column | str, kind: str = "long") -> Column:
    """The same value as an expression that no earlier partitioning covers.

    A side of a join that was just aggregated by the key would keep its exchange, and adaptive execution splits a
    skewed partition only if both sides come straight from exchanges made for that join.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.concat(c, F.lit("")) if kind == "string" else c.bitwiseXOR(F.lit(0).cast(kind))


def small(df: DataFrame, tag: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, written once; marked for broadcast only if it turned out to have at most so many rows, and bytes of text."""
    kept, _ = settle(df, tag)
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    found = kept.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(texts, F.lit(0).cast("long"))), F.lit(0)).alias("bytes")).first()
    return F.broadcast(kept) if found.n <= rows and found.bytes <= BROADCAST_BYTES else kept


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while (name := f"_{name}") in taken:
        pass
    return name


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """128 bits that name a row by all its values; columns with maps count as their JSON."""
    values = []
    for n, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`") if sum(g.name.lower() == f.name.lower() for g in df.schema) == 1 else df[n]
        values += [F.to_json(F.struct(c.alias("v"))) if _has_map(f.dataType) else c, c.isNull()]
    return F.xxhash64(*values), F.xxhash64(F.lit(23), *values)


def keyed(df: DataFrame, key: str, thin: DataFrame) -> DataFrame | None:
    """Other keys for different things that share one: (h1, h2, key) of those, or None if there are none.

    thin(h1, h2): a row for each different thing, at least. 64 bits name most things alone; where they don't, further
    hashes are tried until all keys are different, so no two things are ever taken for one.
    """
    clash = thin.groupBy("h1").agg((F.min("h2") != F.max("h2")).alias("two")).where("two").select(fresh("h1").alias("c1"))
    clash, path = settle(clash, f"{key}-clashes")
    if clash.isEmpty():
        remove(df.sparkSession, path)
        return None
    both = thin.join(clash, F.col("h1") == F.col("c1"), "left_semi").select("h1", "h2").distinct()
    seed = 1
    while True:
        again, _ = settle(both.withColumn(key, F.xxhash64(F.lit(seed), "h1", "h2")), f"{key}-again")
        free = again.select(F.col(key).alias("k")).join(thin.select(fresh("h1").alias("t1")), F.col("k") == F.col("t1"), "left_semi").isEmpty()
        if free and again.count() == again.select(key).distinct().count():
            return again
        seed += 1


def slices(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[list]:
    """The values of a text column in runs of bounded size, so that what is split at once is bounded."""
    part, held = [], 0
    for value in column:
        text = value.as_py()
        part.append(text)
        held += len(text or "")
        if held >= most_bytes:
            yield part
            part, held = [], 0
    if part:
        yield part
