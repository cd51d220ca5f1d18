"""The embedding queue and hourly metrics as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PRIORITIES = {"high": 50, "normal": 100, "low": 200}
PAUSED = "_paused"
ITEM = T.StructType([
    T.StructField("operation", T.StringType()), T.StructField("server_id", T.StringType()), T.StructField("index_id", T.StringType()),
    T.StructField("item_id", T.StringType()), T.StructField("text_content", T.StringType()), T.StructField("priority", T.IntegerType()), T.StructField("created", T.LongType()),
    T.StructField("items", T.MapType(T.StringType(), T.StringType())), T.StructField("attempt", T.IntegerType()),
])
#: Items in one batch task; times that a task is tried.
CHUNK, ATTEMPTS = 10, 3
LEDGER = "index_id string, item_id string, created long, attempt int, state string, error string"


def is_valid() -> Column:
    """Items a worker can do: operation and server, and what the operation needs besides."""
    base = F.col("server_id").isNotNull() & (F.col("server_id") != "")
    single = (F.col("operation") == "generate_embedding") & F.col("item_id").isNotNull() & F.col("index_id").isNotNull() & F.col("text_content").isNotNull()
    whole = (F.col("operation") == "regenerate_index_embeddings") & F.col("index_id").isNotNull()
    batch = (F.col("operation") == "batch_generate_embeddings") & F.col("index_id").isNotNull() & (F.size("items") > 0)
    return F.coalesce(base & (single | whole | batch), F.lit(False))


def allowed(config: dict, server: str) -> bool:
    """Whether a server's texts are queued: not unless queues are on at all; then as the server says, else as the default."""
    return bool(config.get("enabled", False)) and bool(config.get("servers", {}).get(server, config.get("default", True)))


def tasks(items: DataFrame, id_col: str, text_col: str, server: str, index: str, now: int, priority: str = "normal") -> DataFrame:
    """A generate task for each item that has an id and a text."""
    rows = items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & (F.trim(F.col(text_col)) != ""))
    return rows.select(
        F.lit("generate_embedding").alias("operation"), F.lit(server).alias("server_id"), F.lit(index).alias("index_id"), F.col(id_col).cast("string").alias("item_id"),
        F.col(text_col).cast("string").alias("text_content"), F.lit(PRIORITIES[priority]).alias("priority"), F.lit(now).cast("long").alias("created"),
        F.lit(None).cast("map<string,string>").alias("items"), F.lit(0).alias("attempt"))


def batch_tasks(items: DataFrame, id_col: str, text_col: str, server: str, index: str, now: int, priority: str = "normal", chunk: int = CHUNK) -> DataFrame:
    """Tasks of ``chunk`` items each, as they lie in their partitions; the last of a partition may be smaller."""
    single = tasks(items, id_col, text_col, server, index, now, priority).withColumn("_n", F.monotonically_increasing_id())
    # numbers of a partition follow one another from a multiple of 2 ** 33 up
    number = F.struct(F.shiftright("_n", 33), F.floor(F.col("_n") % (1 << 33) / chunk))
    grouped = single.groupBy(number.alias("_chunk")).agg(F.map_from_entries(F.collect_list(F.struct("item_id", "text_content"))).alias("items"))
    return grouped.select(
        F.lit("batch_generate_embeddings").alias("operation"), F.lit(server).alias("server_id"), F.lit(index).alias("index_id"), F.lit(None).cast("string").alias("item_id"),
        F.lit(None).cast("string").alias("text_content"), F.lit(PRIORITIES[priority]).alias("priority"), F.lit(now).cast("long").alias("created"), "items", F.lit(0).alias("attempt"))


def single(queue: DataFrame) -> DataFrame:
    """Tasks with each batch task as the tasks of its items."""
    of_batch = F.col("operation") == "batch_generate_embeddings"
    rows = queue.where(of_batch).select("*", F.explode("items").alias("_id", "_text"))
    rows = rows.withColumns({"operation": F.lit("generate_embedding"), "item_id": F.col("_id"), "text_content": F.col("_text"), "items": F.lit(None).cast("map<string,string>")})
    return queue.where(~of_batch).unionByName(rows.select(*queue.columns))


def regenerate_task(spark: SparkSession, server: str, index: str, now: int) -> DataFrame:
    """One task that asks for all embeddings of an index anew."""
    return spark.createDataFrame([("regenerate_index_embeddings", server, index, None, None, PRIORITIES["low"], now, None, 0)], ITEM)


def enqueue(new: DataFrame, folder: str) -> None:
    """Add tasks to a queue's folder; many tasks are as many files as the frame has partitions, written side by side."""
    new.select(*ITEM.names).write.mode("append").json(folder)


def without_items(queue: DataFrame, gone: DataFrame) -> DataFrame:
    """The queue without the tasks of items gone(item_id); tasks for no item stay."""
    return queue.join(gone.select(F.col("item_id").alias("_gone")).distinct(), F.col("item_id") == F.col("_gone"), "left_anti")


def _marker(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{PAUSED}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def pause(spark: SparkSession, folder: str) -> None:
    """Nothing is taken from the queue until it is resumed; tasks may still be added."""
    fs, path = _marker(spark, folder)
    fs.create(path, True).close()


def resume(spark: SparkSession, folder: str) -> None:
    fs, path = _marker(spark, folder)
    fs.delete(path, False)


def is_paused(spark: SparkSession, folder: str) -> bool:
    fs, path = _marker(spark, folder)
    return fs.exists(path)


def clear(spark: SparkSession, folder: str) -> None:
    """Drop all tasks."""
    fs, path = _marker(spark, folder)
    fs.delete(path.getParent(), True)
    fs.mkdirs(path.getParent())


def dispatch(workers: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """Work for ``process``: each operation's tasks go to its worker."""

    def work(batch: DataFrame, number: int) -> None:
        for operation, worker in workers.items():
            mine = batch.where(F.col("operation") == operation)
            if not mine.isEmpty():
                worker(mine, number)

    return work


def regenerator(read: Callable[[str], DataFrame], embed: Callable[[DataFrame], DataFrame], save: Callable[[str, DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A worker for regenerate tasks: each index that is asked for, once a batch, is read, embedded whole and saved."""

    def work(batch: DataFrame, number: int) -> None:
        for row in batch.select("index_id").distinct().orderBy("index_id").toLocalIterator():
            save(row.index_id, embed(read(row.index_id)), number)

    return work


def process(spark: SparkSession, source: str, checkpoint: str, work: Callable[[DataFrame, int], None], rejected: Callable[[DataFrame, int], None] | None = None, files_per_trigger: int = 100) -> StreamingQuery | None:
    """Run all that is queued in the folder source, in order of priority, then stop; None if the queue is paused.

    Items arrive as JSON files. Each micro-batch is given to work, which must be idempotent by item id: the checkpoint
    makes delivery at-least-once. Batch tasks come as the tasks of their items. Of several tasks for one item in a batch the
    newest is done. Invalid items go to rejected, or to the folder "<source>-rejected".
    """
    if is_paused(spark, source):
        return None
    stream = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", files_per_trigger).json(source)
    refused = rejected or (lambda bad, number: bad.write.mode("overwrite").json(f"{source.rstrip('/')}-rejected/batch={number}"))

    def batch(df: DataFrame, number: int) -> None:
        good = single(df.where(is_valid()))
        columns = [c for c in df.columns if c not in ("operation", "index_id", "item_id")]
        newest = good.groupBy("operation", "index_id", "item_id").agg(F.max_by(F.struct(*columns), F.struct(F.coalesce("created", F.lit(0)), F.coalesce("attempt", F.lit(0)))).alias("r"))
        newest = newest.select("operation", "index_id", "item_id", "r.*").select(*df.columns)
        # items come last, as tasks of one priority and moment would all be in one range, and one task
        work(newest.orderBy(F.coalesce("priority", F.lit(PRIORITIES["normal"])), "created", "index_id", "item_id"), number)
        bad = df.where(~is_valid())
        if rejected is not None or not bad.isEmpty():
            refused(bad, number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, source: str) -> DataFrame:
    """(index_id, item_id, created, attempt, state, error): what became of each attempt: done, released or dead."""
    folder = f"{source.rstrip('/')}-ledger"
    fs, path = _marker(spark, folder)
    return spark.read.schema(LEDGER).parquet(f"{folder}/*") if fs.exists(path.getParent()) else spark.createDataFrame([], LEDGER)


def in_flight(spark: SparkSession, source: str) -> DataFrame:
    """(index_id, item_id) of the items with a task that isn't done or dead yet."""
    queued = single(spark.read.schema(ITEM).json(source).where(is_valid())).where("item_id is not null").groupBy("index_id", "item_id").agg(F.max("created").alias("created"))
    over = ledger(spark, source).where("state <> 'released'").groupBy("index_id", "item_id").agg(F.max("created").alias("until"))
    return queued.join(over, ["index_id", "item_id"], "left").where("until is null or until < created").select("index_id", "item_id")


def enqueue_once(new: DataFrame, source: str) -> None:
    """Add tasks of items that have none in flight."""
    spark = new.sparkSession
    fs, path = _marker(spark, source)
    if fs.exists(path.getParent()):
        new = new.join(in_flight(spark, source), ["index_id", "item_id"], "left_anti").select(*ITEM.names)
    enqueue(new, source)


def drain(spark: SparkSession, source: str, checkpoint: str, worker: Callable[[DataFrame, int], DataFrame], attempts: int = ATTEMPTS) -> int:
    """Work until the queue is empty; the number of passes. worker(tasks, number) does them and returns (index_id, item_id, error).

    A task whose item has an error is released: it comes again in the next pass, as another attempt, up to ``attempts``;
    then it is dead, and lies in "<source>-dead". A worker that fails as a whole releases all of its batch, and the stream
    goes on. The ledger has every attempt; delivery is at-least-once.
    """
    base = source.rstrip("/")
    passes = 0

    def work(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("attempt", F.coalesce("attempt", F.lit(0)) + 1)
        try:
            result = worker(batch, number).select("index_id", "item_id", "error")
            result.write.mode("overwrite").parquet(f"{base}-outcome/batch={number}")
        except Exception as e:  # whatever the worker failed of, its tasks come again
            batch.select("index_id", "item_id", F.lit(str(e)[:500]).alias("error")).write.mode("overwrite").parquet(f"{base}-outcome/batch={number}")
        outcome = spark.read.schema("index_id string, item_id string, error string").parquet(f"{base}-outcome/batch={number}")
        met = batch.join(outcome, ["index_id", "item_id"], "left")
        state = F.when(F.col("error").isNull(), "done").when(F.col("attempt") < attempts, "released").otherwise("dead")
        met.withColumn("state", state).select("index_id", "item_id", "created", "attempt", "state", "error").write.mode("overwrite").parquet(f"{base}-ledger/batch={number}")
        failed = met.where("error is not null")
        enqueue(failed.where(F.col("attempt") < attempts), source)
        failed.where(F.col("attempt") >= attempts).select(*ITEM.names, "error").write.mode("overwrite").json(f"{base}-dead/batch={number}")

    while passes < attempts:
        before = ledger(spark, source).count()
        query = process(spark, source, checkpoint, work)
        if query is None:
            return passes
        query.awaitTermination()
        passes += 1
        if ledger(spark, source).count() == before or not ledger(spark, source).where(F.col("state") == "released").limit(1).count():
            return passes
    return passes


def hourly_stream(events: DataFrame, time_col: str = "ts", value_col: str = "value", delay: str = "1 hour") -> DataFrame:
    """Counts and averages by hour of a stream or table; hours close when the watermark passes them."""
    return events.withWatermark(time_col, delay).groupBy(F.window(time_col, "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg(value_col).alias("avg_value")).select(F.col("w.start").alias("hour"), "n", "avg_value")
