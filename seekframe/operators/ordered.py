"""Sums, numbers and fills over a whole order, without a task that sees all rows.

Rows are dealt into ranges of the order and written; each range works by itself, and what ranges before it come to is one row
for each of them. The order must be total: no two rows equal in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.sources.tables import settled

RANGE = "_range"


def _dealt(df: DataFrame, order: list[str]) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()), "ranges")


def running(df: DataFrame, order: list[str], **sums: Column) -> DataFrame:
    """df with the running sum of each column, its own row included."""
    parts = _dealt(df.withColumns(sums), order)
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(RANGE).agg(*(F.sum(n).alias(n) for n in sums))  # a row for each range
    carried = totals.select(F.col(RANGE).alias("_r"), *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    own = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.withColumns({n: F.sum(n).over(own) for n in sums}).join(F.broadcast(carried), F.col(RANGE) == F.col("_r"))
    return out.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop(RANGE, "_r", *(f"_{n}" for n in sums))


def filled(df: DataFrame, order: list[str], column: str) -> DataFrame:
    """df with the last value of a column that isn't null, at or before each row."""
    parts = _dealt(df, order)
    lasts = parts.where(F.col(column).isNotNull()).groupBy(RANGE).agg(F.max_by(column, F.struct(*order)).alias("_last"))
    every = parts.select(RANGE).distinct().join(lasts, RANGE, "left")  # a row for each range
    carried = every.select(F.col(RANGE).alias("_r"), F.last("_last", True).over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    own = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = parts.withColumn(column, F.last(column, True).over(own)).join(F.broadcast(carried), F.col(RANGE) == F.col("_r"))
    return out.withColumn(column, F.coalesce(column, "_before")).drop(RANGE, "_r", "_before")


def greedy(df: DataFrame, order: str, size: str, most_rows: int, most_size: int) -> DataFrame:
    """(order, size, call): rows in order, packed one after another into calls of so many rows and so much size at most.

    What a call would take from any row on follows from running sums; where calls really begin is found by doubling:
    those reached in one step, two, four, and so on, each by one join. A row that is too large is a call of its own; null sizes count
    as nothing. Empty table: no rows.
    """
    plain = df.select(F.col(order).alias("o"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    base = settled(running(plain, ["o"], i=F.lit(1).cast("long"), s=F.col("size")), "greedy-sums")
    # the last row whose running sum is within reach of a call that begins at i: both kinds of values in one order
    sums = base.select(F.col("s").alias("v"), F.lit(0).alias("kind"), "i", F.col("i").alias("last"))
    asked = base.select((F.col("s") - F.col("size") + most_size).alias("v"), F.lit(1).alias("kind"), "i", F.lit(None).cast("long").alias("last"))
    reach = filled(sums.unionByName(asked), ["v", "kind", "i"], "last").where("kind = 1")
    jump = settled(reach.select("i", F.least(F.col("i") + most_rows, F.greatest(F.coalesce("last", F.lit(0)) + 1, F.col("i") + 1)).alias("n")), "greedy-jumps")
    starts = base.where("i = 1").select("i", F.lit(0).cast("long").alias("call"))
    step = 1
    while True:
        far = starts.join(jump, "i").select(F.col("n").alias("i"), (F.col("call") + step).alias("call"))
        more = settled(far.join(base.select("i"), "i", "left_semi"), "greedy-starts")
        if more.isEmpty():
            break
        starts = settled(starts.unionByName(more), "greedy-starts")
        jump = settled(jump.join(jump.select(F.col("i").alias("n"), F.col("n").alias("m")), "n").select("i", F.col("m").alias("n")), "greedy-jumps")
        step *= 2
    marked = base.join(starts, "i", "left").select("i", "o", "size", "call")
    return filled(marked, ["i"], "call").select(F.col("o").alias(order), F.col("size").alias(size), "call")
