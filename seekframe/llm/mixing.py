"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import settle, small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = 20_240_607
#: Bits of hash that one histogram level splits; six levels of ten bits use all that is compared.
LEVEL_BITS = 10
LEVELS = 6


def word_count(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash(id_col: str, text_col: str) -> Column:
    """60 bits that depend on the row alone, so reruns, retries and any partitioning agree."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)), 4)


def _numbered(each: DataFrame) -> DataFrame:
    """each(source, ...) with nth, the place of its source in code point order from 0, null last.

    Sources are dealt out by ranges; a range's numbers follow the counts of those before it, so no task sees them all.
    """
    ranges = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt, _ = settle(each.repartitionByRange(ranges, F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "mix-sources")
    counts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row for each range, at most
    before = counts.select(F.col("range").alias("r"), F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return dealt.join(F.broadcast(before), F.col("range") == F.col("r")).withColumn("nth", F.row_number().over(own) - 1 + F.col("before")).drop("range", "r", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, whole, rest) for sizes(source, size).

    Sources in code point order, null last, take the weights in turn and share the whole size. A target stops at
    ``most`` times its source's size; the excess goes to the others by weight until none is above. That ends where
    every target is min(cap, level * weight) for one common level. Each round sums up what stops below the level, and
    shares the rest anew, which raises it; it ends when no more sources stop. whole: full passes over the source; rest:
    the words still due after them.
    """
    each = _numbered(sizes.groupBy("source").agg(F.sum("size").cast("double").alias("source_size")))
    each = each.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("nth", F.lit(len(weights))) + 1).cast("int")))
    each, _ = settle(each.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight")), "mix-weights")
    total = each.agg(F.sum("source_size").alias("size")).first()["size"] or 0.0
    level, stopped = -1.0, -1
    while True:
        stops = F.col("ratio") <= level
        now = each.agg(F.count_if(stops).alias("n"), F.sum(F.when(stops, F.col("cap")).otherwise(0.0)).alias("cap"), F.sum(F.when(~stops, F.col("weight"))).alias("weight")).first()
        if now["weight"] is None or now["n"] == stopped:
            break
        level, stopped = (total - now["cap"]) / now["weight"], now["n"]
    each = each.withColumn("target", F.least("cap", F.lit(level) * F.col("weight")) if now["weight"] is not None else F.col("cap"))
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("long")
    each = each.withColumn("whole", whole)
    return each.select("source", F.col("source_size").cast("long").alias("source_size"), "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """plan with (bound, bits, take_bound): a row is due once more if its leading bits are below bound, or equal and take_bound.

    rows(source, size, h). A histogram of words by (source, leading hash bits) is summed up; the bucket in which the
    rest runs out is the boundary. Only its rows are looked at in the next level, with finer bits. It ends when each
    boundary bucket holds one hash value, which is taken if that comes nearer to the target.
    """
    state = plan.withColumns({"bound": F.lit(0).cast("long"), "left": F.col("rest"), "open": F.col("rest") > 0, "take_bound": F.lit(False), "bits": F.lit(0)})
    state = small(state, "mix-state")
    for level in range(1, LEVELS + 1):
        bits = LEVEL_BITS * level
        key = F.shiftrightunsigned("h", LEVEL_BITS * LEVELS - bits)
        mine = state.where("open").select(F.col("source").alias("s"), F.col("bound").alias("at"))
        inside = rows.join(mine, F.col("source").eqNullSafe(F.col("s"))).where(F.shiftrightunsigned(key, LEVEL_BITS) == F.col("at"))
        histogram = inside.groupBy("source", key.alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        summed = histogram.withColumn("upto", F.sum("words").over(upto))
        bound = summed.select(F.col("source").alias("b"), "bucket", "words", "upto", (F.col("low") == F.col("high")).alias("single"))
        limits = state.where("open").select(F.col("source").alias("s"), F.col("left").alias("due"))
        bound = bound.join(limits, F.col("b").eqNullSafe(F.col("s"))).where("upto > due").groupBy("b").agg(F.min(F.struct("bucket", "upto", "words", "single", "due")).alias("x"))
        bound = bound.select("b", F.col("x.bucket").alias("bucket"), (F.col("x.due") - F.col("x.upto") + F.col("x.words")).alias("due"), F.col("x.words").alias("words"), F.col("x.single").alias("single"), F.lit(True).alias("found"))
        joined = state.join(bound, F.col("source").eqNullSafe(F.col("b")), "left")
        ends = F.col("single") | F.lit(level == LEVELS)
        new = {
            "bound": F.coalesce("bucket", "bound"),
            "left": F.coalesce("due", "left"),
            "take_bound": F.when(F.col("found") & ends, F.col("due") * 2 >= F.col("words")).otherwise(F.col("take_bound")),
            "open": F.coalesce(F.col("found") & ~ends, F.lit(False)),
            "bits": F.when(F.col("found"), F.lit(bits)).otherwise(F.col("bits")),
        }
        state = small(joined.withColumns(new).select("source", "source_size", "target", "whole", "rest", "bound", "left", "take_bound", "open", "bits"), "mix-state")
        if state.where("open").isEmpty():
            break
    return state.drop("left", "open")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> tuple[DataFrame, DataFrame]:
    """(rows, plan): rows(doc_id, source, size, h), one for each row of docs; plan, one row for each source."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), _hash(id_col, text_col).alias("h"))
    rows, _ = settle(rows, "mix-rows")
    return rows, thresholds(rows, targets(rows, weights, most))


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows(source, h, ...) with their source's plan and passes, the number of times the mix takes them."""
    mine = plan.select(F.col("source").alias("of"), *(F.col(c) for c in ("source_size", "target", "whole", "bound", "bits", "take_bound")))
    lead = F.expr(f"shiftrightunsigned(h, {LEVEL_BITS * LEVELS} - bits)")
    once_more = (lead < F.col("bound")) | ((lead == F.col("bound")) & F.col("take_bound"))
    return rows.join(mine, F.col("source").eqNullSafe(F.col("of"))).withColumn("passes", F.col("whole") + once_more.cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs; other columns are ignored.

    A null or blank text has size 0 and is taken 0 times; a null source is a source of its own, after all others. Very
    long texts are taken whole or not at all, so a source comes within one document of its target. Repeated rows, and
    others of one id and text, have the same hash, so they are taken together. Empty table: no rows.
    """
    rows, plan = plan_mix(docs, id_col, text_col, source_col, weights, most)
    return _with_plan(rows, plan).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """docs as mixed: each row as often as the mix takes it, with all columns, whatever their names.

    Rows without words (null, empty or blank texts) go; null sources, ties and repeated rows are handled as by ``mix``.
    Empty table: no rows.
    """
    _, plan = plan_mix(docs, id_col, text_col, source_col, weights, most)
    whole = docs.select(F.struct("*").alias("row"), F.col(f"`{source_col}`").alias("source"), _hash(id_col, text_col).alias("h"), word_count(F.col(f"`{text_col}`")).alias("size"))
    out = _with_plan(whole, plan).where("passes > 0 and size > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))).alias("pass")).select("row.*")
