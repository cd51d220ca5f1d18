"""Facet counts from bitmaps: one for each value and bucket of ids, combined with the bitmap of the found ids.

Ids are longs, one row each; a bucket is a run of 32,768 of them, so a bitmap has 4 KB. Ids are dealt by bucket before they
become bits, so what is shuffled to make bitmaps is ids, and no bucket is large. Items aren't read to count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.plans.model import FACETABLE, FieldSpec, IndexSpec, SpecError


def of(ids: DataFrame, id_col: str) -> DataFrame:
    """(bucket, bits) of ids; null ids are in none."""
    rows = ids.where(F.col(id_col).isNotNull()).select(F.bitmap_bucket_number(F.col(id_col)).alias("bucket"), F.bitmap_bit_position(F.col(id_col)).alias("at"))
    return rows.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def build(items: DataFrame, index: IndexSpec, field: str) -> DataFrame:
    """(value, bucket, bits) of a field with one value; items without a value are those of the value null; dates are days."""
    spec = index.field(field)
    if spec.multi_value or spec.kind not in FACETABLE:
        raise SpecError(f"{field}: bitmaps are of fields with one value that have facets")
    if not isinstance(items.schema[index.id_col].dataType, (T.LongType, T.IntegerType)):
        raise SpecError(f"{index.id_col}: bitmaps need whole numbers as ids")
    value, at = F.col(field), F.col(index.id_col).cast("long")
    rows = items.where(at.isNotNull()).select((F.to_date(value) if spec.kind == "date" else value).alias("value"), F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("at"))
    return rows.repartition("value", "bucket").groupBy("value", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def write(bitmaps: DataFrame, path: str, files: int) -> None:
    bitmaps.repartition(files, "bucket").sortWithinPartitions("bucket", "value").write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def counts(bitmaps: DataFrame, found: DataFrame, id_col: str, spec: FieldSpec, missing: bool = False) -> DataFrame:
    """(value, count) of the found ids, as ``facets.terms`` counts their items: without missing no nulls, no empty strings, integers
    above zero only. Ids that have no bitmap at all count as missing."""
    mine = of(found.select(F.col(id_col).cast("long").alias("id")), "id")
    met = bitmaps.join(mine.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits")), F.col("bucket") == F.col("_bucket"))
    both = met.select("value", "bucket", F.explode(F.array("bits", "_bits")).alias("x")).groupBy("value", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("x")).alias("n"))
    out = both.where("n > 0").groupBy("value").agg(F.sum("n").cast("long").alias("count"))
    if not missing:
        out = out.where("value is not null")
        return out.where("value > 0") if spec.kind in ("integer", "entity_reference") else out.where("value <> ''") if spec.kind == "string" else out
    # all that were found, less those that have a value
    sums = mine.select(F.bitmap_count("bits").cast("long").alias("n")).unionByName(out.where("value is not null").select((-F.col("count")).alias("n")))
    rest = sums.agg(F.sum("n").alias("count")).select(F.lit(None).cast(bitmaps.schema["value"].dataType).alias("value"), "count")
    return out.where("value is not null").unionByName(rest.where(F.col("count") > 0))
