"""Index maintenance: upsert, delete, clear, and schema evolution, each as one declarative pass."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seekframe.functions import prepare as P
from seekframe.operators.segments import point, pointed, store
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.streaming.queue import tasks as queue_tasks


def empty(spark: SparkSession, index: IndexSpec) -> DataFrame:
    return spark.createDataFrame([], index.schema())


def create_table(spark: SparkSession, path: str, index: IndexSpec) -> None:
    """An empty table of an index; an error if there is one already."""
    if pointed(spark, path) is not None:
        raise SpecError(f"there is a table at {path}")
    replace_table(empty(spark, index), path)


def scalar(c: Column, kind: T.DataType) -> tuple[Column, T.DataType]:
    """A raw value without its wrapping: the ``value`` of a formatted text (a struct, or its ``target_id``), else the struct as
    JSON; of an array each element, and of an array of one for a field with one value its first."""
    if isinstance(kind, T.StructType):
        for name in ("value", "target_id"):
            if name in kind.names:
                return scalar(c[name], kind[name].dataType)
        return F.to_json(c), T.StringType()
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        inner = scalar(F.lit(None).cast(kind.elementType), kind.elementType)[1]
        return F.transform(c, lambda x: scalar(x, kind.elementType)[0]), T.ArrayType(inner)
    return c, kind


def unwrapped(raw: DataFrame, index: IndexSpec) -> DataFrame:
    """Raw rows whose fields may be structs, or arrays of them, with plain values."""
    out = {}
    for f in index.fields:
        if f.name in raw.columns:
            c, kind = scalar(F.col(f.name), raw.schema[f.name].dataType)
            if isinstance(kind, T.ArrayType) and not f.multi_value and f.kind != "vector":
                c = F.get(c, F.lit(0))
            out[f.name] = F.array_compact(c) if f.multi_value and isinstance(kind, T.ArrayType) else c
    return raw.withColumns(out) if out else raw


def prepare_value(c: Column, spec: FieldSpec) -> Column:
    """A raw value as its field's type; what can't be converted is null, and only that."""
    if spec.multi_value:
        return P.integers(c.cast("array<string>")) if spec.kind in ("integer", "entity_reference") else P.strings(c.cast("array<string>"))
    made = {"text": P.text, "fulltext": P.text, "string": P.string, "integer": P.integer, "entity_reference": P.entity_id, "decimal": P.decimal, "boolean": P.boolean}
    if spec.kind == "vector":
        return c.cast("array<float>")
    if spec.kind == "date":
        return P.date(c).cast("timestamp_ntz")
    return made[spec.kind](c.cast("string") if spec.kind == "entity_reference" else c)


def prepare_items(raw: DataFrame, index: IndexSpec) -> DataFrame:
    """Raw rows as rows of the index: plain and typed fields, a text id, empty language where unknown."""
    raw = unwrapped(raw, index)
    system = [F.col(index.id_col).cast("string").alias(index.id_col), F.col(index.datasource_col).cast("string").alias(index.datasource_col), F.coalesce(F.col(index.language_col).cast("string"), F.lit("")).alias(index.language_col)]
    return raw.select(*system, *(prepare_value(F.col(f.name), f).alias(f.name) if f.name in raw.columns else F.lit(None).cast(f.data_type).alias(f.name) for f in index.fields))


def newest(changes: DataFrame, id_col: str, version: Column | None = None) -> DataFrame:
    """The newest change of each id, found with a partial aggregation; rows with null ids all stay."""
    columns = [c for c in changes.columns if c != id_col]
    latest = changes.withColumn("_v", version if version is not None else F.lit(0))
    best = latest.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max_by(F.struct(*columns), F.struct("_v", F.xxhash64(*columns))).alias("_row"))
    best = best.select(id_col, *(F.col(f"_row.{c}").alias(c) for c in columns)).select(*changes.columns)
    return best.unionByName(changes.where(F.col(id_col).isNull()))


def upsert(items: DataFrame, changes: DataFrame, id_col: str, version: Column | None = None) -> DataFrame:
    """items with changes applied, the last version of each id winning over all older rows.

    Only ids are needed to drop replaced rows, so stored rows are never sorted: an anti join, plus the newest change
    of each id.
    """
    rows = newest(changes, id_col, version).select(*items.columns)
    return items.join(changes.select(id_col).distinct(), id_col, "left_anti").select(*items.columns).unionByName(rows)


def delete(items: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """items without those ids; blank and null ids delete nothing."""
    clean = ids.select(F.trim(F.col(id_col).cast("string")).alias("_id")).where("_id <> ''")
    return items.join(clean, F.col(id_col).cast("string") == F.col("_id"), "left_anti")


def existing(items: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    return items.join(ids.select(id_col), id_col, "left_semi")


def clear(items: DataFrame, index: IndexSpec, datasource: str | None = None) -> DataFrame:
    """No items, or none of one datasource."""
    return items.where(F.lit(False)) if datasource is None else items.where(F.col(index.datasource_col) != datasource)


def convert(c: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column in a new type: a scalar becomes an array of one, an array its first value, numbers widen or narrow."""
    if have == want:
        return c
    if isinstance(want, T.ArrayType) and not isinstance(have, T.ArrayType):
        return F.when(c.isNotNull(), F.array(c.cast(want.elementType)))
    if isinstance(have, T.ArrayType) and not isinstance(want, T.ArrayType):
        return F.get(c, F.lit(0)).cast(want)
    if isinstance(have, T.NumericType) and isinstance(want, T.NumericType) or isinstance(want, T.StringType):
        return c.try_cast(want)
    raise SpecError(f"no conversion from {have.simpleString()} to {want.simpleString()}")


def evolve(items: DataFrame, index: IndexSpec) -> DataFrame:
    """items in the shape of index: new fields are null, dropped ones go, changed types are converted."""
    have = {f.name: f.dataType for f in items.schema}
    return items.select(*index.system, *(convert(F.col(f.name), have[f.name], f.data_type).alias(f.name) if f.name in have else F.lit(None).cast(f.data_type).alias(f.name) for f in index.fields))


def differences(items: DataFrame, index: IndexSpec) -> dict[str, list[str]]:
    """Field names that evolve() would add, change or remove."""
    have = {f.name: f.dataType for f in items.schema if f.name not in index.system}
    want = {f.name: f.data_type for f in index.fields}
    return {"add": sorted(want.keys() - have.keys()), "change": sorted(k for k in want.keys() & have.keys() if want[k] != have[k]), "remove": sorted(have.keys() - want.keys())}


def _version(spark: SparkSession, path: str) -> str | None:
    """The folder of a table's version that its pointer names."""
    name = pointed(spark, path)
    return None if name is None else f"{path}/{name}"


def replace_table(df: DataFrame, path: str) -> None:
    """Write a new version of a table, then let its pointer name it: readers find the old version or the new one.

    The pointer is moved into place in one step, and a failed write leaves the old one. The version before stays for
    those who are reading it; older ones go.
    """
    spark = df.sparkSession
    name, old = f"v-{uuid.uuid4().hex}", _version(spark, path)
    df.write.parquet(f"{path}/{name}")
    point(spark, path, name)
    keep = {name, old.rsplit("/", 1)[1] if old else name}
    fs, where = store(spark, path)
    for x in fs.listStatus(where):
        if x.isDirectory() and x.getPath().getName().startswith("v-") and x.getPath().getName() not in keep:
            fs.delete(x.getPath(), True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written with replace_table."""
    version = _version(spark, path)
    if version is None:
        raise SpecError(f"no table at {path}")
    return spark.read.parquet(version)


def drop_table(spark: SparkSession, path: str) -> bool:
    """Delete a table with all that belongs to it (versions, text and vector indexes, facet layouts); whether there was one."""
    fs, where = store(spark, path)
    return fs.delete(where, True)


def append(items: DataFrame, more: DataFrame) -> DataFrame:
    """items and more rows of the same fields, without a look at ids: a plain insert."""
    if sorted(items.columns) != sorted(more.columns):
        raise SpecError(f"fields differ: {sorted(set(items.columns) ^ set(more.columns))}")
    return items.unionByName(more.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in items.schema)))


#: What a backend may offer, as names; a move to another backend compares them.
VECTOR_FEATURES = frozenset({"vector_search", "hybrid_search", "embeddings"})


def migration_check(index: IndexSpec, features: frozenset[str], kinds: frozenset[str], offered: frozenset[str], offered_kinds: frozenset[str]) -> dict[str, list[str]]:
    """What a move to a backend would lose: features, field types, and the fields that have those types."""
    lost = kinds - offered_kinds
    return {"features": sorted(features - offered), "types": sorted(lost), "fields": sorted(f.name for f in index.fields if f.kind in lost)}


def migrate(items: DataFrame, index: IndexSpec) -> tuple[DataFrame, IndexSpec]:
    """items and index for a backend without vectors: vector fields go, fulltext fields become plain text."""
    fields = tuple(replace(f, kind="text") if f.kind == "fulltext" else f for f in index.fields if f.kind != "vector")
    smaller = IndexSpec(index.name, fields, index.id_col, index.datasource_col, index.language_col)
    return evolve(items, smaller), smaller


def queued(items: DataFrame, index: IndexSpec, text: Column, server: str, now: int) -> tuple[DataFrame, DataFrame]:
    """(rows without embeddings, tasks for them): how items are indexed while their embeddings are made later."""
    vectors = [f.name for f in index.fields if f.kind == "vector"]
    rows = items.withColumns({n: F.lit(None).cast(index.field(n).data_type) for n in vectors}) if vectors else items
    return rows, queue_tasks(items.select(F.col(index.id_col).alias("id"), text.alias("text")), "id", "text", server, index.name, now)
