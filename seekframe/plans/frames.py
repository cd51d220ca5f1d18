"""The given tables as the library's inputs, each with the DuckDB SQL that makes the same frame."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators import store as ST
from seekframe.operators import vectorindex as VI
from seekframe.operators.gramindex import GramIndex
from seekframe.operators.search import Items
from seekframe.operators.segments import current, version
from seekframe.operators.textindex import TextIndex
from seekframe.plans.model import FieldSpec, IndexSpec
from seekframe.sources.tables import scratch_folder, table

DOCS = IndexSpec("documents", (FieldSpec("text", "text", weight="A"), FieldSpec("n_chars", "integer"), FieldSpec("quality", "boolean"), FieldSpec("toxic", "boolean"), FieldSpec("content_embedding", "vector", dimensions=64)), "doc_id", "source", "lang")
PARTS = IndexSpec("parts", (FieldSpec("p_name", "text", weight="A"), FieldSpec("p_brand", "string", weight="B"), FieldSpec("p_type", "string", weight="C"), FieldSpec("p_size", "integer"), FieldSpec("p_retailprice", "decimal"), FieldSpec("tags", "string", -1)), "p_partkey", "p_brand", "p_type")
#: The fields of parts that are searched by keywords.
PARTS_TEXT = IndexSpec("part", (FieldSpec("p_name", "text", weight="A"), FieldSpec("p_brand", "string", weight="B"), FieldSpec("p_type", "string", weight="C")), "p_partkey", "p_brand", "p_type")
ORDERS = IndexSpec("orders", (FieldSpec("o_orderstatus", "string"), FieldSpec("o_totalprice", "decimal"), FieldSpec("o_orderdate", "date"), FieldSpec("o_orderpriority", "string"), FieldSpec("o_custkey", "integer")), "o_orderkey", "o_orderpriority", "o_orderstatus")
#: The embeddings by themselves, as items that have nothing but a vector.
VECTORS = IndexSpec("embeddings", (FieldSpec("embedding", "vector", dimensions=64),), "vec_id", "label", "label")
#: Documents without their texts.
DOC_SIZES = IndexSpec("sizes", (FieldSpec("n_chars", "integer"),), "doc_id", "source", "lang")
#: The labels by themselves.
LABELS = IndexSpec("labels", (FieldSpec("quality", "boolean"), FieldSpec("toxic", "boolean")), "doc_id", "quality", "toxic")
BASKETS = IndexSpec("baskets", (FieldSpec("suppliers", "integer", -1), FieldSpec("flags", "string", -1)), "l_orderkey", "l_orderkey", "l_orderkey")

#: A fixed query vector of 64 dimensions, by a rule.
VECTOR = tuple(round(math.sin(1 + 0.7 * i), 4) for i in range(64))
#: The end of the reporting periods: 2024-01-21 00:00 UTC.
AS_OF = 1_705_795_200

DOCS_SQL = "(SELECT d.*, quality = 1 AS quality, toxic = 1 AS toxic, embedding AS content_embedding FROM documents d LEFT JOIN (SELECT doc_id, quality, toxic FROM labels) l USING (doc_id) LEFT JOIN embeddings e ON d.doc_id = e.vec_id)"
PARTS_SQL = "(SELECT *, string_split(p_name, ' ') AS tags FROM part)"
BASKETS_SQL = "(SELECT l_orderkey, list(l_suppkey) AS suppliers, list(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey)"
ANALYTICS_SQL = "(SELECT event_id, 's' || (user_id % 4) AS server_id, event_type AS operation, CAST(json_extract_string(props, '$.k') AS INTEGER) AS token_count, CAST(value / 1000 AS DECIMAL(10, 6)) AS cost_usd, CAST(event_id % 500 AS INTEGER) AS duration_ms, epoch_us(ts) // 1000000 AS timestamp FROM events)"
METRICS_SQL = "(SELECT event_id, 's' || (user_id % 4) AS server_id, CASE event_id % 5 WHEN 0 THEN 'cache' WHEN 1 THEN 'queue' WHEN 2 THEN 'error' ELSE 'query' END AS metric_type, CASE WHEN event_id % 5 = 0 THEN CASE WHEN user_id % 3 = 0 THEN 'cache_miss' ELSE 'cache_hit' END ELSE event_type END AS metric_name, CAST(value AS DECIMAL(15, 6)) AS value, epoch_us(ts) // 1000000 AS timestamp FROM events)"
CACHE_SQL = "(SELECT sha256(text) AS text_hash, 64 AS dimensions, CAST(doc_id AS BIGINT) AS created, CAST(doc_id + n_chars % 1000 AS BIGINT) AS last_accessed, CAST(doc_id + n_chars AS BIGINT) AS expires, CAST(n_chars % 7 AS INTEGER) AS hit_count FROM (SELECT min(doc_id) AS doc_id, text, any_value(length(text)) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY text))"
QUEUE_SQL = "(SELECT doc_id AS item_id, CASE WHEN n_chars > 2000 THEN 'batch_generate_embeddings' ELSE 'generate_embedding' END AS operation, CASE doc_id % 3 WHEN 0 THEN 50 WHEN 1 THEN 100 ELSE 200 END AS priority FROM documents)"
CACHE_NOW = 2000


def labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("quality"), (F.col("toxic") == 1).alias("toxic"))


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("content_embedding"))


_stores: dict[tuple[str, ...], str] = {}


def _store(spark: SparkSession, d: str, name: str, layout: ST.Layout, items: DataFrame | None = None) -> tuple[str, str]:
    """(store, version) of the indexes of a given table: made when first asked for, and again whenever its files have changed."""
    key = (spark.sparkContext.applicationId, d, name, *layout.texts, "/", *layout.grams, "/", *layout.vectors, "/", *layout.bitmaps)
    if key not in _stores:
        _stores[key] = scratch_folder(spark, f"indexes-{name}")
    path, now = _stores[key], version(spark, f"{d}/{name}.parquet")
    held = current(spark, path)
    if held is None or held.source != now:
        ST.create(spark, path, layout, table(spark, d, name) if items is None else items, now)
    return path, now


def _layout(spark: SparkSession, index: IndexSpec, **what) -> ST.Layout:
    return ST.Layout(index, items=False, files=int(spark.conf.get("spark.sql.shuffle.partitions")), **({"texts": ()} | what))


def _opened(spark: SparkSession, d: str, name: str, index: IndexSpec, **what) -> Items:
    layout = _layout(spark, index, **what)
    path, now = _store(spark, d, name, layout)
    return ST.open_(spark, path, layout, table(spark, d, name), source=now)


def text_index(spark: SparkSession, d: str, name: str, index: IndexSpec, config: str = "simple") -> TextIndex:
    """The text index of a given table's present files."""
    return _opened(spark, d, name, index, texts=(config,)).text[config]


def gram_index(spark: SparkSession, d: str, name: str, index: IndexSpec, field: str) -> GramIndex:
    """The trigram index of a field of a given table's present files."""
    return _opened(spark, d, name, index, grams=(field,)).grams[field]


def vector_index(spark: SparkSession, d: str) -> VI.VectorIndex:
    """The vector index of the embeddings' present files."""
    return _opened(spark, d, "embeddings", VECTORS, vectors=("embedding",)).vectors["embedding"]


def label_bitmaps(spark: SparkSession, d: str, *fields: str) -> dict[str, DataFrame]:
    """The bitmaps of fields of the labels' present files."""
    layout = _layout(spark, LABELS, bitmaps=fields)
    path, now = _store(spark, d, "labels", layout, labels(spark, d))
    return dict(ST.open_(spark, path, layout, labels(spark, d), source=now).bitmaps)


def docs(spark: SparkSession, d: str, *configs: str, vector: bool = False, bitmaps: tuple[str, ...] = ()) -> Items:
    """Documents, with labels and vectors as sides, and the text indexes of these configurations."""
    near = {"content_embedding": vector_index(spark, d)} if vector else {}
    return Items(table(spark, d, "documents"), (labels(spark, d), vectors(spark, d)), {c: text_index(spark, d, "documents", DOCS, c) for c in configs}, near, {}, label_bitmaps(spark, d, *bitmaps) if bitmaps else {})


def parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").withColumn("tags", F.split("p_name", " "))


def orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


def baskets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("suppliers"), F.collect_set("l_returnflag").alias("flags"))


def analytics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("event_id", "concat('s', user_id % 4) AS server_id", "event_type AS operation", "cast(get_json_object(props, '$.k') AS int) AS token_count", "cast(value / 1000 AS decimal(10, 6)) AS cost_usd", "cast(event_id % 500 AS int) AS duration_ms", "unix_timestamp(cast(ts AS timestamp)) AS timestamp")


def metrics(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").selectExpr("event_id", "concat('s', user_id % 4) AS server_id", "CASE event_id % 5 WHEN 0 THEN 'cache' WHEN 1 THEN 'queue' WHEN 2 THEN 'error' ELSE 'query' END AS metric_type", "CASE WHEN event_id % 5 = 0 THEN CASE WHEN user_id % 3 = 0 THEN 'cache_miss' ELSE 'cache_hit' END ELSE event_type END AS metric_name", "cast(value AS decimal(15, 6)) AS value", "unix_timestamp(cast(ts AS timestamp)) AS timestamp")


def cache(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").where("text IS NOT NULL").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    return texts.selectExpr("sha2(text, 256) AS text_hash", "64 AS dimensions", "doc_id AS created", "doc_id + char_length(text) % 1000 AS last_accessed", "doc_id + char_length(text) AS expires", "cast(char_length(text) % 7 AS int) AS hit_count")


def queue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("doc_id AS item_id", "CASE WHEN n_chars > 2000 THEN 'batch_generate_embeddings' ELSE 'generate_embedding' END AS operation", "CASE doc_id % 3 WHEN 0 THEN 50 WHEN 1 THEN 100 ELSE 200 END AS priority")
