"""Registered queries: index maintenance, value preparation, the embedding queue and the circuit breaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions import prepare as P
from seekframe.operators import indexing as I
from seekframe.operators import store as ST
from seekframe.operators.search import search
from seekframe.plans import frames as T
from seekframe.plans.catalog import query
from seekframe.plans.model import FieldSpec, IndexSpec
from seekframe.plans.query import Query
from seekframe.sources import embedding as E
from seekframe.sources.tables import scratch_folder
from seekframe.streaming import queue as Q


def _items(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")


@query("SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id % 7 <> 0 UNION ALL SELECT doc_id, 'new' AS source, lang, n_chars + 2 AS n_chars FROM documents WHERE doc_id % 7 = 0 UNION ALL SELECT doc_id + 10000000, source, lang, n_chars FROM documents WHERE doc_id % 100 = 3")
def upsert_items(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh item is changed twice, the later version wins; some are new."""
    items = _items(spark, d)
    seventh = items.where("doc_id % 7 = 0").withColumn("source", F.lit("new"))
    changes = seventh.withColumn("n_chars", F.col("n_chars") + 1).withColumn("version", F.lit(1)).union(seventh.withColumn("n_chars", F.col("n_chars") + 2).withColumn("version", F.lit(2)))
    changes = changes.union(items.where("doc_id % 100 = 3").withColumn("doc_id", F.col("doc_id") + 10_000_000).withColumn("version", F.lit(1)))
    return I.upsert(items, changes, "doc_id", F.col("version"))


@query("SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_items(spark: SparkSession, d: str) -> DataFrame:
    return I.delete(_items(spark, d), T.table(spark, d, "labels").where("toxic = 1"), "doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_items(spark: SparkSession, d: str) -> DataFrame:
    return I.existing(_items(spark, d), T.table(spark, d, "labels"), "doc_id").select("doc_id")


@query("SELECT doc_id, source, lang, n_chars FROM documents WHERE source <> 'src3'")
def clear_datasource(spark: SparkSession, d: str) -> DataFrame:
    return I.clear(_items(spark, d), T.DOCS, "src3")


_WIDE = IndexSpec("documents", (FieldSpec("n_chars", "integer", -1), FieldSpec("title", "string")), "doc_id", "source", "lang")


@query("SELECT doc_id, source, lang, len([n_chars]) AS n, n_chars AS first, CAST(NULL AS VARCHAR) AS title FROM documents")
def schema_scalar_to_array(spark: SparkSession, d: str) -> DataFrame:
    wide = I.evolve(_items(spark, d), _WIDE)
    return wide.select("doc_id", "source", "lang", F.size("n_chars").cast("long").alias("n"), F.get("n_chars", F.lit(0)).alias("first"), "title")


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS tags FROM part")
def schema_array_to_scalar(spark: SparkSession, d: str) -> DataFrame:
    narrow = IndexSpec("parts", (FieldSpec("tags", "string"),), "p_partkey", "p_brand", "p_type")
    return I.evolve(T.parts(spark, d), narrow).select("p_partkey", "tags")


@query("SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS epoch, o_orderstatus = 'F' AS done, CAST(o_custkey AS BIGINT) AS customer, CAST(o_totalprice AS DOUBLE) AS price FROM orders")
def convert_values(spark: SparkSession, d: str) -> DataFrame:
    """Stored values as plain typed results: dates as epoch seconds, flags as booleans."""
    return T.orders(spark, d).select("o_orderkey", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("epoch"), (F.col("o_orderstatus") == "F").alias("done"), F.col("o_custkey").cast("long").alias("customer"), F.col("o_totalprice").cast("double").alias("price"))


@query(r"SELECT page_id, substring(trim(regexp_replace(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')), 1, 1000000) AS body FROM pages")
def prep_text(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "pages").select("page_id", P.text(F.col("html")).alias("body"))


@query("SELECT doc_id, substring(text, 1, 255) AS short FROM documents")
def prep_string(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", P.string(F.col("text")).alias("short"))


_CLEAN = r"trim(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))"


@query(f"""SELECT doc_id, CASE WHEN length(c) <= 8000 THEN c WHEN last < 8000 AND last > 6400 THEN substring(cut, 1, last::BIGINT) ELSE cut END AS body
FROM (SELECT doc_id, c, substring(c, 1, 8000) AS cut, length(substring(c, 1, 8000)) - strpos(reverse(substring(c, 1, 8000)), ' ') AS last FROM (SELECT doc_id, {_CLEAN} AS c FROM documents))""")
def embed_preprocess(spark: SparkSession, d: str) -> DataFrame:
    """Cut at 8000 characters, at a space if there is one in the last fifth: the limit of the smallest provider."""
    return T.table(spark, d, "documents").select("doc_id", P.embedding_text(F.col("text")).alias("body"))


@query("SELECT doc_id, CAST(ceil(strlen(coalesce(text, '')) / 4) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", P.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS body FROM part")
def embedding_text(spark: SparkSession, d: str) -> DataFrame:
    return T.parts(spark, d).select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("body"))


@query(f"SELECT doc_id, sha256(concat_ws(chr(31), {_CLEAN.replace('text,', chr(99) + 'oalesce(text, ' + chr(39) * 2 + '),')}, coalesce(lang, ''))) AS text_hash FROM documents")
def cache_key(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", P.cache_key(F.col("text"), F.col("lang")).alias("text_hash"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(date_trunc('day', ts)) // 1000000 END AS epoch FROM events")
def prep_date(spark: SparkSession, d: str) -> DataFrame:
    """From epoch seconds, from dates, and from text that is no date."""
    raw = F.when(F.col("event_id") % 3 == 0, F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")).when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("soon")
    return T.table(spark, d, "events").select("event_id", F.unix_timestamp(P.date(raw)).alias("epoch"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false WHEN 'purchase' THEN true END AS flag FROM events")
def prep_boolean(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    raw = F.when(kind == "click", " YES ").when(kind == "view", "off").when(kind == "purchase", "1").otherwise(kind)
    return T.table(spark, d, "events").select("event_id", P.boolean(raw).alias("flag"))


@query("SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(trunc(value) AS BIGINT) END AS whole, CASE WHEN event_id % 4 <> 0 THEN round(CAST(value AS DECIMAL(10, 2))::DOUBLE, 2) END AS exact FROM events")
def prep_numeric(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("n"), F.col("value").cast("string"))).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return T.table(spark, d, "events").select("event_id", P.integer(raw).alias("whole"), F.round(P.decimal(raw).cast("double"), 2).alias("exact"))


@query("SELECT event_id, 2::BIGINT AS numbers, user_id + event_id % 2 AS total, 2::BIGINT AS texts FROM events")
def prep_array(spark: SparkSession, d: str) -> DataFrame:
    """Zeros stay among numbers and texts; empty texts, nulls and words among numbers go."""
    numbers = P.integers(F.array(F.col("user_id").cast("string"), F.lit("x"), (F.col("event_id") % 2).cast("string"), F.lit(None).cast("string")))
    texts = P.strings(F.array(F.col("event_type"), F.lit(""), F.lit("0"), F.lit(None).cast("string")))
    total = F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)
    return T.table(spark, d, "events").select("event_id", F.size(numbers).cast("long").alias("numbers"), total.alias("total"), F.size(texts).cast("long").alias("texts"))


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN user_id END AS target FROM events")
def extract_entity_id(spark: SparkSession, d: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    raw = F.when(F.col("event_id") % 3 == 0, user).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"target_id": '), user, F.lit("}"))).otherwise("none")
    return T.table(spark, d, "events").select("event_id", P.entity_id(raw).alias("target"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT doc_id, 16::BIGINT AS dimensions, CAST(NULL AS VARCHAR) AS error FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def stream_queue(spark: SparkSession, d: str) -> DataFrame:
    """Queue a task for every document, run the stream until the queue is empty, return the embeddings' digests."""
    folder = scratch_folder(spark, "queue")
    Q.enqueue(Q.tasks(T.table(spark, d, "documents"), "doc_id", "text", "s1", "documents", 1), f"{folder}/in")

    def work(batch: DataFrame, number: int) -> None:
        # overwriting the batch's own folder makes a repeated delivery harmless
        E.embed(batch, E.HashProvider(16), "item_id", "text_content").write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    stream = Q.process(spark, f"{folder}/in", f"{folder}/state", work)
    stream.awaitTermination()
    done = spark.read.schema("item_id string, embedding array<float>, error string").parquet(f"{folder}/out/*")
    return done.select(F.col("item_id").cast("long").alias("doc_id"), F.size("embedding").cast("long").alias("dimensions"), "error")


#: Fixed values of the registered replay: failures to open, seconds to rest, successes to close.
_BREAKER = (2, 60, 3)


@query(f"""WITH RECURSIVE calls AS (
  SELECT user_id AS server, event_id, epoch_us(ts) // 1000000 AS moment, event_type <> 'error' AS good, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000, event_id) AS n FROM events),
s AS (
  SELECT server, event_id, n, 'closed' AS state, CASE WHEN good THEN 0 ELSE 1 END AS failures, 0 AS successes, 0::BIGINT AS opened FROM calls WHERE n = 1
  UNION ALL
  SELECT server, event_id, n, CASE WHEN was = 'open' THEN 'open' WHEN good THEN CASE WHEN was = 'half_open' AND successes + 1 < {_BREAKER[2]} THEN 'half_open' ELSE 'closed' END WHEN was = 'half_open' OR failures + 1 >= {_BREAKER[0]} THEN 'open' ELSE was END,
    CASE WHEN was = 'open' THEN failures WHEN good THEN 0 WHEN was = 'half_open' OR failures + 1 >= {_BREAKER[0]} THEN 0 ELSE failures + 1 END,
    CASE WHEN was = 'half_open' AND good THEN successes + 1 ELSE successes END,
    CASE WHEN was <> 'open' AND NOT good AND (was = 'half_open' OR failures + 1 >= {_BREAKER[0]}) THEN moment ELSE opened END
  FROM (SELECT c.server, c.event_id, c.n, c.moment, c.good, s.failures, s.opened,
      CASE WHEN s.state = 'open' AND c.moment - s.opened >= {_BREAKER[1]} THEN 'half_open' ELSE s.state END AS was,
      CASE WHEN s.state = 'open' AND c.moment - s.opened >= {_BREAKER[1]} THEN 0 ELSE s.successes END AS successes
    FROM s JOIN calls c ON c.server = s.server AND c.n = s.n + 1))
SELECT server, event_id, state FROM s""")
def circuit_breaker_states(spark: SparkSession, d: str) -> DataFrame:
    """The breaker's state after each call of a server, in order of time: errors are failures.

    The state depends on all calls before, so each server's calls are a sorted stream, read with a breaker's few numbers
    as the only state; no server's history is held in memory."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    events = T.table(spark, d, "events").select(F.col("user_id").alias("server"), "event_id", at.alias("at"), (F.col("event_type") != "error").alias("good"))
    return E.breaker_states(events, "server", "event_id", "at", "good", *_BREAKER)


@query("SELECT doc_id, source, lang, n_chars FROM documents UNION ALL SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id % 50 = 1")
def append_items(spark: SparkSession, d: str) -> DataFrame:
    """A plain insert: rows are added whatever their ids."""
    items = _items(spark, d)
    return I.append(items, items.where("doc_id % 50 = 1"))


@query("SELECT doc_id, source, lang, n_chars, quality = 1 AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def migrate_index(spark: SparkSession, d: str) -> DataFrame:
    """Documents for a backend without vectors."""
    source = T.docs(spark, d)
    rows, index = I.migrate(source.attach(source.base, ("quality", "content_embedding"), "doc_id"), T.DOCS)
    return rows.select(*index.system, "n_chars", "quality")


@query("SELECT doc_id::VARCHAR AS item_id, 'generate_embedding' AS operation, 100 AS priority, sha256(text) AS text_hash FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def queue_tasks(spark: SparkSession, d: str) -> DataFrame:
    """The tasks of items that are indexed while their embeddings are made later."""
    _, tasks = I.queued(T.table(spark, d, "documents"), T.DOCS, F.col("text"), "s1", 1)
    return tasks.select("item_id", "operation", "priority", F.sha2("text_content", 256).alias("text_hash"))


@query("SELECT doc_id::VARCHAR AS item_id, 16::BIGINT AS dimensions FROM documents")
def regenerate_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """One queued task makes all embeddings of an index anew."""
    folder = scratch_folder(spark, "regenerate")
    Q.enqueue(Q.regenerate_task(spark, "s1", "documents", 1), f"{folder}/in")
    worker = Q.regenerator(
        lambda index: T.table(spark, d, index).select(F.col("doc_id").cast("string").alias("item_id"), "text"),
        lambda rows: E.embed(rows, E.HashProvider(16), "item_id", "text"),
        lambda index, made, number: made.write.mode("overwrite").parquet(f"{folder}/out/batch={number}"),
    )
    Q.process(spark, f"{folder}/in", f"{folder}/state", Q.dispatch({"regenerate_index_embeddings": worker})).awaitTermination()
    return spark.read.schema("item_id string, embedding array<float>, error string").parquet(f"{folder}/out/*").select("item_id", F.size("embedding").cast("long").alias("dimensions"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 3 WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS attempts, CASE WHEN doc_id % 7 = 0 THEN 'dead' ELSE 'done' END AS state FROM documents WHERE text IS NOT NULL AND trim(text) <> ''")
def queue_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Single and batch tasks for all documents, with a service that refuses every seventh, and every fifth at first: what became of each."""
    folder = scratch_folder(spark, "outcomes")
    rows = T.table(spark, d, "documents")
    Q.enqueue(Q.tasks(rows.where("n_chars <= 2000"), "doc_id", "text", "s1", "documents", 1), f"{folder}/in")
    Q.enqueue(Q.batch_tasks(rows.where("n_chars > 2000"), "doc_id", "text", "s1", "documents", 1), f"{folder}/in")

    def worker(tasks: DataFrame, number: int) -> DataFrame:
        made = E.embed(tasks, E.HashProvider(16), "item_id", "text_content")
        told = made.join(tasks.select("item_id", "index_id", "attempt"), "item_id")
        number = F.col("item_id").cast("long")
        refused = F.when(number % 7 == 0, "refused").when((number % 5 == 0) & (F.col("attempt") == 1), "busy")
        return told.select("index_id", "item_id", F.coalesce("error", refused).alias("error"))

    Q.drain(spark, f"{folder}/in", f"{folder}/state", worker)
    last = Q.ledger(spark, f"{folder}/in").groupBy("item_id").agg(F.max("attempt").alias("attempts"), F.max_by("state", "attempt").alias("state"))
    return last.select(F.col("item_id").cast("long").alias("doc_id"), "attempts", "state")


@query("SELECT doc_id::VARCHAR AS doc_id, source, lang, length(trim(regexp_replace(source || ' - ' || lang, '[ \\t\\n]+', ' ', 'g')))::BIGINT AS size, [source, lang] AS names FROM documents")
def unwrap_values(spark: SparkSession, d: str) -> DataFrame:
    """Raw fields as structs with a value, and arrays of them, become plain values of the index."""
    index = IndexSpec("raw", (FieldSpec("body", "text"), FieldSpec("names", "string", -1)), "doc_id", "source", "lang")
    text = F.concat("source", F.lit(" - "), "lang")
    raw = T.table(spark, d, "documents").select("doc_id", "source", "lang", F.struct(text.alias("value"), F.lit("plain").alias("format")).alias("body"), F.array(F.struct(F.col("source").alias("value")), F.struct(F.col("lang").alias("value"))).alias("names"))
    return I.prepare_items(raw, index).select("doc_id", "source", "lang", F.char_length("body").cast("long").alias("size"), "names")


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 3 <> 1 AND lang = 'en' UNION ALL SELECT doc_id, lang, n_chars + 1 FROM documents WHERE doc_id % 3 = 1 AND doc_id % 2 = 0 AND lang = 'en'")
def store_changes(spark: SparkSession, d: str) -> DataFrame:
    """A store after a third of its items were upserted, and half of these deleted: searched by its own state."""
    path, index = scratch_folder(spark, "store"), T.DOC_SIZES
    layout = ST.Layout(index, texts=(), files=2)
    rows = T.table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    third = rows.where("doc_id % 3 = 1")
    ST.create(spark, path, layout, rows)
    ST.upsert(spark, path, layout, third.withColumn("n_chars", F.col("n_chars") + 1))
    ST.delete(spark, path, layout, third.where("doc_id % 2 = 1").select("doc_id"))
    return search(ST.open_(spark, path, layout), index, Query(languages=("en",))).rows.select("doc_id", "lang", "n_chars")
