"""Registered queries: cost, metrics, rollups, caches, queues and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators import analytics as A
from seekframe.operators.indexing import read_table, replace_table
from seekframe.plans import frames as T
from seekframe.plans.catalog import query
from seekframe.sources import embedding as E
from seekframe.sources.tables import scratch_folder
from seekframe.streaming import queue as Q
from seekframe.streaming.queue import hourly_stream

WEEK, MONTH = A.period("7d"), A.period("30d")
A7 = f"(SELECT * FROM {T.ANALYTICS_SQL} WHERE timestamp > {T.AS_OF - WEEK} AND timestamp <= {T.AS_OF})"
M7 = f"(SELECT * FROM {T.METRICS_SQL} WHERE timestamp > {T.AS_OF - WEEK} AND timestamp <= {T.AS_OF})"
DATE = "strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d')"


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


@query(f"SELECT round(coalesce(sum(cost_usd), 0)::DOUBLE, 6) AS total_cost, coalesce(sum(token_count), 0)::BIGINT AS total_tokens, count(*) AS total_calls, round(coalesce(sum(cost_usd), 0)::DOUBLE * 30 / 7, 6) AS projected_monthly FROM {A7} WHERE server_id = 's1'")
def cost_summary(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.cost_summary(T.analytics(spark, d), T.AS_OF, WEEK, "s1"), "total_cost", "projected_monthly")


@query(f"SELECT operation, round(sum(cost_usd)::DOUBLE, 6) AS cost, sum(token_count)::BIGINT AS tokens, count(*) AS calls FROM {A7} GROUP BY operation")
def cost_by_operation(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.cost_by_operation(T.analytics(spark, d), T.AS_OF, WEEK), "cost")


@query(f"SELECT round(a, 6) AS first_half, round(b, 6) AS second_half, round(CASE WHEN a > 0 THEN (b - a) / a * 100 ELSE 0 END, 6) AS trend_percent FROM (SELECT sum(cost_usd) FILTER (timestamp <= {T.AS_OF - WEEK // 2})::DOUBLE AS a, sum(cost_usd) FILTER (timestamp > {T.AS_OF - WEEK // 2})::DOUBLE AS b FROM {A7} WHERE server_id = 's2')")
def cost_trend(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.cost_trend(T.analytics(spark, d), T.AS_OF, WEEK, "s2"), "first_half", "second_half", "trend_percent")


@query(f"SELECT event_id, server_id, metric_name, timestamp FROM {T.METRICS_SQL} WHERE metric_type = 'cache' ORDER BY timestamp DESC, event_id DESC LIMIT 100")
def recent_cache_metrics(spark: SparkSession, d: str) -> DataFrame:
    return A.recent(T.metrics(spark, d), F.col("metric_type") == "cache", 100, "event_id").select("event_id", "server_id", "metric_name", "timestamp")


@query(f"""SELECT server_id, queries, round(latency, 2) AS avg_query_time, calls AS api_calls, round(cost::DOUBLE, 6) AS cost, tokens, round(coalesce(hits / nullif(hits + misses, 0), 0) * 100, 2) AS cache_hit_rate, round(errors / (queries + calls) * 100, 2) AS error_rate
FROM (SELECT server_id, count(*) FILTER (metric_type = 'query') AS queries, avg(value) FILTER (metric_type = 'query') AS latency, count(*) FILTER (metric_name = 'cache_hit')::DOUBLE AS hits, count(*) FILTER (metric_name = 'cache_miss')::DOUBLE AS misses, count(*) FILTER (metric_type = 'error')::DOUBLE AS errors FROM {M7} GROUP BY 1) m
JOIN (SELECT server_id, count(*) AS calls, sum(cost_usd) AS cost, sum(token_count)::BIGINT AS tokens FROM {A7} GROUP BY 1) a USING (server_id)""")
def server_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = A.server_metrics(T.metrics(spark, d), T.analytics(spark, d), T.AS_OF, WEEK)
    return out.withColumns({"cost": F.round(F.col("cost").cast("double"), 6), "avg_query_time": F.col("avg_query_time").cast("double")})


@query(f"""SELECT (timestamp // 3600) * 3600 AS hour, round(coalesce(avg(value) FILTER (metric_type = 'query'), 0)::DOUBLE, 6) AS avg_latency,
round(coalesce(count(*) FILTER (metric_name = 'cache_hit')::DOUBLE / nullif(count(*) FILTER (metric_name IN ('cache_hit', 'cache_miss')), 0), 0) * 100, 6) AS hit_percent,
round(coalesce(avg(value) FILTER (metric_type = 'queue'), 0)::DOUBLE, 6) AS avg_queue, round(count(*) FILTER (metric_type = 'error')::DOUBLE / count(*) * 100, 6) AS error_percent FROM {T.METRICS_SQL} GROUP BY 1""")
def hourly_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.hourly(T.metrics(spark, d)), "avg_latency", "hit_percent", "avg_queue", "error_percent")


@query(f"SELECT {DATE} AS date, server_id, operation, count(*) AS total_calls, round(sum(cost_usd)::DOUBLE, 6) AS total_cost, sum(token_count)::BIGINT AS total_tokens, round(avg(duration_ms), 6) AS avg_duration FROM {T.ANALYTICS_SQL} WHERE timestamp < {T.AS_OF // 86400 * 86400} GROUP BY ALL")
def daily_cost_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.daily_costs(T.analytics(spark, d), T.AS_OF), "total_cost", "avg_duration")


@query(f"SELECT {DATE} AS date, server_id, metric_type, metric_name, count(*) AS n, round(avg(value)::DOUBLE, 6) AS avg_value, round(min(value)::DOUBLE, 6) AS min_value, round(max(value)::DOUBLE, 6) AS max_value FROM {T.METRICS_SQL} WHERE timestamp < {T.AS_OF // 86400 * 86400} GROUP BY ALL")
def daily_metric_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.daily_metrics(T.metrics(spark, d), T.AS_OF), "avg_value", "min_value", "max_value")


@query(f"SELECT event_id, operation FROM {T.ANALYTICS_SQL} WHERE timestamp >= {T.AS_OF - 10 * 86400}")
def retention_filter(spark: SparkSession, d: str) -> DataFrame:
    return A.retained(T.analytics(spark, d), T.AS_OF, 10).select("event_id", "operation")


@query(f"""SELECT server_id, total_calls, round(total_cost::DOUBLE, 6) AS total_cost, total_tokens, last_activity, round(coalesce(latency, 0)::DOUBLE, 6) AS latency_24h, round(coalesce(hits / nullif(asked, 0), 0), 6) AS hit_rate_24h
FROM (SELECT server_id, count(*) AS total_calls, sum(cost_usd) AS total_cost, sum(token_count)::BIGINT AS total_tokens, max(timestamp) AS last_activity FROM {T.ANALYTICS_SQL} GROUP BY 1) a
LEFT JOIN (SELECT server_id, avg(value) FILTER (metric_type = 'query') AS latency, count(*) FILTER (metric_name = 'cache_hit')::DOUBLE AS hits, count(*) FILTER (metric_name IN ('cache_hit', 'cache_miss')) AS asked FROM {T.METRICS_SQL} WHERE timestamp > {T.AS_OF - 86400} AND timestamp <= {T.AS_OF} GROUP BY 1) m USING (server_id)""")
def server_stats(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.server_stats(T.analytics(spark, d), T.metrics(spark, d), T.AS_OF), "total_cost", "latency_24h", "hit_rate_24h")


@query(f"SELECT count(*) AS entries, sum(hit_count)::BIGINT AS hits, avg(dimensions) AS avg_dimensions, min(created) AS oldest, max(created) AS newest, count(*) FILTER (expires <= {T.CACHE_NOW}) AS expired, round(sum(hit_count)::DOUBLE / (sum(hit_count) + count(*)), 6) AS hit_rate FROM {T.CACHE_SQL}")
def cache_stats(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.cache_stats(T.cache(spark, d), T.CACHE_NOW), "hit_rate")


@query(f"SELECT sum(hit_count)::DOUBLE * 125 AS saved_tokens, round(sum(hit_count)::DOUBLE * 125 / 1000 * 0.0001, 6) AS saved_usd FROM {T.CACHE_SQL}")
def cache_savings(spark: SparkSession, d: str) -> DataFrame:
    return _round(A.cache_savings(T.cache(spark, d)), "saved_usd")


@query(f"SELECT operation, priority, count(*) AS pending FROM {T.QUEUE_SQL} GROUP BY ALL")
def queue_stats(spark: SparkSession, d: str) -> DataFrame:
    return A.queue_stats(T.queue(spark, d))


@query("SELECT event_id, CASE WHEN value > 8 THEN 'critical' WHEN value > 4 THEN 'warning' ELSE 'healthy' END AS a, CASE WHEN value > 8 OR event_id % 500 > 400 THEN 'critical' WHEN value > 4 OR event_id % 500 > 200 THEN 'warning' ELSE 'healthy' END AS overall FROM events")
def health_grade(spark: SparkSession, d: str) -> DataFrame:
    a, b = A.grade(F.col("value"), (4, 8)), A.grade(F.col("event_id") % 500, (200, 400))
    return T.table(spark, d, "events").select("event_id", a.alias("a"), A.worst(a, b).alias("overall"))


@query("SELECT event_id, least(CASE event_type WHEN 'error' THEN 80 WHEN 'purchase' THEN 60 WHEN 'click' THEN 40 ELSE 20 END + CASE event_id % 5 WHEN 0 THEN 20 WHEN 1 THEN 15 WHEN 2 THEN 10 WHEN 3 THEN 5 ELSE 0 END + CASE WHEN hour(ts) BETWEEN 9 AND 16 THEN 10 ELSE 0 END + least(2 * (user_id % 15), 20), 100)::BIGINT AS priority FROM events")
def remediation_priority(spark: SparkSession, d: str) -> DataFrame:
    severity = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "purchase", "high").when(F.col("event_type") == "click", "medium").otherwise("unknown")
    scope = F.element_at(F.array(*map(F.lit, ("system", "server", "index", "user", "other"))), (F.col("event_id") % 5 + 1).cast("int"))
    points = A.remediation_priority(severity, scope, F.hour("ts").between(9, 16), F.col("user_id") % 15)
    return T.table(spark, d, "events").select("event_id", points.cast("long").alias("priority"))


@query(f"SELECT text_hash, hit_count, {T.CACHE_NOW}::BIGINT AS last_accessed FROM {T.CACHE_SQL} WHERE expires > {T.CACHE_NOW}")
def cache_get(spark: SparkSession, d: str) -> DataFrame:
    return E.valid_entries(T.cache(spark, d), T.CACHE_NOW).select("text_hash", "hit_count", F.lit(T.CACHE_NOW).cast("long").alias("last_accessed"))


@query(f"SELECT doc_id, c.text_hash IS NOT NULL AS hit FROM documents d LEFT JOIN (SELECT * FROM {T.CACHE_SQL} WHERE expires > {T.CACHE_NOW}) c ON sha256(d.text) = c.text_hash")
def cache_hits_misses(spark: SparkSession, d: str) -> DataFrame:
    asked = T.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    return E.lookup(asked, T.cache(spark, d).withColumn("embedding", F.array().cast("array<float>")), T.CACHE_NOW).select("doc_id", "hit")


@query(f"SELECT text_hash FROM {T.CACHE_SQL} WHERE expires > {T.CACHE_NOW} ORDER BY last_accessed DESC, hit_count DESC, text_hash LIMIT 300")
def cache_evict(spark: SparkSession, d: str) -> DataFrame:
    return E.evict(T.cache(spark, d), T.CACHE_NOW, 300).select("text_hash")


_SIZES_SQL = "SELECT doc_id, coalesce(ceil(strlen(text) / 4), 0)::BIGINT AS tokens, row_number() OVER (ORDER BY doc_id) AS n FROM documents"


@query(f"""WITH RECURSIVE r AS ({_SIZES_SQL}),
c AS (SELECT doc_id, tokens, n, 0::BIGINT AS call, 1 AS held, tokens AS total FROM r WHERE n = 1
  UNION ALL SELECT r.doc_id, r.tokens, r.n, CASE WHEN held >= {E.CALL_INPUTS} OR total + r.tokens > {E.CALL_TOKENS} THEN call + 1 ELSE call END,
    CASE WHEN held >= {E.CALL_INPUTS} OR total + r.tokens > {E.CALL_TOKENS} THEN 1 ELSE held + 1 END, CASE WHEN held >= {E.CALL_INPUTS} OR total + r.tokens > {E.CALL_TOKENS} THEN r.tokens ELSE total + r.tokens END
  FROM c JOIN r ON r.n = c.n + 1)
SELECT doc_id, tokens, call FROM c""")
def token_batches(spark: SparkSession, d: str) -> DataFrame:
    """The call in which each document's text goes to an embedding service; calls are filled in order of ids, one after another."""
    rows = T.table(spark, d, "documents").select("doc_id", F.ceil(F.octet_length("text") / 4).cast("long").alias("tokens"))
    return E.call_numbers(rows, "doc_id", "tokens")


_TOUCHED_SQL = f"""SELECT c.text_hash, hit_count + coalesce(a, 0) + coalesce(b, 0) AS hit_count, greatest(last_accessed, CASE WHEN b = 1 THEN {T.CACHE_NOW + 1} WHEN a = 1 THEN {T.CACHE_NOW} ELSE 0 END)::BIGINT AS last_accessed
FROM (SELECT * FROM {T.CACHE_SQL} WHERE expires > {T.CACHE_NOW + 1}) c
LEFT JOIN (SELECT DISTINCT sha256(text) AS text_hash, 1 AS a FROM documents WHERE doc_id % 3 = 0) x USING (text_hash)
LEFT JOIN (SELECT DISTINCT sha256(text) AS text_hash, 1 AS b FROM documents WHERE doc_id % 5 = 0) y USING (text_hash)"""


@query(f"SELECT text_hash, hit_count::BIGINT AS hit_count, last_accessed FROM ({_TOUCHED_SQL}) ORDER BY last_accessed DESC, hit_count DESC, text_hash LIMIT 300")
def cache_touch_evict(spark: SparkSession, d: str) -> DataFrame:
    """Two look-ups note their hits in the log; compaction folds them in and evicts by what they say."""
    path, log = scratch_folder(spark, "cache"), scratch_folder(spark, "cache-log")
    replace_table(T.cache(spark, d).withColumn("embedding", F.array().cast("array<float>")), path)
    asked = T.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("text_hash"))
    for by, now in ((3, T.CACHE_NOW), (5, T.CACHE_NOW + 1)):
        E.touch(asked.where(F.col("doc_id") % by == 0), read_table(spark, path), now, log)
    E.compact(spark, path, log, T.CACHE_NOW + 1, 300)
    return read_table(spark, path).select("text_hash", F.col("hit_count").cast("long").alias("hit_count"), "last_accessed")


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY 1")
def stream_hourly(spark: SparkSession, d: str) -> DataFrame:
    """The streaming aggregation, run over the table; tests hold the stream to this result."""
    events = T.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return hourly_stream(events).select(F.col("hour").cast("timestamp_ntz").alias("hour"), "n", F.round("avg_value", 6).alias("avg_value"))


_OF_MODEL = "(SELECT *, CASE hit_count % 3 WHEN 0 THEN 'small' ELSE 'large' END AS model, CASE hit_count % 2 WHEN 0 THEN 'articles' ELSE 'pages' END AS index_id FROM " + T.CACHE_SQL + ")"


def _of_model(spark: SparkSession, d: str) -> DataFrame:
    model, index = F.when(F.col("hit_count") % 3 == 0, "small").otherwise("large"), F.when(F.col("hit_count") % 2 == 0, "articles").otherwise("pages")
    return T.cache(spark, d).withColumns({"model": model, "index_id": index})


@query(f"SELECT text_hash FROM {_OF_MODEL} WHERE model <> 'large'")
def cache_invalidate_model(spark: SparkSession, d: str) -> DataFrame:
    """What stays of the cache when a model's embeddings are void."""
    return E.invalidate(_of_model(spark, d), model="large").select("text_hash")


@query(f"SELECT text_hash FROM {_OF_MODEL} WHERE NOT (index_id = 'pages' AND model = 'small')")
def cache_invalidate_index(spark: SparkSession, d: str) -> DataFrame:
    return E.invalidate(_of_model(spark, d), index="pages", model="small").select("text_hash")


@query("SELECT item_id, operation FROM " + T.QUEUE_SQL + " WHERE item_id NOT IN (SELECT doc_id FROM labels)")
def queue_after_delete(spark: SparkSession, d: str) -> DataFrame:
    """Tasks of deleted items leave the queue."""
    return Q.without_items(T.queue(spark, d), T.table(spark, d, "labels").select(F.col("doc_id").alias("item_id"))).select("item_id", "operation")


@query(f"SELECT text_hash FROM {T.CACHE_SQL} WHERE text_hash NOT IN (SELECT sha256(text) FROM documents WHERE text IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels)) OR text_hash IN (SELECT sha256(text) FROM documents WHERE text IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels))")
def cache_after_delete(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings that only deleted items' texts use leave the cache."""
    used = T.table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("item_id"), F.sha2("text", 256).alias("text_hash"))
    return E.forget(T.cache(spark, d), used, T.table(spark, d, "labels").select(F.col("doc_id").alias("item_id"))).select("text_hash")


@query("SELECT user_id % 20 AS server, count(*) AS total, count_if(event_type = 'error') AS failures, round(count_if(event_type = 'error')::DOUBLE / count(*), 6) AS rate, count_if(event_type = 'error')::DOUBLE / count(*) >= 0.2 AS fallback FROM events GROUP BY 1")
def failure_rate(spark: SparkSession, d: str) -> DataFrame:
    """Servers whose calls fail so often that they fall back to text alone."""
    calls = T.table(spark, d, "events").withColumn("server", F.col("user_id") % 20)
    return _round(A.failing(calls, "server", F.col("event_type") == "error", 0.2), "rate")
