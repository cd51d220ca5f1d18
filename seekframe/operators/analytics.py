"""Search analytics: cost, server and hourly metrics, rollups, retention, cache and queue statistics, health.

Tables: analytics(server_id, operation, token_count, cost_usd, duration_ms, timestamp) and metrics(server_id,
metric_type, metric_name, value, timestamp), with timestamps in epoch seconds. ``as_of`` is always a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR, DAY = 3600, 86400
# Reporting periods in seconds, and the assumptions of the savings estimate.
PERIODS = {"1h": HOUR, "24h": DAY, "7d": 7 * DAY, "30d": 30 * DAY, "90d": 90 * DAY}
SAVED_CHARS, TOKENS_PER_CHAR, USD_PER_1K = 500, 0.25, 0.0001
# Health thresholds (warning, critical) and severities of remediation.
HEALTH = {"database_ms": (1000, 5000), "cache_ms": (100, 500), "queue_items": (1000, 10000)}
SEVERITY = {"critical": 80, "high": 60, "medium": 40, "low": 20}
SCOPE = {"system": 20, "server": 15, "index": 10, "user": 5}


def period(name: str) -> int:
    return PERIODS.get(name, PERIODS["7d"])


def within(df: DataFrame, as_of: int, seconds: int, server: str | None = None) -> DataFrame:
    out = df.where((F.col("timestamp") > as_of - seconds) & (F.col("timestamp") <= as_of))
    return out if server is None else out.where(F.col("server_id") == server)


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def cost_summary(analytics: DataFrame, as_of: int, seconds: int, server: str | None = None) -> DataFrame:
    out = within(analytics, as_of, seconds, server).agg(F.coalesce(F.sum("cost_usd"), F.lit(0)).alias("total_cost"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"), F.count(F.lit(1)).alias("total_calls"))
    return out.withColumn("projected_monthly", F.col("total_cost").cast("double") * 30 / (seconds / DAY))


def cost_by_operation(analytics: DataFrame, as_of: int, seconds: int, server: str | None = None) -> DataFrame:
    return within(analytics, as_of, seconds, server).groupBy("operation").agg(F.sum("cost_usd").alias("cost"), F.sum("token_count").alias("tokens"), F.count(F.lit(1)).alias("calls"))


def cost_trend(analytics: DataFrame, as_of: int, seconds: int, server: str | None = None) -> DataFrame:
    """Percent from the first to the second half of a period of at least two days; 0 without costs in the first."""
    middle = as_of - seconds // 2
    early, late = F.sum(F.when(F.col("timestamp") <= middle, F.col("cost_usd"))), F.sum(F.when(F.col("timestamp") > middle, F.col("cost_usd")))
    out = within(analytics, as_of, seconds, server).agg(F.coalesce(early, F.lit(0)).cast("double").alias("first_half"), F.coalesce(late, F.lit(0)).cast("double").alias("second_half"))
    change = F.when(F.col("first_half") > 0, (F.col("second_half") - F.col("first_half")) / F.col("first_half") * 100).otherwise(0.0)
    return out.withColumn("trend_percent", change if seconds >= 2 * DAY else F.lit(0.0))


def recent(df: DataFrame, condition: Column, most: int, tie: str) -> DataFrame:
    """The latest rows; a top-k."""
    return df.where(condition).orderBy(F.desc("timestamp"), F.desc(tie)).limit(most)


def server_metrics(metrics: DataFrame, analytics: DataFrame, as_of: int, seconds: int) -> DataFrame:
    """One row for each server: queries, latency, calls, cost, tokens, cache hit rate and error rate."""
    m = within(metrics, as_of, seconds).groupBy("server_id").agg(
        F.count_if(F.col("metric_type") == "query").alias("queries"),
        F.avg(F.when(F.col("metric_type") == "query", F.col("value"))).alias("latency"),
        F.count_if(F.col("metric_name") == "cache_hit").alias("hits"), F.count_if(F.col("metric_name") == "cache_miss").alias("misses"),
        F.count_if(F.col("metric_type") == "error").alias("errors"),
    )
    a = within(analytics, as_of, seconds).groupBy("server_id").agg(F.count(F.lit(1)).alias("calls"), F.sum("cost_usd").alias("cost"), F.sum("token_count").alias("tokens"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = m.join(a, "server_id", "full_outer")
    return out.select(
        "server_id", zero("queries").alias("queries"), F.round(F.coalesce("latency", F.lit(0.0)), 2).alias("avg_query_time"), zero("calls").alias("api_calls"),
        zero("cost").alias("cost"), zero("tokens").alias("tokens"), F.round(ratio(F.col("hits"), F.col("hits") + F.col("misses")) * 100, 2).alias("cache_hit_rate"),
        F.round(ratio(zero("errors"), zero("queries") + zero("calls")) * 100, 2).alias("error_rate"),
    )


def hourly(metrics: DataFrame) -> DataFrame:
    """By hour: average latency, cache hit percent, average queue size, error percent."""
    hour = F.floor(F.col("timestamp") / HOUR) * HOUR
    hits = F.col("metric_name") == "cache_hit"
    cached = F.col("metric_name").isin("cache_hit", "cache_miss")
    return metrics.groupBy(hour.cast("long").alias("hour")).agg(
        F.coalesce(F.avg(F.when(F.col("metric_type") == "query", F.col("value"))), F.lit(0.0)).alias("avg_latency"),
        (ratio(F.count_if(hits), F.count_if(cached)) * 100).alias("hit_percent"),
        F.coalesce(F.avg(F.when(F.col("metric_type") == "queue", F.col("value"))), F.lit(0.0)).alias("avg_queue"),
        (ratio(F.count_if(F.col("metric_type") == "error"), F.count(F.lit(1))) * 100).alias("error_percent"),
    )


def day_of(timestamp: Column) -> Column:
    return F.date_format(F.timestamp_seconds(timestamp), "yyyy-MM-dd")


def daily_costs(analytics: DataFrame, as_of: int) -> DataFrame:
    """One row for each complete day, server and operation."""
    done = analytics.where(F.col("timestamp") < as_of // DAY * DAY)
    return done.groupBy(day_of(F.col("timestamp")).alias("date"), "server_id", "operation").agg(
        F.count(F.lit(1)).alias("total_calls"), F.sum("cost_usd").alias("total_cost"), F.sum("token_count").alias("total_tokens"), F.avg("duration_ms").alias("avg_duration"))


def daily_metrics(metrics: DataFrame, as_of: int) -> DataFrame:
    """As daily_costs, for metrics; a frame of its own, never added to the table it sums up."""
    done = metrics.where(F.col("timestamp") < as_of // DAY * DAY)
    return done.groupBy(day_of(F.col("timestamp")).alias("date"), "server_id", "metric_type", "metric_name").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))


def merge_rollup(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Days computed anew replace their rows; all others stay."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def retained(analytics: DataFrame, as_of: int, days: int = 90) -> DataFrame:
    return analytics.where(F.col("timestamp") >= as_of - days * DAY)


def server_stats(analytics: DataFrame, metrics: DataFrame, as_of: int) -> DataFrame:
    """Totals and last activity of each server, and its latency and hit rate of the last day."""
    a = analytics.groupBy("server_id").agg(F.count(F.lit(1)).alias("total_calls"), F.sum("cost_usd").alias("total_cost"), F.sum("token_count").alias("total_tokens"), F.max("timestamp").alias("last_activity"))
    m = within(metrics, as_of, DAY).groupBy("server_id").agg(
        F.avg(F.when(F.col("metric_type") == "query", F.col("value"))).alias("latency"),
        ratio(F.count_if(F.col("metric_name") == "cache_hit"), F.count_if(F.col("metric_name").isin("cache_hit", "cache_miss"))).alias("hit_rate"))
    return a.join(m, "server_id", "left").select("server_id", "total_calls", "total_cost", "total_tokens", "last_activity", F.coalesce("latency", F.lit(0.0)).alias("latency_24h"), F.coalesce("hit_rate", F.lit(0.0)).alias("hit_rate_24h"))


def cache_stats(cache: DataFrame, now: int) -> DataFrame:
    return cache.agg(
        F.count(F.lit(1)).alias("entries"), F.coalesce(F.sum("hit_count"), F.lit(0)).alias("hits"), F.avg("dimensions").alias("avg_dimensions"),
        F.min("created").alias("oldest"), F.max("created").alias("newest"), F.count_if(F.col("expires") <= now).alias("expired"),
        ratio(F.sum("hit_count"), F.sum("hit_count") + F.count(F.lit(1))).alias("hit_rate"))


def cache_savings(cache: DataFrame) -> DataFrame:
    """Tokens and cost that cache hits saved, under the stated assumptions."""
    tokens = F.coalesce(F.sum("hit_count"), F.lit(0)).cast("double") * SAVED_CHARS * TOKENS_PER_CHAR
    return cache.agg(tokens.alias("saved_tokens"), (tokens / 1000 * USD_PER_1K).alias("saved_usd"))


def queue_stats(queue: DataFrame) -> DataFrame:
    return queue.groupBy("operation", "priority").agg(F.count(F.lit(1)).alias("pending"))


def grade(value: Column, limits: tuple[int, int]) -> Column:
    return F.when(value > limits[1], "critical").when(value > limits[0], "warning").otherwise("healthy")


def worst(*grades: Column) -> Column:
    level = F.greatest(*(F.when(g == "critical", 2).when(g == "warning", 1).otherwise(0) for g in grades), F.lit(0))
    return F.when(level == 2, "critical").when(level == 1, "warning").otherwise("healthy")


def remediation_priority(severity: Column, scope: Column, business_hours: Column, failures: Column) -> Column:
    """Severity (low if unknown) and scope points, ten in business hours, two for each failure up to twenty; a hundred at most."""
    points = lambda c, table, other: F.coalesce(*(F.when(c == k, v) for k, v in table.items()), F.lit(other))
    return F.least(points(severity, SEVERITY, SEVERITY["low"]) + points(scope, SCOPE, 0) + F.when(business_hours, 10).otherwise(0) + F.least(failures * 2, F.lit(20)), F.lit(100))


def success_grade(done: Column, total: Column) -> Column:
    """success if all went well, warning for at least half, else error."""
    return F.when(done == total, "success").when(done * 2 >= total, "warning").otherwise("error")


def failing(calls: DataFrame, group: str, failed: Column, threshold: float) -> DataFrame:
    """(group, total, failures, rate, fallback): whether so large a share of its calls fail that it works without them."""
    sums = calls.groupBy(group).agg(F.count(F.lit(1)).alias("total"), F.count_if(failed).alias("failures"))
    return sums.withColumn("rate", ratio(F.col("failures"), F.col("total"))).withColumn("fallback", F.col("rate") >= threshold)
