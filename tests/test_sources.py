"""Embedding providers, cache, queue stream, hourly stream and analytics on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from seekframe.functions import prepare as P
from seekframe.operators import analytics as A
from seekframe.plans.query import Query
from seekframe.sources import embedding as E
from seekframe.sources.tables import SlowLog
from seekframe.streaming import queue as Q


class Flaky:
    dimensions = 2

    def __init__(self, fail):
        self.fail, self.calls = fail, 0

    def embed(self, texts):
        self.calls += 1
        if self.fail(self.calls, texts):
            raise E.ProviderError("no", 429)
        return [[1.0, 0.0] for _ in texts]

    def available(self):
        return True


def test_hash_provider_is_deterministic():
    p = E.HashProvider(8)
    assert p.embed(["a b", "b a"])[0] == pytest.approx(p.embed(["a b"])[0]) and p.embed([""]) == [[0.0] * 8]


def test_breaker():
    now = [0.0]
    b = E.CircuitBreaker(clock=lambda: now[0])
    for _ in range(5):
        assert b.allows()
        b.record(False)
    assert not b.allows()
    now[0] = 61
    assert b.allows() and b.state == "half_open"
    for _ in range(3):
        b.record(True)
    assert b.state == "closed"
    for _ in range(5):
        b.record(False)
    now[0] = 200
    assert b.allows()
    b.record(False)
    assert b.state == "open"


def test_retries_and_partial_batches():
    waits = []
    r = E.Resilient(Flaky(lambda n, t: n < 3), sleep=waits.append)
    assert r.embed(["a"]) == [[1.0, 0.0]] and len(waits) == 2 and waits[1] > waits[0]
    r = E.Resilient(Flaky(lambda n, t: "bad" in t), retries=0, sleep=waits.append)
    assert [e for _, e in r.embed_partly(["a", "bad", "b"])] == [None, "no", None]


def test_batches():
    assert E.batches([1, 1, 1], most_inputs=2) == [0, 0, 1]
    assert E.batches([5, 6, 20, 1], most_tokens=10) == [0, 1, 2, 3]
    assert E.batches([]) == []


def _cache(spark, rows):
    return spark.createDataFrame(rows, "text_hash string, embedding array<float>, dimensions int, created long, last_accessed long, expires long, hit_count int")


def test_cache(spark):
    h = lambda c: c * 64
    cache = _cache(spark, [(h("a"), [1.0], 1, 1, 5, 100, 0), (h("b"), [1.0], 1, 1, 6, 10, 0), ("bad", [1.0], 1, 1, 6, 100, 0), (h("c"), [1.0], 1, 1, 5, 100, 3)])
    asked = spark.createDataFrame([(0, h("a")), (1, h("a")), (2, h("b"))], "pos int, text_hash string")
    assert sorted((r.pos, r.hit) for r in E.lookup(asked, cache, 10).collect()) == [(0, True), (1, True), (2, False)]
    assert [r.text_hash for r in E.evict(cache, 10, 1).collect()] == [h("c")]
    new = E.put(cache, _cache(spark, [(h("a"), [2.0], 1, 7, 5, 100, 0), (h("a"), [3.0], 1, 8, 5, 100, 0)]))
    assert new.count() == 4 and new.where(F.col("text_hash") == h("a")).first().embedding == [3.0]


def test_fill_embeds_each_missing_text_once(spark):
    items = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "id int, text string")
    out, entries = E.fill(items, _cache(spark, []), E.HashProvider(4), 10, 60, "id", "text")
    assert out.where("content_embedding is null").count() == 0 and entries.count() == 3
    again, none = E.fill(items, entries, E.HashProvider(4), 20, 60, "id", "text")
    assert none.count() == 0 and again.count() == 4
    key = lambda s: items.select(P.cache_key(F.lit(s))).first()[0]
    assert key("a  b\n") == key("a b") != key("A b")


def test_queue_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    tasks = [
        {"operation": "generate_embedding", "server_id": "s", "index_id": "i", "item_id": "1", "text_content": "old", "priority": 200, "created": 1},
        {"operation": "generate_embedding", "server_id": "s", "index_id": "i", "item_id": "1", "text_content": "new", "priority": 100, "created": 2},
        {"operation": "generate_embedding", "server_id": "s", "index_id": "i", "item_id": "2", "text_content": "x", "priority": 50, "created": 3},
        {"operation": "generate_embedding", "server_id": "s", "index_id": "i", "item_id": "3"},
        {"operation": "dance", "server_id": "s"},
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, tasks)))
    seen, bad = [], []
    run = lambda: Q.process(spark, str(tmp_path / "in"), str(tmp_path / "state"), lambda df, n: seen.extend((r.item_id, r.text_content) for r in df.collect()), lambda df, n: bad.append(df.count())).awaitTermination()
    run()
    assert seen == [("2", "x"), ("1", "new")] and sum(bad) == 2
    run()
    assert len(seen) == 2  # what is done isn't done again


def test_hourly_stream_equals_batch(spark, tmp_path):
    events = spark.createDataFrame([(i, i * 600, float(i)) for i in range(30)], "event_id long, at long, value double").select("event_id", F.timestamp_seconds("at").alias("ts"), "value")
    events.write.parquet(str(tmp_path / "e"))
    stream = Q.hourly_stream(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("hours").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("hours").collect()) == sorted(Q.hourly_stream(events).collect())


def test_analytics_edges(spark):
    kind = "server_id string, operation string, token_count int, cost_usd decimal(10,6), duration_ms int, timestamp long"
    empty = spark.createDataFrame([], kind)
    assert A.cost_summary(empty, 1000, 86400).first().total_calls == 0 and A.cost_trend(empty, 10**6, 10 * 86400).first().trend_percent == 0
    assert A.period("1h") == 3600 and A.period("what") == 7 * 86400
    grade = spark.range(1).select(A.grade(F.lit(5001), A.HEALTH["database_ms"]).alias("a"), A.worst(F.lit("healthy"), F.lit("warning")).alias("b"), A.success_grade(F.lit(1), F.lit(2)).alias("c"), A.remediation_priority(F.lit("critical"), F.lit("system"), F.lit(True), F.lit(99)).alias("d")).first()
    assert tuple(grade) == ("critical", "warning", "warning", 100)
    old = spark.createDataFrame([("d1", 1), ("d2", 2)], "date string, n int")
    new = spark.createDataFrame([("d2", 9)], "date string, n int")
    assert sorted(map(tuple, A.merge_rollup(old, new, ["date"]).collect())) == [("d1", 1), ("d2", 9)]


def test_http_providers():
    sent = []

    def transport(url, headers, body, timeout):
        texts = json.loads(body)["input"]
        sent.append((url, headers, json.loads(body).get("model"), len(texts)))
        if "limit" in texts:
            return 429, b"{}"
        if "broken" in texts:
            return 200, b"<html>"
        return 200, json.dumps({"data": [{"index": i, "embedding": [float(len(t)), 0.0]} for i, t in reversed(list(enumerate(texts)))]}).encode()

    a = E.HttpProvider.openai("key", dimensions=2, transport=transport)
    assert a.embed(["a", "bbb"]) == [[1.0, 0.0], [3.0, 0.0]] and sent[0][2] == "text-embedding-3-small" and "key" in sent[0][1]["Authorization"]
    b = E.HttpProvider.azure("key", "https://host/", "small", dimensions=2, transport=transport)
    assert len(b.embed(["x"] * 40)) == 40 and [n for *_, n in sent[1:]] == [16, 16, 8] and sent[1][0].startswith("https://host/openai/deployments/small/") and sent[1][2] is None
    for text, code in (("limit", 429), ("broken", None)):
        with pytest.raises(E.ProviderError) as e:
            a.embed([text])
        assert e.value.code == code
    with pytest.raises(E.ProviderError):
        E.HttpProvider.openai("key", dimensions=3, transport=transport).embed(["a"])
    query, lowered = E.vector_for(Query(keys="x"), a, "four", threshold=0.3)
    assert query.vector.vector == (4.0, 0.0) and query.vector.threshold == 0.3 and lowered is None
    for text in ("limit", " "):
        query, lowered = E.vector_for(Query(keys="x"), a, text)
        assert query.mode == "text_only" and query.vector is None and lowered["degraded"] and lowered["strategy"] == "text_only"


def test_invalidation(spark):
    cache = spark.createDataFrame([("a", "m", "i"), ("b", "m", "j"), ("c", "n", "i"), ("d", None, None)], "text_hash string, model string, index_id string")
    left = lambda **how: "".join(sorted(r.text_hash for r in E.invalidate(cache, **how).collect()))
    assert (left(), left(model="m"), left(index="i"), left(model="m", index="i")) == ("abcd", "cd", "bd", "bcd")
    assert left(hashes=spark.createDataFrame([("a",), ("d",)], "text_hash string")) == "bc"
    used = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "item_id int, text_hash string")
    gone = spark.createDataFrame([(1,), (3,)], "item_id int")
    assert sorted(r.text_hash for r in E.forget(cache, used, gone).collect()) == ["a", "c", "d"]


def test_breaker_states_follow_the_breaker(spark):
    import random

    rng = random.Random(4)
    calls = [(s, n, n * rng.randrange(1, 40), rng.random() < 0.5) for s in (1, 2, None) for n in range(60)]
    want = []
    for s in (1, 2, None):
        now = [0.0]
        b = E.CircuitBreaker(2, 60, 3, clock=lambda: now[0])
        for _, n, at, good in sorted((c for c in calls if c[0] == s), key=lambda c: (c[2], c[1])):
            now[0] = at
            if b.allows():
                b.record(good)
            want.append((s, n, b.state))
    df = spark.createDataFrame(calls, "server int, call int, at long, good boolean")
    assert sorted(map(str, map(tuple, E.breaker_states(df, "server", "call", "at", "good", 2, 60, 3).collect()))) == sorted(map(str, want))


def test_queue_control(spark, tmp_path):
    source = str(tmp_path / "q")
    items = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (3, " "), (4, "d")], "id int, text string")
    Q.enqueue(Q.tasks(items, "id", "text", "s", "i", 5, "high"), source)
    Q.enqueue(Q.regenerate_task(spark, "s", "i", 6), source)
    queue = spark.read.schema(Q.ITEM).json(source)
    assert sorted((r.operation, r.item_id, r.priority) for r in queue.collect() if r.item_id) == [("generate_embedding", "1", 50), ("generate_embedding", "4", 50)] and queue.count() == 3
    assert Q.without_items(queue, spark.createDataFrame([("1",)], "item_id string")).count() == 2
    done, again = [], []
    worker = Q.regenerator(lambda index: items.where("text is not null"), lambda rows: rows, lambda index, rows, n: again.append((index, rows.count())))
    run = lambda: Q.process(spark, source, str(tmp_path / "s"), Q.dispatch({"generate_embedding": lambda df, n: done.extend(r.item_id for r in df.collect()), "regenerate_index_embeddings": worker}))
    Q.pause(spark, source)
    assert run() is None and done == []
    Q.resume(spark, source)
    run().awaitTermination()
    assert sorted(done) == ["1", "4"] and again == [("i", 4)]
    Q.clear(spark, source)
    assert not list((tmp_path / "q").iterdir())
    assert not Q.allowed({}, "s") and Q.allowed({"enabled": True}, "s") and not Q.allowed({"enabled": True, "servers": {"s": False}}, "s") and not Q.allowed({"enabled": True, "default": False}, "s")


def test_slow_log(spark):
    now = iter([0.0, 2.0, 2.0, 2.5])
    log = SlowLog(1.0, clock=lambda: next(now))
    assert log.run("slow", spark.range(3)) == spark.range(3).collect() and log.run("fast", spark.range(3), lambda df: df.count()) == 3
    assert [(n, s) for n, s, _ in log.entries] == [("slow", 2.0)] and "Range" in log.entries[0][2]
