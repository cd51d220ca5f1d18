"""Early-stopping ranking, sums over a whole order, greedy calls, the cache's log, and the queue's attempts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seekframe.operators import ordered as O
from seekframe.operators import textindex as X
from seekframe.operators import topk as TK
from seekframe.operators.indexing import read_table, replace_table
from seekframe.operators.search import Items, search
from seekframe.plans.model import FieldSpec, IndexSpec
from seekframe.plans.query import Cond, Group, Query, Sort
from seekframe.sources import embedding as E
from seekframe.streaming import queue as Q

ONE = IndexSpec("one", (FieldSpec("body", "text", weight="A"), FieldSpec("size", "integer")))
TWO = IndexSpec("two", (FieldSpec("title", "text", weight="A"), FieldSpec("body", "text", weight="C"), FieldSpec("size", "integer")))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(1)
    text = lambda n: " ".join(["the"] * min(200, int(rng.paretovariate(0.7))) + ["of"] * rng.randrange(0, 5) + [f"w{rng.randrange(50)}" for _ in range(n)])
    rows = [(f"k{i:04}", "n", rng.choice(["en", "de"]), rng.choice([None, "the first", "of all the the"]), text(rng.randrange(9)), rng.randrange(5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "item_id string, datasource string, language string, title string, body string, size long")
    out = []
    for index in (ONE, TWO):
        path = str(tmp_path_factory.mktemp("r"))
        X.write(X.build(df, index), path, 3)
        out.append(Items(df, (), {"simple": X.read(spark, path)}))
    return out


ASKED = [
    Query(keys="the", limit=10), Query(keys="the", limit=5, offset=7, languages=("en",)), Query(keys="the of", limit=20, sorts=(Sort("relevance", "DESC"),)),
    Query(keys={"#conjunction": "OR", "0": "the", "1": "w7"}, limit=15), Query(keys="the w3", limit=1000), Query(keys="the", limit=3, where=Group((Cond("size", 2, ">"),))), Query(keys="missing", limit=4),
]


@pytest.mark.parametrize("asked", ASKED, ids=str)
def test_early_stop_gives_what_search_gives(stored, monkeypatch, asked):
    monkeypatch.setattr(TK, "FEW", 0)
    for items, index in zip(stored, (ONE, TWO)):
        want = [(r.item_id, round(r.score, 9)) for r in search(items, index, asked).rows.collect()]
        for lookups in (1000, 3)[: 1 + (index is TWO)]:
            monkeypatch.setattr(TK, "LOOKUPS", lookups)
            assert [(r.item_id, round(r.score, 9)) for r in TK.ranked(items, index, asked).collect()] == want


def test_early_stop_reads_high_frequencies_alone(stored, monkeypatch):
    monkeypatch.setattr(TK, "FEW", 0)
    items = stored[0]
    plan = TK.ranked(items, ONE, Query(keys="the", limit=10))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    level = int(plan.split("GreaterThanOrEqual(level,")[1].split(")")[0])
    postings = items.text["simple"].postings.where("token = 'the'")
    assert 10 <= postings.where(F.col("level") >= level).count() < postings.count() / 10
    rest = TK.ranked(items, ONE, Query(keys='"the of"', limit=3))  # a phrase is left to search
    assert "GreaterThanOrEqual(level" not in rest._jdf.queryExecution().toString()


def test_sums_and_fills_over_a_whole_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(9), rng.choice([None, None, None, i])) for i in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "o long, x long, v long")
    rows.sort()
    total, last = 0, None
    sums = {r.o: (r.n, r.s) for r in O.running(df, ["o"], n=F.lit(1), s=F.col("x")).collect()}
    fills = {r.o: r.v for r in O.filled(df, ["o"], "v").collect()}
    for k, (o, x, v) in enumerate(rows):
        total, last = total + x, v if v is not None else last
        assert sums[o] == (k + 1, total) and fills[o] == last


@pytest.mark.parametrize("sizes", [[], [5], [9000], [0] * 9, [3, None, 9000, 0, 0, 2], [random.Random(3).randrange(1, 900) for _ in range(300)], [1] * 40])
def test_greedy_calls(spark, sizes):
    df = spark.createDataFrame([(7 * i, s) for i, s in enumerate(sizes)], "doc_id long, tokens long")
    for inputs, most in ((2048, 1000), (7, 100_000), (3, 10)):
        got = [r.call for r in E.call_numbers(df, "doc_id", "tokens", inputs, most).orderBy("doc_id").collect()]
        assert got == list(E.batches([s or 0 for s in sizes], inputs, most))


def test_cache_log(spark, tmp_path):
    kind = "text_hash string, embedding array<float>, created long, last_accessed long, expires long, hit_count int"
    h = lambda c: c * 64
    path, log = str(tmp_path / "c"), str(tmp_path / "log")
    replace_table(spark.createDataFrame([(h(c), [1.0], 0, k, 100, 0) for k, c in enumerate("abcd")] + [(h("e"), [1.0], 0, 50, 5, 9)], kind), path)
    ask = lambda cs: spark.createDataFrame([(h(c),) for c in cs], "text_hash string")
    got = E.touch(ask("aaf"), read_table(spark, path), 10, log)
    assert sorted(r.hit for r in got.collect()) == [False, True, True]
    assert E.touch(ask("ae"), read_table(spark, path), 11, log).where("hit").count() == 1  # e has expired
    now = {r.text_hash[0]: (r.hit_count, r.last_accessed) for r in E.with_hits(read_table(spark, path), log).collect()}
    assert now["a"] == (2, 11) and now["b"] == (0, 1) and now["e"] == (9, 50)
    E.compact(spark, path, log, 12, 2)
    assert {r.text_hash[0]: r.hit_count for r in read_table(spark, path).collect()} == {"a": 2, "d": 0}
    E.compact(spark, path, log, 13, 2)  # the log was folded in once
    assert {r.text_hash[0]: r.hit_count for r in read_table(spark, path).collect()} == {"a": 2, "d": 0}


def test_batch_tasks_and_rejects(spark, tmp_path):
    items = spark.createDataFrame([(i, f"text {i}") for i in range(57)] + [(99, " "), (None, "x")], "id long, text string").repartition(2)
    made = Q.batch_tasks(items, "id", "text", "s", "x", 5)
    sizes = [len(r["items"]) for r in made.collect()]
    assert sum(sizes) == 57 and max(sizes) == 10 and sum(s < 10 for s in sizes) <= 2
    source = str(tmp_path / "in")
    Q.enqueue(made, source)
    Q.enqueue(spark.createDataFrame([("generate_embedding", "", "x", "1", "t", 1, 1, None, 0)], Q.ITEM), source)
    seen = []
    Q.process(spark, source, str(tmp_path / "s"), lambda b, n: seen.extend((r.item_id, r.text_content) for r in b.collect())).awaitTermination()
    assert sorted(seen) == sorted((str(i), f"text {i}") for i in range(57))
    assert spark.read.json(f"{source}-rejected/*").count() == 1  # nothing is dropped in silence


def test_attempts_releases_and_the_dead(spark, tmp_path):
    items = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "id long, text string")
    source = str(tmp_path / "in")
    Q.enqueue_once(Q.tasks(items, "id", "text", "s", "x", 1), source)
    Q.enqueue_once(Q.tasks(items, "id", "text", "s", "x", 2), source)  # all in flight: refused
    assert spark.read.schema(Q.ITEM).json(source).count() == 8 == Q.in_flight(spark, source).count()
    calls = []

    def worker(batch, number):
        calls.append(number)
        if len(calls) == 1:
            raise RuntimeError("no service")
        return batch.withColumn("error", F.when(F.col("item_id") == "3", "refused"))

    assert Q.drain(spark, source, str(tmp_path / "s"), worker) == 3
    states = {r.item_id: (r.n, r.last) for r in Q.ledger(spark, source).groupBy("item_id").agg(F.count("*").alias("n"), F.max_by("state", "attempt").alias("last")).collect()}
    assert states == {str(i): (3, "dead") if i == 3 else (2, "done") for i in range(8)}
    assert [r.item_id for r in spark.read.json(f"{source}-dead/*").collect()] == ["3"] and Q.in_flight(spark, source).count() == 0
    Q.enqueue_once(Q.tasks(items.limit(1), "id", "text", "s", "x", 3), source)
    assert Q.in_flight(spark, source).count() == 1


def test_tasks_of_one_moment_are_worked_on_side_by_side(spark, tmp_path):
    """tasks of one priority and moment are dealt to several ranges, still in order of priority."""
    items = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "id long, text string")
    source, seen = str(tmp_path / "in"), []
    Q.enqueue(Q.tasks(items, "id", "text", "s", "x", 1).union(Q.tasks(items.selectExpr("id + 1000 AS id", "text"), "id", "text", "s", "x", 1, "high")), source)
    work = lambda b, n: seen.extend(b.select("priority", F.spark_partition_id().alias("p")).collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Q.process(spark, source, str(tmp_path / "s"), work).awaitTermination()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(seen) == 800 and [r.priority for r in seen] == [50] * 400 + [100] * 400
    shares = Counter(r.p for r in seen)
    assert len(shares) == 4 and max(shares.values()) < 400
