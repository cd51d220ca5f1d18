"""Stores: indexes that can't be stale, change by segments, and are exact where they say so."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.operators import gramindex as G
from seekframe.operators import segments as S
from seekframe.operators import store as ST
from seekframe.operators import textindex as X
from seekframe.operators import vectorindex as VI
from seekframe.operators.search import Items, search
from seekframe.plans import frames
from seekframe.plans import keys as K
from seekframe.plans.catalog import QUERIES, load
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Facet, Group, Query, VectorQuery

load()
SIZE = 6
INDEX = IndexSpec("articles", (FieldSpec("title", "text", weight="A"), FieldSpec("body", "text", weight="C"), FieldSpec("size", "integer"), FieldSpec("content_embedding", "vector", dimensions=SIZE)))
LAYOUT = ST.Layout(INDEX, texts=("simple", "english"), grams=("title",), vectors=("content_embedding",), files=3)
SCHEMA = "item_id string, datasource string, language string, title string, body string, size long, content_embedding array<float>"
WORDS = "red blue green house houses ship licence 50% a_b Straße İz".split()


def row(i, rng):
    text = lambda most: rng.choice([None, "", *[" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, most))) for _ in range(4)]])
    centre = [1.0 if k == i % 3 else 0.0 for k in range(SIZE)]
    return (f"k{i}", "node", "en", text(5), text(25), rng.randrange(5), rng.choice([None, [0.0] * SIZE] + [[c + rng.gauss(0, 0.25) for c in centre] for _ in range(6)]))


def bytes_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)


def cosines(rows, q):
    out = {}
    for r in rows.values():
        if r[6] is not None and any(r[6]):
            v = np.array(r[6], np.float32).astype(float)
            out[r[0]] = float(v @ q / np.linalg.norm(v) / np.linalg.norm(q))
    return out


def agrees(spark, path, rows):
    """The store answers as its rows without any index do."""
    items = ST.open_(spark, path, LAYOUT)
    plain = Items(spark.createDataFrame(list(rows.values()), SCHEMA))
    assert sorted(map(str, items.base.collect())) == sorted(map(str, plain.base.collect()))
    q = (1.0, 0.3, 0.0, 0.1, 0.0, 0.0)
    asked = [
        Query(keys="red ship"), Query(keys='"red ship" house'), Query(keys="houses", config="english"), Query(where=Group((Cond("title", "d sh", "CONTAINS"), Cond("size", 3, "<")))),
        Query(where=Group((Cond("title", "ed", "ENDS_WITH"), Cond("title", "gre", "STARTS_WITH")), "OR")), Query(where=Group((Cond("title", "%hou%shi_%", "LIKE"),))),
        Query(keys="blue", vector=VectorQuery(q, threshold=0.5)), Query(keys="blue", vector=VectorQuery(q, threshold=0.5, guarded=False)), Query(mode="vector_only", vector=VectorQuery(q, threshold=0.8)),
    ]
    for a in asked:
        got, want = (sorted((r.item_id, None if r.score is None else round(r.score, 9)) for r in search(x, INDEX, a).rows.collect()) for x in (items, plain))
        assert got == want, a
    built = items.vectors["content_embedding"]
    true = cosines(rows, np.array(q))
    best = sorted(true.items(), key=lambda x: (-x[1], x[0]))[:7]
    assert [(r.id, round(r.similarity, 9)) for r in VI.nearest(built, q, 7).collect()] == [(i, round(s, 9)) for i, s in best]
    assert {r.id for r in VI.within(built, q, 0.7).collect()} == {i for i, s in true.items() if s >= 0.7}
    assert sum(n for *_, n in built.spans.values()) >= len(true) == built.items.count()


def test_store_follows_its_items(spark, tmp_path):
    rng, path = random.Random(4), str(tmp_path / "s")
    rows = {r[0]: r for r in (row(i, rng) for i in range(240))}
    ST.create(spark, path, LAYOUT, spark.createDataFrame(list(rows.values()), SCHEMA))
    for _ in range(3):
        new = [row(rng.randrange(300), rng) for _ in range(5)]
        new = list({r[0]: r for r in new}.values())
        ST.upsert(spark, path, LAYOUT, spark.createDataFrame(new, SCHEMA))
        rows |= {r[0]: r for r in new}
        away = rng.sample(sorted(rows), 3)
        ST.delete(spark, path, LAYOUT, spark.createDataFrame([(a,) for a in away] + [("unknown",), (None,)], "item_id string"))
        rows = {k: r for k, r in rows.items() if k not in away}
    agrees(spark, path, rows)
    held = S.current(spark, path)
    assert len(held.segments) <= 4 and held.segments[0].rows == 240  # small segments were merged, the large one never
    with pytest.raises(SpecError):
        ST.open_(spark, str(tmp_path / "none"), LAYOUT)


def test_a_small_change_is_a_small_write(spark, tmp_path):
    rng, path = random.Random(6), str(tmp_path / "s")
    rows = [(f"k{i}", "node", "en", " ".join(f"w{rng.randrange(5000)}" for _ in range(9)), " ".join(f"w{rng.randrange(5000)}" for _ in range(60)), 1, [rng.gauss(0, 1) for _ in range(SIZE)]) for i in range(6000)]
    layout = ST.Layout(INDEX, vectors=("content_embedding",), files=2)
    ST.create(spark, path, layout, spark.createDataFrame(rows, SCHEMA))
    (base,) = S.current(spark, path).segments
    held = ST.upsert(spark, path, layout, spark.createDataFrame([(*r[:3], "zebra", *r[4:]) for r in rows[:60]], SCHEMA))
    new = held.segments[-1]
    assert held.segments[0] == base and new.rows == new.gone == 60
    assert bytes_of(f"{path}/{new.name}") < 0.05 * bytes_of(f"{path}/{base.name}")
    assert search(ST.open_(spark, path, layout), INDEX, Query(keys="zebra")).count.first().result_count == 60


def test_a_failed_change_leaves_the_store(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = {r[0]: r for r in (row(i, random.Random(i)) for i in range(20))}
    ST.create(spark, path, LAYOUT, spark.createDataFrame(list(rows.values()), SCHEMA))
    broken = spark.createDataFrame([row(3, random.Random(9))], SCHEMA).withColumn("title", F.raise_error(F.lit("broken")).cast("string"))
    before = S.current(spark, path)
    with pytest.raises(Exception, match="broken"):
        ST.upsert(spark, path, LAYOUT, broken)
    assert S.current(spark, path) == before
    agrees(spark, path, rows)


def test_due():
    of = lambda *sizes: S.Manifest(tuple(S.Segment(f"s{k}", k, n) for k, n in enumerate(sizes)))
    assert [s.rows for s in S.due(of(1000, 10, 1))] == [] and [s.rows for s in S.due(of(1000, 10, 3))] == [10, 3]
    assert [s.rows for s in S.due(of(1000, 200, 40, 15))] == [1000, 200, 40, 15] and S.due(of(5)) == ()


def test_lists_that_outgrow_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(VI, "LEAST_SPLIT", 60)
    rng, path = np.random.default_rng(3), str(tmp_path / "s")
    layout = ST.Layout(INDEX, texts=(), vectors=("content_embedding",), files=2)
    make = lambda i, v: (f"k{i}", "node", "en", None, None, 1, v.tolist())
    first = [make(i, rng.normal(size=SIZE)) for i in range(400)]
    ST.create(spark, path, layout, spark.createDataFrame(first, SCHEMA))
    lists = len(S.current(spark, path).about["vectors"]["content_embedding"]["centroids"])
    many = [make(1000 + i, np.eye(SIZE)[0] + 0.2 * rng.normal(size=SIZE)) for i in range(600)]
    ST.upsert(spark, path, layout, spark.createDataFrame(many, SCHEMA))
    held = S.current(spark, path)
    assert len(held.about["vectors"]["content_embedding"]["centroids"]) > lists and len(held.segments) == 1
    rows = first + many
    x = np.array([r[6] for r in rows], np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    built = ST.open_(spark, path, layout).vectors["content_embedding"]
    asked = spark.createDataFrame([(r[0], r[6]) for r in rows[::20]], "item_id string, v array<float>")
    got = VI.search(built, asked, "item_id", "v").collect()
    hits = 0
    for k in range(0, len(rows), 20):
        scores = unit @ unit[k]
        scores[k] = -2
        hits += len({r.id for r in got if r.query_id == rows[k][0]} & {rows[j][0] for j in np.argsort(-scores)[:10]})
    assert hits / (10 * len(range(0, len(rows), 20))) >= 0.9


def test_exact_search_prunes_lists(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = np.eye(24)
    x = np.repeat(centres, 100, axis=0) + 0.05 * rng.normal(size=(2400, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    VI.write(VI.build(df, "vec_id", "embedding", 24), str(tmp_path / "v"))
    built = VI.read(spark, str(tmp_path / "v"))
    q = tuple((centres[3] + 0.02).tolist())
    found = VI.within(built, q, 0.8)
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    read = set(plan.split("PartitionFilters:")[1].split("]")[0].split("list#")[-1].split("IN")[-1])
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(turn" in plan and read
    asked = VI._query(built, q)
    reach = VI._reachable(built, asked[1], np.arccos(0.8))
    assert 0 < len(reach) < len(built.centroids) / 4
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = unit @ (np.array(q) / np.linalg.norm(q))
    assert {r.id for r in found.collect()} == set(np.nonzero(scores >= 0.8)[0].tolist())
    for k in (1, 100, 130, 2400, 3000):
        got = VI.nearest(built, q, k).collect()
        assert [r.id for r in got] == np.argsort(-scores, kind="stable")[:k].tolist()
    assert [r.id for r in VI.nearest(built, q, 3, lambda d: d.where("id % 1000 = 7")).collect()] == sorted((7, 1007, 2007), key=lambda i: -scores[i])
    for odd in ((), (0.0,) * 24, (float("nan"),) * 24):
        assert VI.nearest(built, odd, 3).count() == 0 == VI.within(built, odd, 0.1).count()


def test_changed_tables_are_indexed_anew(spark, tmp_path):
    """A query after its table was overwritten sees the new texts and vectors, whatever was asked before."""
    folder = str(tmp_path)
    for name in ("labels", "embeddings", "documents", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    before = QUERIES["fts_and"](spark, folder).count()
    assert before > 0 and QUERIES["fts_ilike_fallback"](spark, folder).count() > 0 and QUERIES["more_like_this"](spark, folder).count() == 10
    spark.createDataFrame([(1, "license version here", "en", "s", 20)], "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    assert [r.doc_id for r in QUERIES["fts_and"](spark, folder).collect()] == [1]
    spark.createDataFrame([(0, [1.0] * 64, 1), (5, [1.0] * 63 + [0.5], 1)], "vec_id long, embedding array<float>, label int").write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    assert [r.vec_id for r in QUERIES["more_like_this"](spark, folder).collect()] == [5]
    layout = frames._layout(spark, frames.DOCS, texts=("simple",))
    path, now = frames._store(spark, folder, "documents", layout)
    with pytest.raises(SpecError):
        ST.open_(spark, path, layout, spark.range(1), source="another")
    assert ST.open_(spark, path, layout, spark.range(1), source=now)


def test_grams(spark, tmp_path):
    rng = random.Random(8)
    texts = [None, "", "a", "ab", "Abc", "xyzabc", "İstanbul xxİ", "aaaa", "日本語テキスト", "with \\ and % and _"] + [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "item_id long, title string")
    G.write(G.build(df, "item_id", "title"), str(tmp_path), 2)
    built = G.read(spark, str(tmp_path))
    for op, value, test in [("CONTAINS", "abc", lambda t: "abc" in t), ("CONTAINS", "se sh", lambda t: "se sh" in t), ("ENDS_WITH", "ip", lambda t: t.endswith("ip")), ("STARTS_WITH", "re", lambda t: t.startswith("re")), ("CONTAINS", "テキ", lambda t: "テキ" in t), ("CONTAINS", "zzz", lambda t: False)]:
        maybe = G.candidates(Group((Cond("title", value, op),)), {"title": built})
        want = {i for i, t in enumerate(texts) if t is not None and test(t)}
        if maybe is not None:
            got = {r.id for r in maybe.collect()}
            assert want <= got and len(got) < len(texts)
        else:
            assert op == "CONTAINS" and len(value) < 3
    assert G.candidates(Group((Cond("title", "re", "STARTS_WITH"), Cond("other", 1)), "OR"), {"title": built}) is None
    assert {r.id for r in G.ilike(built, "%XXi%").collect()} >= {6} and G.ilike(built, "%é%") is None is G.ilike(built, "%a%")
    index = IndexSpec("x", (FieldSpec("title", "text"), FieldSpec("size", "integer")))
    source = Items(df.selectExpr("item_id", "'n' AS datasource", "'e' AS language", "title", "item_id % 2 AS size"), grams={"title": built})
    q = Query(where=Group((Cond("title", "hou", "CONTAINS"),)), facets=(Facet("size"),))
    result = search(source, index, q)
    assert {r.item_id for r in result.rows.collect()} == {i for i, t in enumerate(texts) if t and "hou" in t}
    assert "gram" in result.rows._jdf.queryExecution().toString()
    sims = {r.id: r.similarity for r in G.similar(built, "red hause", 0.3).collect()}
    mine = set(G.grams("red hause"))
    want = {}
    for i, t in enumerate(texts):
        if t is not None:
            theirs = set(G.grams(t))
            if (s := len(mine & theirs) / len(mine | theirs)) >= 0.3:
                want[i] = s
    assert sims == pytest.approx(want) and want


def test_postings_are_dealt_evenly(spark, tmp_path):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "the " + " ".join(f"w{rng.randrange(300)}" for _ in range(9)) + " the" * (i % 3)) for i in range(3000)], "item_id long, title string")
    index = IndexSpec("x", (FieldSpec("title", "text"),))
    X.write(X.build(df, index), str(tmp_path), 8)
    built = X.read(spark, str(tmp_path))
    parts = spark.read.parquet(f"{tmp_path}/postings").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in parts) < 3 * built.postings.count() / 8
    again = X.build(df, index)
    for a, b in ((built.postings, again.postings), (built.lengths, again.lengths)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    first = built.postings.where("token = 'the'").select("level", "tf").collect()
    assert len(first) == 3000 and all(r.level == r.tf.bit_length() for r in first)


def test_what_a_task_sorts_is_bounded(spark, tmp_path, monkeypatch):
    """more tokens are more ranges, whatever number of files is asked for; and postings are shuffled in blocks."""
    df = spark.createDataFrame([(str(i), f"the the red w{i}", "en", "x") for i in range(400)], "item_id string, body string, language string, datasource string").repartition(2)
    index = IndexSpec("x", (FieldSpec("body", "text"),))
    monkeypatch.setattr(X, "RANGE", 100)
    built = X.build(df, index)
    bounds, files = X._bounds(built.tokenised, "simple", 2)
    assert files == 16
    blocks = X._postings(built.tokenised, "simple", bounds, files, blocks=True)
    of_the = blocks.where("token = 'the'").select(F.size("ids").alias("n"), "tf", F.size("places").alias("places")).collect()
    assert sum(r.n for r in of_the) == 400 and len(of_the) < 50 and all(r.tf == 2 and r.places == 2 * r.n for r in of_the)
    X.write(built, str(tmp_path), 2)
    again = X.read(spark, str(tmp_path))
    for a, b in ((built.postings, again.postings), (built.lengths, again.lengths)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    assert again.postings.select(F.input_file_name()).distinct().count() > 8


def test_what_is_found_is_dealt_to_all_tasks(spark, tmp_path):
    """ids compress so well that a plain shuffle's partitions become one, and all that is found lies in one task."""
    df = spark.range(4000).selectExpr("cast(id as string) AS item_id", "'red ship' AS body", "'en' AS language", "'x' AS datasource")
    index = IndexSpec("x", (FieldSpec("body", "text"),))
    X.write(X.build(df, index), str(tmp_path), 2)
    found = X.find(X.read(spark, str(tmp_path)), index, K.parse("red ship"))
    shares = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(shares) == 4000 and len(shares) == 4 and max(shares) < 2000
