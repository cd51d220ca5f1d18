"""The text and vector indexes: the same results as without them, pruned scans, maintenance, and recall."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.operators import textindex as X
from seekframe.operators import vectorindex as VI
from seekframe.operators.search import Items, search
from seekframe.plans import keys as K
from seekframe.plans.model import FieldSpec, IndexSpec
from seekframe.plans.query import Cond, Facet, Group, Query, VectorQuery

INDEX = IndexSpec("articles", (FieldSpec("title", "text", weight="A"), FieldSpec("body", "text", weight="C"), FieldSpec("names", "string", -1), FieldSpec("size", "integer"), FieldSpec("tags_id", "integer"), FieldSpec("tags_name", "string"), FieldSpec("content_embedding", "vector", dimensions=2)))
SCHEMA = "item_id string, datasource string, language string, title string, body string, names array<string>, size long, tags_id long, tags_name string"
WORDS = "red blue green house houses ship a b a".split()


def rows(seed, n):
    rng = random.Random(seed)
    text = lambda most: rng.choice([None, "", " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, most)))])
    return [(str(i), "node", "en", text(4), text(20), rng.choice([None, [], ["red ship", None], ["b"]]), rng.randrange(5), rng.randrange(3), rng.choice("xyz")) for i in range(n)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(rows(1, 80), SCHEMA)


@pytest.fixture(scope="module")
def path(spark, items, tmp_path_factory):
    to = str(tmp_path_factory.mktemp("text"))
    for config in ("simple", "english"):
        X.write(X.build(items, INDEX, config), f"{to}/{config}", 3)
    return to


def sides(spark):
    vectors = spark.createDataFrame([(str(i), [1.0, i / 10]) for i in range(0, 80, 3)], "item_id string, content_embedding array<double>")
    return (vectors,)


ASKED = ["red", "red house", '"a b a"', '"a b a" "red house"', "house", "missing", {"#conjunction": "OR", "0": "red", "1": {"0": "blue", "1": "ship"}}, '"red ship" b']


@pytest.mark.parametrize("keys", ASKED, ids=str)
@pytest.mark.parametrize("config", ["simple", "english"])
def test_index_gives_what_texts_give(spark, items, path, keys, config):
    with_index = Items(items, sides(spark), {config: X.read(spark, f"{path}/{config}")})
    for more in ({}, {"vector": VectorQuery((1.0, 0.0), threshold=0.6)}, {"rank": "constant"}):
        q = Query(keys=keys, config=config, fields=("size",), **more)
        a, b = (sorted((r.item_id, round(r.score, 9)) for r in search(i, INDEX, q).rows.collect()) for i in (with_index, Items(items, sides(spark))))
        assert a == b
    node = X.stemmed(K.parse(keys), config)
    for fields in (["title"], ["body", "names"]):
        assert X.find(with_index.text[config], INDEX, node, fields).count() <= len(a) + 80


def test_prefixes_and_vocabulary(spark, items, path):
    built = X.read(spark, f"{path}/simple")
    got = {r.id for r in X.find(built, INDEX, K.parse("hou gr", prefixes=True)).collect()}
    has = lambda r, p: any(w.startswith(p) for t in (r[3], r[4], " ".join(x or "" for x in r[5] or [])) for w in (t or "").split())
    assert got == {r[0] for r in rows(1, 80) if has(r, "hou") and has(r, "gr")}
    counts = {r.token: r.n for r in X.vocabulary(built).collect()}
    assert counts["ship"] == sum(t.split().count("ship") for r in rows(1, 80) for t in (r[3] or "", r[4] or "", " ".join(x or "" for x in r[5] or [])))


def test_search_reads_postings_alone(spark, items, path, tmp_path):
    items.write.parquet(str(tmp_path / "items"))
    source = Items(spark.read.parquet(str(tmp_path / "items")), sides(spark), {"simple": X.read(spark, f"{path}/simple")})
    plan = search(source, INDEX, Query(keys="red ship", fields=("size",), limit=3)).rows._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "In(token, [red,ship])" in physical and "content_embedding" not in physical and "split(" not in physical
    assert not any("body" in x or "title" in x for x in re.findall(r"ReadSchema: \S+", physical))
    shown = search(source, INDEX, Query(keys="red", fields=("size",), facets=(Facet("size"),), limit=3))
    assert "content_embedding" not in shown.facets["size"]._jdf.queryExecution().toString()


def test_sides_that_are_only_shown_join_the_page(spark, items):
    labels = spark.createDataFrame([("1", True), ("3", False)], "item_id string, live boolean")
    index = IndexSpec("articles", (FieldSpec("size", "integer"), FieldSpec("live", "boolean")))
    source = Items(items.select("item_id", "datasource", "language", "size"), (labels,))
    got = [(r.item_id, r.live) for r in search(source, index, Query(limit=5)).rows.collect()]
    assert got == sorted(got) and len(got) == 5 and dict(got)["1"] is True
    found = search(source, index, Query(where=Group((Cond("live", False),))))
    assert [r.item_id for r in found.rows.collect()] == ["3"] and found.count.first().result_count == 1


def test_index_follows_its_items(spark, items, path):
    built = X.read(spark, f"{path}/simple")
    changed = spark.createDataFrame([("5", "node", "en", "zebra", None, None, 1, 1, "x"), ("900", "node", "en", None, "zebra ship", None, 1, 1, "x")], SCHEMA)
    gone = spark.createDataFrame([("6",), ("7",)], "item_id string")
    new = X.update(built, INDEX, changed, gone)
    whole = items.where("item_id not in ('5', '6', '7')").unionByName(changed)
    again = X.build(whole, INDEX)
    for a, b in ((new.postings, again.postings), (new.lengths, again.lengths)):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_related_fields_dont_narrow_a_facet(spark, items):
    q = Query(where=Group((Cond("tags_id", 1), Cond("size", 2, ">"))), facets=(Facet("tags_name"), Facet("tags_name", related=False)))
    count = lambda f: {r["filter"]: r["count"] for r in search(items, INDEX, Query(where=q.where, facets=(f,))).facets["tags_name"].collect()}
    all_ = rows(1, 80)
    assert sum(count(q.facets[0]).values()) == sum(r[6] > 2 for r in all_)
    assert sum(count(q.facets[1]).values()) == sum(r[6] > 2 and r[7] == 1 for r in all_)


def test_max_results(spark, items):
    source = Items(items, sides(spark))
    q = Query(mode="vector_only", vector=VectorQuery((1.0, 0.0), threshold=0.0, max_results=4), fields=("size",))
    assert search(source, INDEX, q).rows.count() == 4


def clouds(n, size, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 30), size))
    return centres[rng.integers(len(centres), size=n)] + 0.6 * rng.normal(size=(n, size))


@pytest.mark.parametrize("data", ["clouds", "even"])
def test_vector_index_recall(spark, tmp_path, monkeypatch, data):
    """Against brute force: nine tenths of the ten nearest of every twentieth vector, in clustered and in even data."""
    monkeypatch.setattr(VI, "BLOCK", 40)
    x = clouds(3000, 24) if data == "clouds" else np.random.default_rng(2).normal(size=(3000, 24))
    odd = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [float("nan")] * 24), (9005, [1.0])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + odd, "vec_id long, embedding array<double>")
    VI.write(VI.build(df, "vec_id", "embedding", 24), str(tmp_path / "v"))
    built = VI.read(spark, str(tmp_path / "v"))
    assert built.items.count() == 3000
    got = VI.search(built, df.where("vec_id % 20 = 0 or vec_id > 9000"), "vec_id", "embedding").collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 20):
        scores = unit @ unit[q]
        scores[q] = -2
        mine = {r.id: r.similarity for r in got if r.query_id == q}
        assert len(mine) == 10 and all(scores[i] == pytest.approx(s) for i, s in mine.items())
        hits += len(set(mine) & set(np.argsort(-scores)[:10].tolist()))
    assert hits / 1500 >= 0.9 and len(got) == 1500
    if data == "clouds":
        assert built.probes < len(built.centroids) / 2
    near = VI.near(built, tuple(x[0]))
    assert near.where("id = 0").count() == 1 and "PartitionFilters: [list" in near._jdf.queryExecution().toString()
    empty = VI.build(df.limit(0), "vec_id", "embedding", 24)
    assert VI.search(empty, df.limit(0), "vec_id", "embedding").count() == 0


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_registered_vector_search_recall(spark):
    from seekframe.plans import catalog_search

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("e")).collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.e for r in rows])
    unit, hits, asked = x / np.linalg.norm(x, axis=1, keepdims=True), 0, 0
    found = {}
    for r in catalog_search.vector_ann(spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for k in np.nonzero(ids % 20 == 0)[0]:
        scores = unit @ unit[k]
        scores[k] = -2
        hits += len(found[ids[k]] & set(ids[np.argsort(-scores)[:10]].tolist()))
        asked += 10
    assert hits / asked >= 0.9
