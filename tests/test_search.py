"""Search over small fixtures: matching, paging, null order, arrays, facets, hybrid scores; and random trees against DuckDB."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from seekframe.functions import prepare as P
from seekframe.functions import text as X
from seekframe.functions import vectors as V
from seekframe.functions.stem import porter
from seekframe.operators import facets as FC
from seekframe.operators import indexing as I
from seekframe.operators.predicates import compile_group
from seekframe.operators.search import search
from seekframe.plans import keys as K
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Facet, Group, Query, Sort, VectorQuery

INDEX = IndexSpec("articles", (FieldSpec("title", "text", weight="A"), FieldSpec("body", "text"), FieldSpec("size", "integer"), FieldSpec("tags", "string", -1), FieldSpec("live", "boolean"), FieldSpec("content_embedding", "vector", dimensions=2)))
SCHEMA = "item_id string, datasource string, language string, title string, body string, size long, tags array<string>, live boolean, content_embedding array<double>"


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        ("1", "node", "en", "Learning from data", "machine learning for all", 5, ["a", "b"], True, [1.0, 0.0]),
        ("2", "node", "en", "A relational database", "tables and machine rooms", None, [], True, [0.0, 1.0]),
        ("3", "file", "fr", "Vector search", "near neighbours", 7, None, True, None),
        ("4", "node", "de", None, "100%_sure of machine learning machine learning", 5, [None], False, [0.0, 0.0]),
        ("5", "node", "en", "Full text", None, 2, ["b", "b"], None, [0.8, 0.6]),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(result):
    return [r.item_id for r in result.rows.collect()]


def test_keywords_and_rank(items):
    assert ids(search(items, INDEX, Query(keys="machine learning"))) == ["1", "4"]  # the title counts more
    assert set(ids(search(items, INDEX, Query(keys='"machine learning"')))) == {"1", "4"}
    assert ids(search(items, INDEX, Query(keys='"learning machine"'))) == ["4"]
    assert ids(search(items, INDEX, Query(keys="x" * 500))) == []
    for odd in ("test@#$%^&*()", "'; DROP TABLE x; --", "", None, {"#conjunction": "OR"}):
        assert search(items, INDEX, Query(keys=odd)).rows.count() in (0, 5)


def test_stems(items):
    # known stems of the published algorithm
    known = {"caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam", "triplicate": "triplic", "formative": "form", "electrical": "electr", "revival": "reviv", "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll", "as": "as", "größe": "größe"}
    assert {w: porter(w) for w in known} == known
    assert ids(search(items, INDEX, Query(keys="learn machines", config="english"))) == ["1", "4"]
    assert ids(search(items, INDEX, Query(keys="learn machines"))) == []


def test_count_equals_rows_and_pages_join_up(items):
    q = dict(where=Group((Cond("size", op="IS NOT NULL"),)), sorts=(Sort("size"),))
    whole = ids(search(items, INDEX, Query(**q)))
    assert whole == ["5", "1", "4", "3"]
    assert sum((ids(search(items, INDEX, Query(**q, limit=2, offset=k))) for k in (0, 2, 4)), []) == whole
    assert search(items, INDEX, Query(**q, limit=1)).count.first().result_count == 4
    assert search(items, INDEX, Query(skip_count=True)).count is None


def test_null_order(items):
    assert ids(search(items, INDEX, Query(sorts=(Sort("size", "DESC"),))))[0] == "2"
    assert ids(search(items, INDEX, Query(sorts=(Sort("size"),))))[-1] == "2"


def test_like_characters_are_plain_text(items):
    assert ids(search(items, INDEX, Query(where=Group((Cond("body", "100%_", "CONTAINS"),))))) == ["4"]
    assert ids(search(items, INDEX, Query(where=Group((Cond("body", "%", "STARTS_WITH"),))))) == []


@pytest.mark.parametrize("cond, want", [
    (Cond("tags", "b"), {"1", "5"}), (Cond("tags", "b", "<>"), {"2", "4"}), (Cond("tags", ["a", "z"], "IN"), {"1"}), (Cond("tags", [], "IN"), set()),
    (Cond("tags", ["a"], "NOT IN"), {"2", "4", "5"}), (Cond("tags", op="IS NULL"), {"2", "3"}), (Cond("tags", op="IS NOT NULL"), {"1", "4", "5"}), (Cond("tags", "a", ">"), {"1", "5"}),
    (Cond("live", 1), {"1", "2", "3"}), (Cond("live", "no"), {"4"}), (Cond("item_id", "3"), {"3"}),
])
def test_conditions(items, cond, want):
    assert {r.item_id for r in items.where(compile_group(INDEX, Group((cond,)))).collect()} == want


def test_unknown_fields_fail_before_any_job(items):
    for q in (Query(where=Group((Cond("nope", 1),))), Query(sorts=(Sort("nope"),)), Query(sorts=(Sort("tags"),)), Query(fields=("nope",)), Query(facets=(Facet("nope"),)), Query(facets=(Facet("title"),))):
        with pytest.raises(SpecError):
            search(items, INDEX, q)


def test_facets(items):
    got = search(items, INDEX, Query(where=Group((Cond("live", True),)), facets=(Facet("tags"), Facet("live", missing=True), Facet("size", min_count=2)))).facets
    assert {tuple(r) for r in got["tags"].collect()} == {('"a"', 1), ('"b"', 1)}
    assert {tuple(r) for r in got["live"].collect()} == {('"true"', 3), ('"false"', 1), ("!", 1)}  # ignores its own condition
    assert got["size"].collect() == []
    single = search(items, INDEX, Query(facets=(Facet("size", missing=True, limit=0),))).facets["size"]
    assert sum(r["count"] for r in single.collect()) == 5


def test_facet_ranges_are_both_bounds(items):
    q = Query(facet_filters=(("size", ("[3 6]",)),))
    assert set(ids(search(items, INDEX, q))) == {"1", "4"}
    assert set(ids(search(items, INDEX, Query(facet_filters=(("size", ("!", "[7 *]")),))))) == {"2", "3"}


def test_hybrid(items):
    r = search(items, INDEX, Query(keys="machine", vector=VectorQuery((1.0, 0.0), threshold=0.5)))
    got = {x.item_id: x for x in r.rows.collect()}
    assert set(got) == {"1", "2", "4", "5"} and r.count.first().result_count == 4
    assert got["1"].vector_score == pytest.approx(1) and got["4"].vector_score == 0  # a zero vector is no match by itself
    assert got["5"].score == pytest.approx(0.4 * 0.8) and got["1"].score > got["4"].score
    assert [x.item_id for x in search(items, INDEX, Query(mode="vector_only", vector=VectorQuery((1.0, 0.0), threshold=0.5))).rows.collect()] == ["1", "5"]
    lowered = search(items, INDEX, Query(keys="machine", mode="vector_only"))
    assert lowered.degradation["degraded"] and set(ids(lowered)) == {"1", "2", "4"}


def test_top_k_is_no_full_sort(items):
    plan = search(items, INDEX, Query(sorts=(Sort("size"),), limit=2)).rows._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_filters_reach_the_scan(spark, tmp_path, items):
    items.write.parquet(str(tmp_path / "i"))
    plan = search(spark.read.parquet(str(tmp_path / "i")), INDEX, Query(where=Group((Cond("size", 5),)), fields=("size",))).rows._jdf.queryExecution().toString()
    assert "EqualTo(size,5)" in plan and "body" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_values(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert [one(P.boolean(F.lit(x))) for x in ("Yes", " 0 ", "", "maybe")] == [True, False, False, None]
    assert [one(P.integer(F.lit(x))) for x in ("12", " 1.9", "x", "1e30", "nan")] == [12, 1, None, None, None]
    assert one(P.date(F.lit("0"))).year == 1970 and one(P.date(F.lit("2024-02-03"))).day == 3 and one(P.date(F.lit("soon"))) is None
    assert one(P.integers(F.array(F.lit("0"), F.lit("x"), F.lit("3")))) == [0, 3] and one(P.strings(F.array(F.lit("0"), F.lit("")))) == ["0"]
    assert one(P.entity_id(F.lit('{"target_id": 7}'))) == 7 and one(P.entity_id(F.lit("x"))) is None
    assert one(P.embedding_text(F.lit("a" * 9000))) == "a" * 8000
    assert one(P.embedding_text(F.lit("word " * 4), 12)) == "word word " or len(one(P.embedding_text(F.lit("word " * 4), 12))) <= 12
    assert one(X.normalise(F.lit("<p>a <b>b</b>\t\n c</p>"))) == "a b c"
    assert one(X.highlight(F.lit("the big red Box, is here"), K.parse("box"))) == "the big red <strong>Box,</strong> is here"
    assert one(X.highlight(F.lit("nothing"), K.parse("box"))) is None
    assert [one(FC.magnitude_range(F.lit(x))) for x in (0, 9, 10, 99, 100, 999, 1000)] == ["0", "9", "[10 20)", "[90 100)", "[100 200)", "[900 1000)", "[1000 2000)"]
    assert one(FC.month_range(F.lit("2024-01-31").cast("date"))) == "[2024-01-01 2024-02-01)"
    formats = {'["a","b"]': "json", "{a,b}": "array", "a|b": "separated", "abc": "single", "": "single", '{"a": 1}': "json", "[]": "json", "[true]": "json", "[[1], 2]": "json", "|a": "single", " ,a:b": "separated", "[a": "single", "a~": "separated"}
    assert {x: one(FC.detect_format(F.lit(x))) for x in formats} == formats
    assert [one(FC.values_of(F.lit(x), k)) for x, k in (('["a"," b",""]', "json"), ("{a,b}", "array"), ("a| b|", "separated"), ("a b", "single"), (None, "single"))] == [["a", "b"], ["a", "b"], ["a", "b"], ["a b"], None]
    assert FC.separator_for() == "|" and FC.separator_for(None, ";", ",") == ";" and FC.separator_for(":", ";") == ":" and FC.format_for() == "separated" and FC.format_for(None, "json") == "json"
    assert [one(FC.detect_separator(F.lit(x))) for x in ("a|b|c", "a,b;c,d", "a;b;c;", "a|b")] == ["|", ",", ";", None]
    assert one(X.frequency(X.tokens(F.lit("a b a b c a b")), K.Phrase(("a", "b")))) == 3


def test_vectors(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    a, b = V.literal((1, 0)), V.literal((0, 1))
    assert one(V.cosine(a, a)) == 1 and one(V.cosine(a, b)) == 0 and one(V.l2(a, b)) == pytest.approx(2**0.5) and one(V.dot(a, b)) == 0
    assert one(V.cosine(a, V.literal((0, 0)))) is None and one(V.norm(V.normalise(V.literal((3, 4))))) == pytest.approx(1)
    assert one(V.parse(F.lit("[1, 2.5]"))) == [1, 2.5] and one(V.parse(F.lit("[1, x]"))) is None
    assert not one(V.is_valid(F.array().cast("array<double>"))) and not one(V.is_valid(V.literal((float("nan"),)))) and one(V.is_valid(a, 2)) and not one(V.is_valid(a, 3))


def test_indexing(spark, items, tmp_path):
    changes = items.where("item_id in ('1', '5')").withColumn("size", F.lit(100).cast("long"))
    once = I.upsert(items, changes, "item_id")
    assert sorted(map(str, once.collect())) == sorted(map(str, I.upsert(once, changes, "item_id").collect())) and once.count() == 5
    left = I.delete(items, spark.createDataFrame([(" 1 ",), ("",), (None,), ("9",)], "item_id string"), "item_id")
    assert {r.item_id for r in left.collect()} == {"2", "3", "4", "5"}
    assert I.clear(items, INDEX, "node").count() == 1 and I.clear(items, INDEX).count() == 0
    changed = IndexSpec("articles", (FieldSpec("size", "integer", -1), FieldSpec("tags", "string"), FieldSpec("new", "boolean")))
    assert {r.item_id: (r.size, r.tags, r.new) for r in I.evolve(items, changed).collect()}["1"] == ([5], "a", None)
    assert I.differences(items, changed) == {"add": ["new"], "change": ["size", "tags"], "remove": ["body", "content_embedding", "live", "title"]}
    path = str(tmp_path / "t")
    for df in (items, left, left.limit(2)):
        I.replace_table(df, path)
        assert I.read_table(spark, path).count() == df.count()
    old = I.read_table(spark, path)
    with pytest.raises(Exception):  # noqa: B017  a write that fails leaves the table as it was
        I.replace_table(items.select(F.raise_error(F.lit("no"))), path)
    assert I.read_table(spark, path).count() == 2 == old.count()
    assert len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("v-")]) <= 3
    assert I.drop_table(spark, path) and not (tmp_path / "t").exists()
    with pytest.raises(SpecError):
        I.read_table(spark, path)
    assert I.append(items, left).count() == 9
    with pytest.raises(SpecError):
        I.append(items, left.drop("size"))
    smaller, spec = I.migrate(items, INDEX)
    assert "content_embedding" not in smaller.columns and smaller.count() == 5 and spec.field("title").kind == "text"
    lost = I.migration_check(INDEX, I.VECTOR_FEATURES | {"facets"}, frozenset({"text", "vector"}), frozenset({"facets"}), frozenset({"text"}))
    assert lost == {"features": ["embeddings", "hybrid_search", "vector_search"], "types": ["vector"], "fields": ["content_embedding"]}
    stored, tasks = I.queued(items, INDEX, F.col("body"), "s", 7)
    assert stored.where("content_embedding is not null").count() == 0 and {r.item_id for r in tasks.collect()} == {"1", "2", "3", "4"}
    raw = spark.createDataFrame([(7, "node", None, "<b>x</b>", "3")], "item_id long, datasource string, language string, title string, size string")
    row = I.prepare_items(raw, INDEX).first()
    assert (row.item_id, row.language, row.title, row.size, row.tags) == ("7", "", "x", 3, None)


def test_layouts(spark, items, tmp_path):
    path = str(tmp_path)
    for field, advice in (("tags", "postings"), ("size", "sort"), ("live", "hash")):
        FC.lay_out(items, INDEX, field, advice, path, 2)
    assert FC.layouts(spark, path) == ["live", "size", "tags"]
    counts = FC.by_expression(spark.read.parquet(FC.layout_path(path, "tags")), F.col("value"), Facet("tags"))
    assert {tuple(r) for r in counts.collect()} == {("b", 3), ("a", 1)}
    FC.lay_out(items, INDEX, "live", "none", path, 2)
    assert FC.drop_orphans(spark, IndexSpec("articles", (FieldSpec("size", "integer"),)), path) == ["tags"] and FC.layouts(spark, path) == ["size"]


def test_query_digest():
    a, b = (Query(keys=k, where=Group((Cond("size", [1, 2], "IN"),))) for k in ({"0": "x", "1": "y"}, {"1": "y", "0": "x"}))
    assert a.digest("t") == b.digest("t") != a.digest("u") and a.digest("t") != Query(keys="x").digest("t")


def test_random_trees_agree_with_sql(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, 0, 1, 2, 3]), rng.choice([None, "", "a", "b", "ab"])) for i in range(60)]
    df = spark.createDataFrame(rows, "item_id int, n long, s string")
    index = IndexSpec("t", (FieldSpec("n", "integer"), FieldSpec("s", "string")))
    duck = duckdb.connect()
    duck.sql("CREATE TABLE t (item_id INT, n BIGINT, s VARCHAR)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)

    def tree(depth):
        if depth and rng.random() < 0.6:
            members = [tree(depth - 1) for _ in range(rng.randint(1, 3))]
            word = rng.choice(["AND", "OR"])
            return Group(tuple(m for m, _ in members), word), "(" + f" {word} ".join(s for _, s in members) + ")"
        op = rng.choice(["=", "<>", "<", ">=", "IN", "NOT IN", "BETWEEN", "NOT BETWEEN", "IS NULL", "IS NOT NULL"])
        if op in ("IN", "NOT IN"):
            return Cond("n", [1, 2], op), f"n {op} (1, 2)"
        if "BETWEEN" in op:
            return Cond("n", [1, 2], op), f"n {op} 1 AND 2"
        if "NULL" in op:
            return Cond("s", op=op), f"s {op}"
        return (Cond("s", "a", op), f"s {op} 'a'") if rng.random() < 0.5 else (Cond("n", 1, op), f"n {op} 1")

    for _ in range(25):
        group, sql = tree(3)
        group = group if isinstance(group, Group) else Group((group,))
        assert sorted(r.item_id for r in df.where(compile_group(index, group)).collect()) == sorted(r[0] for r in duck.sql(f"SELECT item_id FROM t WHERE {sql}").fetchall()), sql
