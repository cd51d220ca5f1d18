"""Smaller pieces: tables that exist, wrapped values, access grants, likeness as a condition, failure rates, introspection."""

import pytest
from pyspark.sql import functions as F

from seekframe.operators import analytics as A
from seekframe.operators import facets as FC
from seekframe.operators import indexing as I
from seekframe.operators.predicates import condition
from seekframe.operators.search import search
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Facet, Group, Query
from seekframe.sources import tables as TB

INDEX = IndexSpec("x", (FieldSpec("body", "text"), FieldSpec("owner", "entity_reference"), FieldSpec("names", "string", -1), FieldSpec("node_grants", "string"), FieldSpec("vec", "vector", dimensions=2)))


def test_a_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "t")
    I.create_table(spark, path, INDEX)
    assert I.read_table(spark, path).count() == 0 and TB.describe(I.read_table(spark, path))[0] == ("item_id", "string")
    with pytest.raises(SpecError):
        I.create_table(spark, path, INDEX)
    I.drop_table(spark, path)
    I.create_table(spark, path, INDEX)


def test_wrapped_values(spark):
    kind = "item_id string, datasource string, language string, body struct<value: struct<value: string>, format: string>, owner array<struct<target_id: string>>, names array<struct<value: string>>, node_grants struct<a: int>"
    rows = [("1", "n", "en", (("<b>hello</b>",), "html"), [("7",), ("8",)], [("a",), (None,), None, ("b",)], (1,)), ("2", "n", None, None, [], None, None)]
    got = {r.item_id: r for r in I.prepare_items(spark.createDataFrame(rows, kind), INDEX).collect()}
    assert got["1"].body == "hello" and got["1"].owner == 7 and got["1"].names == ["a", "b"] and got["1"].node_grants == '{"a":1}'
    assert got["2"].body is None and got["2"].owner is None and got["2"].language == "" and got["2"].vec is None


def test_access_grants_and_likeness_as_conditions(spark):
    df = spark.createDataFrame([("1", "node_access__all", [1.0, 0.0]), ("2", "other", [0.0, 1.0]), ("3", None, None)], "item_id string, node_grants string, vec array<float>")
    pick = lambda c: sorted(r.item_id for r in df.where(condition(INDEX, c)).collect())
    assert pick(Cond("node_grants", "node_access_all:0")) == ["1"]
    assert pick(Cond("vec", ([1.0, 0.1], 0.9), "SIMILAR")) == ["1"] and pick(Cond("vec", ((0.0, 0.0), 0.0), "SIMILAR")) == []
    for bad in (lambda: Cond("vec", [1.0], "SIMILAR"), lambda: condition(INDEX, Cond("body", ([1.0], 0.1), "SIMILAR")), lambda: condition(INDEX, Cond("vec", 1))):
        with pytest.raises(SpecError):
            bad()
    full = df.selectExpr("*", "'n' AS datasource", "'en' AS language", "item_id AS body", "1L AS owner", "array('a') AS names")
    q = Query(where=Group((Cond("vec", ([1.0, 0.1], 0.9), "SIMILAR"), Cond("body", "3")), "OR"))
    assert sorted(r.item_id for r in search(full, INDEX, q).rows.collect()) == ["1", "3"]


def test_failure_rate(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", False)], "s string, bad boolean")
    got = {r.s: (r.total, r.failures, r.fallback) for r in A.failing(df, "s", F.col("bad"), 0.5).collect()}
    assert got == {"a": (2, 1, True), "b": (1, 0, False)}


def test_introspection(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert TB.table(spark, str(tmp_path), "t").count() == 3
    with pytest.raises(SpecError):
        TB.table(spark, str(tmp_path), "t; drop")
    spark.range(2).createOrReplaceTempView("seen")
    assert TB.exists(spark, "seen") and not TB.exists(spark, "unseen")
    df = spark.createDataFrame([("a",), ("a",), (None,)], "kind string")
    assert [tuple(r) for r in FC.terms(df, FieldSpec("kind", "string"), Facet("kind", missing=True)).collect()] == [("a", 2), (None, 1)]
