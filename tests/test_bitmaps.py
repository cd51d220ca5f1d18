"""Facets from bitmaps are those from items."""

import datetime
import random

import pytest

from seekframe.operators import bitmaps as BM
from seekframe.operators import facets as FC
from seekframe.operators.search import Items, search
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Facet, Group, Query

INDEX = IndexSpec("x", (FieldSpec("kind", "string"), FieldSpec("size", "integer"), FieldSpec("live", "boolean"), FieldSpec("day", "date"), FieldSpec("tags", "string", -1)), "item_id", "datasource", "language")


def test_bitmap_facets(spark, tmp_path):
    rng = random.Random(3)
    ids = rng.sample(range(200_000), 400) + [-5, -70_000, 2**40, 32767, 32768, 0]
    rows = [(i, "n", rng.choice(["en", "de"]), rng.choice([None, "", "a", 'b"', "c"]), rng.choice([None, -1, 0, 1, 2]), rng.choice([None, True, False]), rng.choice([None, datetime.datetime(2024, 1, rng.randrange(1, 4), 5)]), ["x"]) for i in ids]
    df = spark.createDataFrame(rows, "item_id long, datasource string, language string, kind string, size long, live boolean, day timestamp_ntz, tags array<string>")
    made = {}
    for f in ("kind", "size", "live", "day"):
        BM.write(BM.build(df, INDEX, f), str(tmp_path / f), 2)
        made[f] = BM.read(spark, str(tmp_path / f))
    plain, fast = Items(df), Items(df, bitmaps=made)
    for f in made:
        for facet in (Facet(f), Facet(f, missing=True), Facet(f, limit=2, min_count=20)):
            for q in (Query(languages=("en",), where=Group((Cond("size", 0, ">="), Cond(f, op="IS NOT NULL"))), facets=(facet,)), Query(languages=("none",), facets=(facet,)))[: 1 + (f == "kind")]:
                a, b = ([tuple(r) for r in search(x, INDEX, q).facets[f].collect()] for x in (plain, fast))
                assert a == b, (f, facet, q)
    part = df.where("item_id % 2 = 0").select("item_id")  # some ids aren't in the bitmaps
    BM.write(BM.build(df.where("item_id % 3 = 0"), INDEX, "kind"), str(tmp_path / "some"), 1)
    got = {r.value: r["count"] for r in BM.counts(BM.read(spark, str(tmp_path / "some")), part, "item_id", INDEX.field("kind"), True).collect()}
    want = {}
    for r in rows:
        if r[0] % 2 == 0:
            value = r[3] if r[0] % 3 == 0 else None
            want[value] = want.get(value, 0) + 1
    assert got == want
    plan = search(fast, INDEX, Query(facets=(Facet("kind"),))).facets["kind"]._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "bitmap_and_agg" in plan and "Cartesian" not in plan
    assert [tuple(r) for r in FC.labelled_from_bitmaps(df, "item_id", made["live"], INDEX.field("live"), Facet("live")).collect()] == [tuple(r) for r in FC.labelled(df, INDEX.field("live"), Facet("live")).collect()]
    for bad in ("tags",):
        with pytest.raises(SpecError):
            BM.build(df, INDEX, bad)
    with pytest.raises(SpecError):
        BM.build(df.withColumn("item_id", df.item_id.cast("string")), INDEX, "kind")
