"""One row of each near-duplicate group stays, whatever its ids."""

import threading

import pytest
from pyspark.sql import functions as F

from seekframe.llm import common as C
from seekframe.llm import shingles as SH
from seekframe.llm import simhash as S


def test_null_and_shared_ids_keep_one_row_a_group(spark):
    long = " ".join(f"word{i * i % 97}" for i in range(200))
    rows = [
        (None, "a text that no other row has at all", "x"),
        (None, long, "x"), (None, long, "y"),
        (4, "one of two texts that share an id", "x"), (4, "and this is something else entirely, unlike it", "x"),
        (7, "copied as a whole row", None), (7, "copied as a whole row", None),
        (9, "with and without an id", "x"), (None, "with and without an id", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in S.keep_one(df).collect()]
    assert sorted(r[:2] for r in got if r[0] is not None) == [(4, rows[4][1]), (4, rows[3][1]), (7, rows[5][1]), (9, rows[7][1])]
    assert sorted(r[1] for r in got if r[0] is None) == sorted([rows[0][1], long])
    assert S.keep_one(df).columns == df.columns


def test_columns_of_any_type(spark):
    rows = [(1, "one text here", {"a": 1}, [{"b": 2}]), (1, "one text here", {"a": 1}, [{"b": 2}]), (2, "one text here", None, None), (3, "something else", {}, [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, m map<string, int>, deep array<map<string, int>>")
    got = S.keep_one(df).collect()
    assert sorted(r.doc_id for r in got) == [1, 3] and next(r.m for r in got if r.doc_id == 1) == {"a": 1}


@pytest.mark.parametrize("find", [S.near_duplicates, SH.near_copies])
def test_equal_names_of_different_rows(spark, monkeypatch, find):
    """Rows whose first hashes collide are no copies of one another."""
    real = C.row_hashes
    weak = lambda df: (F.pmod(real(df)[0], F.lit(3)), real(df)[1])
    monkeypatch.setattr(S, "row_hashes", weak)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(12)]
    df = spark.createDataFrame([*rows, (50, rows[4][1]), rows[7]], "doc_id long, text string")
    assert sorted(map(tuple, S.keep_one(df, find=find).collect())) == rows


def test_equal_names_of_different_sets(spark, monkeypatch):
    names = SH.class_names
    monkeypatch.setattr(SH, "class_names", lambda b: (names(b)[0] % 2, names(b)[1]))
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(6)]
    df = spark.createDataFrame([*rows, (9, rows[0][1]), (10, rows[1][1] + " more")], "doc_id long, text string")
    groups = {}
    for r in SH.near_copies(df).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(map(sorted, groups.values())) == [[0, 9], [1, 10], [2], [3], [4], [5]]


def test_tables_of_other_threads_stay(spark):
    kept = []
    started, done = threading.Event(), threading.Event()

    def other():
        started.wait()
        kept.append(C.settle(spark.range(3), "other"))
        done.set()

    thread = threading.Thread(target=other)
    thread.start()
    with C.scratch() as mine:
        _, path = C.settle(spark.range(2), "mine")
        started.set()
        done.wait()
    thread.join()
    assert mine == [path]
    C.release(spark, mine)
    assert kept[0][0].count() == 3 and all(p != path for _, p in C._written)
    C.release(spark, [kept[0][1]])


def test_a_list_that_all_share_is_nowhere_whole(spark):
    """The lists of posted shingles are summed up and joined; no window or task holds one."""
    posts = spark.range(200_000).selectExpr("7L AS key", "id AS cls", "cast(100 + id % 3 AS int) AS size", "0 AS pos").union(spark.createDataFrame([(8, 1, 100, 0), (8, 2, 200, 0), (9, 3, 5, 0), (10, 1, 4, 0), (10, 2, 5, 0)], "key long, cls long, size int, pos int"))
    met = SH._meeting(posts)
    assert "Window" not in met._jdf.queryExecution().toString()
    assert {(r.key, r.n) for r in met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()} == {(7, 200_000), (10, 2)}
