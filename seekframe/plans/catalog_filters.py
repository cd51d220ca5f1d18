"""Registered queries: scans, condition operators, sorting and paging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators.predicates import compile_group, fields_of
from seekframe.operators.search import Items, order, page, search
from seekframe.plans import frames as T
from seekframe.plans.catalog import ORACLES, QUERIES, query
from seekframe.plans.query import Cond, Group, Query, Sort


def _filter(name: str, frame: str, group: Group, columns: str, sql: str) -> None:
    """Register one filter: columns of the rows of a frame for which the group holds."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        index = getattr(T, frame.upper())
        condition = compile_group(index, group)
        rows = getattr(T, frame)(spark, d)
        if isinstance(rows, Items):  # sides that the conditions name
            rows = rows.attach(rows.base, {*fields_of(group), *columns.split(", ")}, index.id_col)
        return (rows if condition is None else rows.where(condition)).select(*columns.split(", "))

    source = {"docs": T.DOCS_SQL, "parts": T.PARTS_SQL, "orders": "orders", "baskets": T.BASKETS_SQL}[frame]
    QUERIES[name] = run
    ORACLES[name] = f"SELECT {columns} FROM {source} WHERE {sql}"


def _and(*members: Cond | Group) -> Group:
    return Group(members)


PART = "p_partkey, p_name, p_size"
_filter("filter_eq", "parts", _and(Cond("p_type", "ECONOMY")), PART, "p_type = 'ECONOMY'")
_filter("filter_ne", "parts", _and(Cond("p_type", "ECONOMY", "<>")), PART, "p_type <> 'ECONOMY'")
_filter("filter_range_ops", "parts", _and(Cond("p_size", 10, ">="), Cond("p_size", 40, "<"), Cond("p_retailprice", 900, ">"), Cond("p_retailprice", 1500, "<=")), PART, "p_size >= 10 AND p_size < 40 AND p_retailprice > 900 AND p_retailprice <= 1500")
_filter("filter_in", "parts", _and(Cond("p_size", [1, 5, 11], "IN")), PART, "p_size IN (1, 5, 11)")
_filter("filter_in_empty", "parts", _and(Cond("p_size", [], "IN")), PART, "1 = 0")
_filter("filter_not_in", "parts", _and(Cond("p_size", [1, 5, 11], "NOT IN"), Cond("p_brand", [], "NOT IN")), PART, "p_size NOT IN (1, 5, 11)")
_filter("filter_between", "parts", _and(Cond("p_size", [10, 20], "BETWEEN")), PART, "p_size BETWEEN 10 AND 20")
_filter("filter_not_between", "parts", _and(Cond("p_size", [10, 20], "NOT BETWEEN")), PART, "p_size NOT BETWEEN 10 AND 20")
_filter("filter_contains", "docs", _and(Cond("text", "License", "CONTAINS")), "doc_id, source", "contains(text, 'License')")
_filter("filter_starts_with", "docs", _and(Cond("text", "Th", "STARTS_WITH")), "doc_id, source", "starts_with(text, 'Th')")
_filter("filter_ends_with", "docs", _and(Cond("text", "the.", "ENDS_WITH")), "doc_id, source", "ends_with(text, 'the.')")
_filter("filter_like", "parts", Group((Cond("p_name", "%d w_dget", "LIKE"), Cond("p_name", "%o%", "NOT LIKE")), "OR"), PART, "p_name LIKE '%d w_dget' OR p_name NOT LIKE '%o%'")
_filter("filter_is_null", "docs", _and(Cond("quality", op="IS NULL")), "doc_id, lang", "quality IS NULL")
_filter("filter_is_not_null", "docs", _and(Cond("quality", op="IS NOT NULL")), "doc_id, lang", "quality IS NOT NULL")
_filter("filter_nested_groups", "docs", _and(Group((Cond("lang", "en"), _and(Cond("lang", "fr"), Cond("n_chars", 1000, ">"))), "OR"), Group(), Group((Cond("quality", True), Cond("n_chars", 500, "<")), "OR")), "doc_id, lang, n_chars", "(lang = 'en' OR (lang = 'fr' AND n_chars > 1000)) AND (quality OR n_chars < 500)")
_filter("filter_boolean", "docs", _and(Cond("quality", 1), Cond("toxic", "true", "<>")), "doc_id, quality, toxic", "quality = true AND toxic <> true")
_filter("array_eq", "baskets", _and(Cond("suppliers", 7)), "l_orderkey", "list_contains(suppliers, 7)")
_filter("array_ne", "baskets", _and(Cond("suppliers", 7, "<>"), Cond("flags", "R", "!=")), "l_orderkey", "NOT list_contains(suppliers, 7) AND NOT list_contains(flags, 'R')")
_filter("array_range", "baskets", _and(Cond("suppliers", 95, ">"), Cond("suppliers", 4, "<=")), "l_orderkey", "len(list_filter(suppliers, lambda x: x > 95)) > 0 AND len(list_filter(suppliers, lambda x: x <= 4)) > 0")
_filter("array_in", "baskets", _and(Cond("suppliers", [3, 5, 8], "IN"), Cond("flags", ["A"], "IN")), "l_orderkey", "list_has_any(suppliers, [3, 5, 8]) AND list_has_any(flags, ['A'])")
_filter("array_between", "baskets", _and(Cond("suppliers", [10, 12], "BETWEEN")), "l_orderkey", "len(list_filter(suppliers, lambda x: x BETWEEN 10 AND 12)) > 0")


@query("SELECT p_partkey, p_name FROM part WHERE string_split(p_name, ' ') IS NULL OR len(list_filter(string_split(p_name, ' '), lambda t: contains(t, 'i'))) = 0")
def array_is_null(spark: SparkSession, d: str) -> DataFrame:
    """Parts without a tag that has an i: their filtered tags are an empty array."""
    tagged = T.parts(spark, d).withColumn("tags", F.filter("tags", lambda t: t.contains("i")))
    return tagged.where(compile_group(T.PARTS, _and(Cond("tags", op="IS NULL")))).select("p_partkey", "p_name")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('de', 'es')")
def filter_language(spark: SparkSession, d: str) -> DataFrame:
    return search(T.docs(spark, d), T.DOCS, Query(languages=("de", "es"), fields=("n_chars",))).rows.select("doc_id", "lang")


@query("SELECT doc_id, source, lang, n_chars FROM documents")
def scan_project(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")


@query("SELECT doc_id, lang, 1.0::DOUBLE AS score FROM documents WHERE n_chars > 3000")
def search_no_keys(spark: SparkSession, d: str) -> DataFrame:
    return search(T.docs(spark, d), T.DOCS, Query(where=_and(Cond("n_chars", 3000, ">")), fields=("n_chars",))).rows.select("doc_id", "lang", "score")


@query(f"SELECT doc_id, source, lang, n_chars, quality, 1.0::DOUBLE AS score FROM {T.DOCS_SQL}")
def retrieved_fields(spark: SparkSession, d: str) -> DataFrame:
    return search(T.docs(spark, d), T.DOCS, Query(fields=("n_chars", "quality"))).rows


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_totalprice ASC NULLS LAST, o_orderkey LIMIT 200")
def sort_field(spark: SparkSession, d: str) -> DataFrame:
    sorts = (Sort("o_orderdate", "DESC"), Sort("o_totalprice"))
    return page(T.orders(spark, d), order(sorts, T.ORDERS), 200, 0).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT o_orderkey, md5('42 ' || o_orderkey) AS place FROM orders ORDER BY place, o_orderkey LIMIT 500")
def sort_random(spark: SparkSession, d: str) -> DataFrame:
    """A page of orders in a random order that a seed repeats: by a hash of seed and id, so that retries and pages agree."""
    place = F.md5(F.concat(F.lit("42 "), F.col("o_orderkey").cast("string")))
    return page(T.orders(spark, d).select("o_orderkey", place.alias("place")), [F.asc("place"), F.asc("o_orderkey")], 500, 0)


@query("SELECT p_partkey, p_size FROM part ORDER BY p_size ASC NULLS LAST, p_partkey LIMIT 25 OFFSET 50")
def page_limit_offset(spark: SparkSession, d: str) -> DataFrame:
    return page(T.parts(spark, d), order((Sort("p_size"),), T.PARTS), 25, 50).select("p_partkey", "p_size")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 10")
def top_k(spark: SparkSession, d: str) -> DataFrame:
    return page(T.orders(spark, d), order((Sort("o_totalprice", "DESC"),), T.ORDERS), 10, 0).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS result_count FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def result_count(spark: SparkSession, d: str) -> DataFrame:
    asked = Query(where=_and(Cond("o_orderstatus", "F"), Cond("o_totalprice", 100000, ">")), limit=5)
    return search(T.orders(spark, d), T.ORDERS, asked).count


@query("SELECT p_partkey, p_name, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS n FROM part) WHERE n = 1")
def grouping(spark: SparkSession, d: str) -> DataFrame:
    """The first item of each group, by a partial aggregation instead of a sort of whole groups."""
    best = F.max_by(F.struct("p_partkey", "p_name"), F.struct("p_retailprice", -F.col("p_partkey"))).alias("x")
    return T.parts(spark, d).groupBy("p_brand").agg(best).select("x.p_partkey", "x.p_name", "p_brand")
