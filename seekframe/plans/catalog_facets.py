"""Registered queries: facets, multi-value texts, field statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators import facets as FC
from seekframe.operators.predicates import compile_group
from seekframe.operators.search import search
from seekframe.plans import frames as T
from seekframe.plans.catalog import query
from seekframe.plans.model import FieldSpec
from seekframe.plans.query import Cond, Facet, Group, Query
from seekframe.sources.tables import scratch_folder

TOK = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')"
BY_COUNT = "ORDER BY count DESC, value LIMIT 50"


def _facet(spark: SparkSession, d: str, q: Query, name: str) -> DataFrame:
    return search(T.orders(spark, d), T.ORDERS, q).facets[name]


@query(f"SELECT o_orderpriority AS value, count(*) AS count FROM orders WHERE o_orderpriority <> '' GROUP BY 1 HAVING count(*) >= 2 {BY_COUNT}")
def facet_terms(spark: SparkSession, d: str) -> DataFrame:
    return FC.terms(T.orders(spark, d), T.ORDERS.field("o_orderpriority"), Facet("o_orderpriority", min_count=2))


@query(f"SELECT value, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) WHERE value <> '' GROUP BY 1 {BY_COUNT}")
def facet_multi_value(spark: SparkSession, d: str) -> DataFrame:
    return FC.terms(T.parts(spark, d), T.PARTS.field("tags"), Facet("tags"))


@query("SELECT p_size AS value, count(*) AS count FROM part WHERE p_size > 0 GROUP BY 1")
def facet_integer(spark: SparkSession, d: str) -> DataFrame:
    return FC.terms(T.parts(spark, d), T.PARTS.field("p_size"), Facet("p_size", limit=0))


@query("SELECT CASE WHEN quality IS NULL THEN '!' ELSE '\"' || quality::VARCHAR || '\"' END AS filter, count(*) AS count FROM " + T.DOCS_SQL + " GROUP BY 1")
def facet_missing(spark: SparkSession, d: str) -> DataFrame:
    source = T.docs(spark, d)
    return FC.labelled(source.attach(source.base, ("quality",), "doc_id"), T.DOCS.field("quality"), Facet("quality", missing=True))


@query("SELECT quality::VARCHAR AS value, count(*) AS count FROM " + T.DOCS_SQL + " WHERE quality IS NOT NULL GROUP BY 1")
def facet_boolean(spark: SparkSession, d: str) -> DataFrame:
    source = T.docs(spark, d)
    return FC.terms(source.attach(source.base, ("quality",), "doc_id"), T.DOCS.field("quality"), Facet("quality")).select(FC.value_text(F.col("value"), "boolean").alias("value"), "count")


@query("SELECT '\"' || o_orderstatus || '\"' AS filter, count(*) AS count FROM orders WHERE o_totalprice > 50000 GROUP BY 1")
def facet_excludes_self(spark: SparkSession, d: str) -> DataFrame:
    """The status facet ignores the status condition, but not the price."""
    q = Query(where=Group((Cond("o_orderstatus", "F"), Cond("o_totalprice", 50000, ">"))), facets=(Facet("o_orderstatus"),))
    return _facet(spark, d, q, "o_orderstatus")


@query(f"SELECT '\"' || quality::VARCHAR || '\"' AS filter, count(*) AS count FROM (SELECT quality, {TOK} AS tok FROM {T.DOCS_SQL}) WHERE list_contains(tok, 'the') AND quality IS NOT NULL GROUP BY 1")
def facet_with_keys(spark: SparkSession, d: str) -> DataFrame:
    """Counts of what keywords find, from bitmaps of the field's values and of the found ids."""
    return search(T.docs(spark, d, "simple", bitmaps=("quality",)), T.DOCS, Query(keys="the", facets=(Facet("quality"),))).facets["quality"]


@query("SELECT CAST(o_orderdate AS DATE)::VARCHAR AS value, count(*) AS count FROM orders GROUP BY 1 ORDER BY count DESC, value LIMIT 50")
def facet_date_day(spark: SparkSession, d: str) -> DataFrame:
    return FC.terms(T.orders(spark, d), T.ORDERS.field("o_orderdate"), Facet("o_orderdate")).select(FC.value_text(F.col("value"), "date").alias("value"), "count")


@query("SELECT '\"' || replace(replace(p_brand, '\\', '\\\\'), '\"', '\\\"') || '\"' AS filter, count(*) AS count FROM part GROUP BY 1")
def facet_labels(spark: SparkSession, d: str) -> DataFrame:
    return FC.labelled(T.parts(spark, d), T.PARTS.field("p_brand"), Facet("p_brand", limit=0))


@query("SELECT '[' || strftime(m, '%Y-%m-%d') || ' ' || strftime(m + INTERVAL 1 MONTH, '%Y-%m-%d') || ')' AS value, count(*) AS count FROM (SELECT date_trunc('month', o_orderdate) AS m FROM orders) GROUP BY 1")
def facet_date_month(spark: SparkSession, d: str) -> DataFrame:
    return FC.by_expression(T.orders(spark, d), FC.month_range(F.to_date("o_orderdate")), Facet("o_orderdate", limit=0))


_STEP = "CASE WHEN v >= 1000 THEN 1000 WHEN v >= 100 THEN 100 WHEN v >= 10 THEN 10 END"


@query(f"SELECT CASE WHEN v < 10 THEN v::VARCHAR ELSE '[' || ((v // {_STEP}) * {_STEP}) || ' ' || ((v // {_STEP}) * {_STEP} + {_STEP}) || ')' END AS value, count(*) AS count FROM (SELECT n_chars AS v FROM documents) GROUP BY 1")
def facet_numeric_range(spark: SparkSession, d: str) -> DataFrame:
    return FC.by_expression(T.table(spark, d, "documents"), FC.magnitude_range(F.col("n_chars")), Facet("n_chars", limit=0))


@query("""WITH c AS (SELECT source, n_chars AS v, count(*) AS c FROM documents GROUP BY ALL),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM c),
q AS (SELECT source, max(v) FILTER (i = floor(n * 0.25)) AS q1, max(v) FILTER (i = floor(n * 0.5)) AS q2, max(v) FILTER (i = floor(n * 0.75)) AS q3, min(v) AS lo, max(v) AS hi FROM p WHERE n >= 3 GROUP BY source)
SELECT source, CASE WHEN v <= q1 THEN 1 WHEN v <= q2 THEN 2 WHEN v <= q3 THEN 3 ELSE 4 END AS quartile,
CASE WHEN v <= q1 THEN lo WHEN v <= q2 THEN q1 WHEN v <= q3 THEN q2 ELSE q3 END AS low, CASE WHEN v <= q1 THEN q1 WHEN v <= q2 THEN q2 WHEN v <= q3 THEN q3 ELSE hi END AS high,
sum(c)::BIGINT AS count FROM c JOIN q USING (source) GROUP BY ALL""")
def facet_quartiles(spark: SparkSession, d: str) -> DataFrame:
    return FC.quartiles(T.table(spark, d, "documents"), "n_chars", "source")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND (o_totalprice >= 1000 AND o_totalprice < 90000)")
def facet_filter_apply(spark: SparkSession, d: str) -> DataFrame:
    q = Query(facet_filters=(("o_orderstatus", ('"F"', '"P"')), ("o_totalprice", ("[1000 90000)",))))
    return search(T.orders(spark, d), T.ORDERS, q).rows.select("o_orderkey")


@query("SELECT doc_id FROM documents WHERE (n_chars > 100 AND n_chars <= 900) OR n_chars >= 5000")
def facet_filter_range(spark: SparkSession, d: str) -> DataFrame:
    condition = compile_group(T.DOCS, FC.filters(T.DOCS, [("n_chars", ["(100 900]", "[5000 *]"])]))
    return T.table(spark, d, "documents").where(condition).select("doc_id")


_JSON = FieldSpec("tags", "string", -1)


def _json(spark: SparkSession, d: str) -> DataFrame:
    return T.parts(spark, d).select("p_partkey", F.to_json("tags").alias("t"))


@query("SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'red')")
def mv_json_contains(spark: SparkSession, d: str) -> DataFrame:
    return _json(spark, d).where(F.array_contains(F.from_json("t", "array<string>"), "red")).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE list_contains(string_split(p_name, ' '), 'bolt')")
def mv_separated_contains(spark: SparkSession, d: str) -> DataFrame:
    texts = T.parts(spark, d).select("p_partkey", F.array_join("tags", "|").alias("t"))
    return texts.where(F.array_contains(F.split("t", r"\|"), "bolt")).select("p_partkey")


@query(f"SELECT value, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) GROUP BY 1 {BY_COUNT}")
def facet_json_array(spark: SparkSession, d: str) -> DataFrame:
    return FC.terms(_json(spark, d).select(F.from_json("t", "array<string>").alias("tags")), _JSON, Facet("tags"))


@query(f"SELECT value, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) GROUP BY 1 {BY_COUNT}")
def facet_separated(spark: SparkSession, d: str) -> DataFrame:
    texts = T.parts(spark, d).select(F.array_join("tags", ",").alias("t"))
    return FC.terms(texts.select(F.split("t", ",").alias("tags")), _JSON, Facet("tags"))


@query("SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'json' WHEN 1 THEN 'array' WHEN 2 THEN 'separated' WHEN 3 THEN 'single' WHEN 4 THEN 'json' WHEN 5 THEN 'json' WHEN 6 THEN 'single' ELSE 'json' END AS format FROM part")
def detect_mv_format(spark: SparkSession, d: str) -> DataFrame:
    """Arrays and objects as JSON, braces that are no JSON, parts behind a separator, a blank first part, single values."""
    kind = F.col("p_partkey") % 8
    made = (
        F.when(kind == 0, F.to_json("tags")).when(kind == 1, F.concat(F.lit("{"), F.array_join("tags", ","), F.lit("}"))).when(kind == 2, F.array_join("tags", ";"))
        .when(kind == 3, F.get("tags", F.lit(0))).when(kind == 4, F.to_json(F.create_map(F.lit("a"), "p_size"))).when(kind == 5, F.lit("[]")).when(kind == 6, F.concat(F.lit("|"), F.get("tags", F.lit(0)))).otherwise(F.lit("[true, [1, 2]]"))
    )
    return T.parts(spark, d).select("p_partkey", FC.detect_format(made).alias("format"))


@query("SELECT 'p_name' AS field, 'single' AS format, CAST(NULL AS VARCHAR) AS separator UNION ALL SELECT 'bars', 'separated', '|' UNION ALL SELECT 'listed', 'json', ',' UNION ALL SELECT 'braced', 'array', ','")
def detect_mv_batch(spark: SparkSession, d: str) -> DataFrame:
    """How several columns are written, in one pass."""
    rows = T.parts(spark, d).select("p_name", F.array_join(F.array("p_name", "p_type", "p_brand"), "|").alias("bars"), F.to_json(F.array("p_name", "p_type", "p_brand")).alias("listed"), F.concat(F.lit("{"), F.array_join(F.array("p_name", "p_type", "p_brand"), ","), F.lit("}")).alias("braced"))
    return FC.detect_formats(rows, rows.columns)


@query(f"SELECT value, count(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS value FROM part) WHERE value <> '' GROUP BY 1 {BY_COUNT}")
def facet_from_layout(spark: SparkSession, d: str) -> DataFrame:
    """Counts from the postings that were laid out for a field, without the items."""
    folder = scratch_folder(spark, "layout")
    FC.lay_out(T.parts(spark, d), T.PARTS, "tags", "postings", folder, 2)
    laid = spark.read.parquet(FC.layout_path(folder, "tags"))
    return FC.by_expression(laid, F.col("value"), Facet("tags"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '|' WHEN 1 THEN ',' WHEN 2 THEN ';' END AS separator FROM part")
def detect_separator(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("p_partkey") % 4
    three = F.array("p_brand", "p_type", "p_name")
    made = F.when(kind == 0, F.array_join(three, "|")).when(kind == 1, F.array_join(three, ",")).when(kind == 2, F.array_join(three, ";")).otherwise(F.array_join(F.array("p_brand", "p_type"), "|"))
    return T.parts(spark, d).select("p_partkey", FC.detect_separator(made).alias("separator"))


_STATS_SQL = " UNION ALL ".join(f"SELECT '{c}' AS field, '{k}' AS kind, count({c}) AS rows, count(DISTINCT {c}) AS \"distinct\", round(avg(length({c}::VARCHAR)), 6) AS avg_length FROM part" for c, k in (("p_brand", "string"), ("p_type", "string"), ("p_name", "string"), ("p_size", "integer")))


def _statistics(spark: SparkSession, d: str) -> DataFrame:
    """All fields in one pass over the table."""
    fields = (("p_brand", "string"), ("p_type", "string"), ("p_name", "string"), ("p_size", "integer"))
    each = [x for c, _ in fields for x in (F.count(c).alias(f"n_{c}"), F.count_distinct(c).alias(f"d_{c}"), F.avg(F.char_length(F.col(c).cast("string"))).alias(f"l_{c}"))]
    one = T.parts(spark, d).agg(*each)
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.lit(k).alias("kind"), F.col(f"n_{c}").alias("rows"), F.col(f"d_{c}").alias("distinct"), F.round(f"l_{c}", 6).alias("avg_length")) for c, k in fields))
    return one.select(F.inline(rows))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-03-01', DATE '1995-03-02') OR (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01')")
def facet_filter_dates(spark: SparkSession, d: str) -> DataFrame:
    """Days and a month, as the labels of date facets give them."""
    chosen = (("o_orderdate", ('"1995-03-01"', "1995-03-02", "[1996-01-01 1996-02-01)")),)
    return search(T.orders(spark, d), T.ORDERS, Query(facet_filters=chosen, fields=("o_orderstatus",))).rows.select("o_orderkey")


@query(_STATS_SQL)
def field_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _statistics(spark, d)


@query(f"SELECT field, CASE WHEN rows < 500 THEN 'none' WHEN avg_length > 200 THEN 'none' WHEN kind = 'integer' THEN 'sort' WHEN \"distinct\"::DOUBLE / rows > 0.8 THEN 'hash' ELSE 'partial' END AS advice FROM ({_STATS_SQL})")
def facet_layout_advice(spark: SparkSession, d: str) -> DataFrame:
    return FC.layout_advice(_statistics(spark, d)).select("field", "advice")
