"""Facets: grouped counts, labels, ranges, and the filters that come back from them."""

from __future__ import annotations

import datetime
import re
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seekframe.operators import bitmaps as BM
from seekframe.plans.model import FACETABLE, FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Facet, Group
from seekframe.sources.tables import scratch_folder

MISSING = "!"
_RANGE = re.compile(r"^([\[(])\s*(\S+)\s+(\S+?)\s*([\])])$")
# Endings of field names that belong to one concept, stripped in this order of groups.
SUFFIX_GROUPS = (("_name", "_id", "_hierarchy", "_parents", "_children"), ("_target_id", "_entity", "_label"))


def value_text(c: Column, kind: str) -> Column:
    """A facet value as text: dates by day, booleans as true and false."""
    return F.date_format(c, "yyyy-MM-dd") if kind == "date" else c.cast("string")


def label(value: Column, kind: str) -> Column:
    """The filter of a value: quoted, with backslash and quote escaped; ``!`` for null."""
    escaped = F.regexp_replace(F.regexp_replace(value_text(value, kind), r"\\", r"\\\\"), '"', r'\\"')
    return F.when(value.isNull(), MISSING).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))


def month_range(day: Column) -> Column:
    """``[first-of-month first-of-next-month)``."""
    first = F.trunc(day, "MM")
    return F.concat(F.lit("["), F.date_format(first, "yyyy-MM-dd"), F.lit(" "), F.date_format(F.add_months(first, 1), "yyyy-MM-dd"), F.lit(")"))


def magnitude_range(value: Column) -> Column:
    """``[low high)`` in steps of a thousand, a hundred or ten by the size of the value; below ten the value itself."""
    step = F.when(value >= 1000, 1000).when(value >= 100, 100).when(value >= 10, 10)
    low = (F.floor(value / step) * step).cast("bigint")
    return F.when(step.isNull(), value.cast("string")).otherwise(F.concat(F.lit("["), low.cast("string"), F.lit(" "), (low + step).cast("string"), F.lit(")")))


def ranked(counts: DataFrame, facet: Facet, value: str = "value") -> DataFrame:
    """Counts of at least min_count, the highest first, then by value; a top-k, not a sort, if there is a limit."""
    out = counts.where(F.col("count") >= facet.min_count).orderBy(F.desc("count"), F.col(value).asc_nulls_last())
    return out.limit(facet.limit) if facet.limit else out


def terms(items: DataFrame, spec: FieldSpec, facet: Facet) -> DataFrame:
    """(value, count). Without missing: no nulls, no empty strings, integers above zero only."""
    if spec.kind not in FACETABLE:
        raise SpecError(f"{spec.name}: {spec.kind} fields have no facets")
    c = F.col(spec.name)
    if spec.multi_value:
        values = items.select((F.explode_outer if facet.missing else F.explode)(c).alias("value"))
    else:
        values = items.select(c.alias("value"))
    if not facet.missing:
        values = values.where("value is not null")
        if spec.kind in ("integer", "entity_reference"):
            values = values.where("value > 0")
        elif spec.kind == "string":
            values = values.where("value <> ''")
    if spec.kind == "date":
        values = values.select(F.to_date("value").alias("value"))
    return ranked(values.groupBy("value").agg(F.count(F.lit(1)).alias("count")), facet)


def labelled(items: DataFrame, spec: FieldSpec, facet: Facet) -> DataFrame:
    """(filter, count): terms with their labels."""
    return terms(items, spec, facet).select(label(F.col("value"), "string" if spec.kind == "date" else spec.kind).alias("filter"), "count")


def labelled_from_bitmaps(found: DataFrame, id_col: str, bitmaps: DataFrame, spec: FieldSpec, facet: Facet) -> DataFrame:
    """(filter, count) of the found ids, as ``labelled``, from a field's bitmaps."""
    out = ranked(BM.counts(bitmaps, found, id_col, spec, facet.missing), facet)
    return out.select(label(F.col("value"), "string" if spec.kind == "date" else spec.kind).alias("filter"), "count")


def by_expression(items: DataFrame, value: Column, facet: Facet) -> DataFrame:
    """(value, count) of a computed label; equal labels are one group."""
    return ranked(items.select(value.alias("value")).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("count")), facet)


def _numbered(counts: DataFrame, keys: list[str]) -> DataFrame:
    """counts(keys, v, c) with g, the number of each row in the order of keys and v.

    Rows are dealt by ranges and written; a range's numbers follow the counts of those before it, so neither a group nor
    the whole is ever sorted in one task.
    """
    spark = counts.sparkSession
    path = scratch_folder(spark, "quartiles")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts.repartitionByRange(ranges, *keys, "v").withColumn("range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    each = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row for each range, at most
    before = each.select(F.col("range").alias("r"), F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = Window.partitionBy("range").orderBy(*keys, "v")
    return dealt.join(F.broadcast(before), F.col("range") == F.col("r")).withColumn("g", F.row_number().over(own) + F.col("before")).drop("range", "r", "before")


def quartiles(values: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Quartile ranges of a column's distinct values, (range, low, high, count), for at least three values.

    Counts per distinct value come first, so what is sorted is distinct values; positions are floor(n * q).
    """
    key = F.col(by) if by else F.lit(0)
    counts = values.where(F.col(column).isNotNull()).groupBy(key.alias("k"), F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    placed = _numbered(counts, ["k"])
    groups = placed.groupBy("k").agg(F.min("g").alias("base"), F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).where("n >= 3")
    at = lambda q: F.max(F.when(F.col("g") - F.col("base") == F.floor(F.col("n") * q), F.col("v")))
    groups = groups.withColumnRenamed("k", "of")
    cuts = placed.join(groups, F.col("k").eqNullSafe(F.col("of"))).groupBy("of", "lo", "hi").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    cut = placed.select("k", "v", "c").join(cuts, F.col("k").eqNullSafe(F.col("of")))
    part = F.when(F.col("v") <= F.col("q1"), 1).when(F.col("v") <= F.col("q2"), 2).when(F.col("v") <= F.col("q3"), 3).otherwise(4)
    low = F.when(F.col("quartile") == 1, F.col("lo")).when(F.col("quartile") == 2, F.col("q1")).when(F.col("quartile") == 3, F.col("q2")).otherwise(F.col("q3"))
    high = F.when(F.col("quartile") == 1, F.col("q1")).when(F.col("quartile") == 2, F.col("q2")).when(F.col("quartile") == 3, F.col("q3")).otherwise(F.col("hi"))
    cut = cut.withColumn("quartile", part).withColumns({"low": low, "high": high})
    keys = [F.col("k").alias(by)] if by else []
    return cut.groupBy(*keys, "quartile", "low", "high").agg(F.sum("c").alias("count"))


def parse_filter(field: str, text: str) -> Cond | Group:
    """A facet filter as conditions: ``!`` null, ``"x"`` a literal, ``[a b]`` and ``(a b)`` ranges, ``*`` an open end."""
    if text == MISSING:
        return Cond(field, op="IS NULL")
    if found := _RANGE.match(text):
        open_, low, high, close = found.groups()
        bounds = []
        if low != "*":
            bounds.append(Cond(field, _number(low), ">=" if open_ == "[" else ">"))
        if high != "*":
            bounds.append(Cond(field, _number(high), "<=" if close == "]" else "<"))
        return Group(tuple(bounds))
    if len(text) >= 2 and text[0] == text[-1] == '"':
        text = re.sub(r"\\(.)", r"\1", text[1:-1])
    return Cond(field, text)


def _number(text: str) -> int | float | str:
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def filters(index: IndexSpec, chosen: Collection[tuple[str, Collection[str]]]) -> Group:
    """Chosen facet filters: the values of a field are alternatives, fields must all hold."""
    groups = []
    for field, values in chosen:
        spec = index.field(field)
        members = []
        for v in values:
            made = parse_filter(field, v)
            if isinstance(made, Cond) and made.op == "=":
                made = _day(field, made.value) if spec.kind == "date" else Cond(field, _typed(made.value, spec), "=")
            members.append(made)
        groups.append(Group(tuple(members), "OR"))
    return Group(tuple(groups))


def _day(field: str, value: str) -> Group:
    """A day, as facets of dates have them: from its midnight to before the next; or one moment, if a time is given."""
    try:
        moment = datetime.datetime.fromisoformat(value.strip())
    except ValueError as e:
        raise SpecError(f"{field}: not a date: {value!r}") from e
    text = lambda x: x.isoformat(sep=" ")  # noqa: E731  as text it takes the type of the column, with or without a zone
    if len(value.strip()) > 10:
        return Group((Cond(field, text(moment), "="),))
    return Group((Cond(field, text(moment), ">="), Cond(field, text(moment + datetime.timedelta(days=1)), "<")))


def _typed(value: str, spec: FieldSpec) -> object:
    if spec.kind in ("integer", "entity_reference"):
        return int(value)
    if spec.kind == "decimal":
        return float(value)
    if spec.kind == "boolean":
        return value.lower() in ("true", "1", "yes", "on")
    return value


def related(field: str, other: str) -> bool:
    """Whether two field names are forms of one concept, as ``tags_id`` and ``tags_name``."""
    def bases(name: str) -> set[str]:
        return {name} | {name.removesuffix(s) for group in SUFFIX_GROUPS for s in group if name.endswith(s)}
    return bool(bases(field) & bases(other))


def detect_separator(text: Column) -> Column:
    """The most frequent of ``|``, ``,`` and ``;`` with at least two occurrences, in this order on ties; else null."""
    count = lambda s: F.char_length(text) - F.char_length(F.replace(text, F.lit(s), F.lit("")))
    bar, comma, semi = count("|"), count(","), count(";")
    best = F.greatest(bar, comma, semi)
    return F.when(best < 2, None).when(bar == best, "|").when(comma == best, ",").otherwise(";")


SEPARATORS = ("|", ",", ";", ":", "~")


def detect_format(text: Column) -> Column:
    """json, array, separated or single, by how a multi-value text is written.

    json: an array or object that parses; array: anything else in braces; separated: a separator after a first part that
    isn't blank.
    """
    t = F.coalesce(text, F.lit(""))
    json = (t.startswith("[") | t.startswith("{")) & F.try_parse_json(t).isNotNull()
    parted = reduce(lambda a, b: a | b, [(F.instr(t, s) > 0) & (F.trim(F.substring_index(t, s, 1)) != "") for s in SEPARATORS])
    return F.when(json, "json").when(t.rlike(r"^\{.*\}$"), "array").when(parted, "separated").otherwise("single")


def detect_formats(items: DataFrame, columns: Collection[str]) -> DataFrame:
    """(field, format, separator) of text columns, all in one pass over all rows.

    A column has the first of json, array and separated that any of its values has, else single; its separator is
    that of ``|``, ``,`` and ``;`` that occurs most, at least twice, in this order on ties.
    """
    has = lambda c, kind: F.max((detect_format(F.col(c)) == kind).cast("int"))
    count = lambda c, s: F.sum(F.char_length(c) - F.char_length(F.replace(F.col(c), F.lit(s), F.lit(""))))
    one = items.agg(*(x for i, c in enumerate(columns) for x in (*(has(c, k).alias(f"{k}{i}") for k in ("json", "array", "separated")), *(F.coalesce(count(c, s), F.lit(0)).alias(f"{n}{i}") for n, s in (("bar", "|"), ("comma", ","), ("semi", ";"))))))
    rows = []
    for i, c in enumerate(columns):
        bar, comma, semi = (F.col(f"{n}{i}") for n in ("bar", "comma", "semi"))
        best = F.greatest(bar, comma, semi)
        kind = F.when(F.col(f"json{i}") == 1, "json").when(F.col(f"array{i}") == 1, "array").when(F.col(f"separated{i}") == 1, "separated").otherwise("single")
        rows.append(F.struct(F.lit(c).alias("field"), kind.alias("format"), F.when(best < 2, None).when(bar == best, "|").when(comma == best, ",").otherwise(";").alias("separator")))
    return one.select(F.inline(F.array(*rows)))


def separator_for(field_setting: str | None = None, index_setting: str | None = None, detected: str | None = None) -> str:
    """The separator of a field: as the field says, else the index, else as detected, else ``|``."""
    return field_setting or index_setting or detected or "|"


def format_for(field_setting: str | None = None, index_setting: str | None = None) -> str:
    """How a field without data is written: as the field says, else the index, else separated."""
    return field_setting or index_setting or "separated"


def values_of(text: Column, kind: str, separator: str = "|") -> Column:
    """The values of a multi-value text as an array, trimmed, without empty ones; null for null."""
    parts = {
        "json": F.from_json(text, "array<string>"),
        "array": F.split(F.regexp_replace(text, r"^\{|\}$", ""), ","),
        "separated": F.split(text, re.escape(separator)),
        "single": F.when(text.isNotNull(), F.array(text)),
    }[kind]
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def layout_advice(statistics: DataFrame) -> DataFrame:
    """From (field, kind, rows, distinct, avg_length): how to lay the field out for facets.

    multi: exploded postings; small tables and long texts: nothing; nearly distinct: hash buckets; else partial sort.
    """
    share = F.try_divide(F.col("distinct").cast("double"), F.col("rows"))
    advice = (
        F.when(F.col("rows") < 500, "none").when(F.col("kind") == "multi", "postings").when(F.col("avg_length") > 200, "none")
        .when(F.col("kind") == "integer", "sort").when(share > 0.8, "hash").otherwise("partial")
    )
    return statistics.withColumn("advice", advice)


def layout_path(path: str, field: str) -> str:
    return f"{path}/facet={field}"


def lay_out(items: DataFrame, index: IndexSpec, field: str, advice: str, path: str, files: int) -> None:
    """Write the layout that is advised for a field: (value, id), ready for counts and filters of that field.

    postings: one row for each of an item's values; sort: in order of values; hash: dealt by value; partial: only rows
    that have a value, in order; none: nothing, and what was there goes.
    """
    spark, spec, to = items.sparkSession, index.field(field), layout_path(path, field)
    if advice == "none":
        drop_layout(spark, path, field)
        return
    value = F.explode(field) if spec.multi_value else F.col(field)
    rows = items.select(F.col(index.id_col).alias("id"), value.alias("value")).where("value is not null")
    rows = rows.repartition(files, "value") if advice == "hash" else rows.repartitionByRange(files, "value", "id").sortWithinPartitions("value", "id")
    rows.write.mode("overwrite").parquet(to)


def layouts(spark: SparkSession, path: str) -> list[str]:
    """Fields that have a layout."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName().removeprefix("facet=") for x in fs.listStatus(where) if x.getPath().getName().startswith("facet=")) if fs.exists(where) else []


def drop_layout(spark: SparkSession, path: str, field: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(layout_path(path, field))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop_orphans(spark: SparkSession, index: IndexSpec, path: str) -> list[str]:
    """Drop the layouts of fields that the index doesn't have any more; their names."""
    gone = [f for f in layouts(spark, path) if f not in index.facetable]
    for f in gone:
        drop_layout(spark, path, f)
    return gone
