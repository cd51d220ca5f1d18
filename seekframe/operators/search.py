"""Search: a query object to lazy DataFrames of rows, count and facets over one shared filtered frame."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions import text as TX
from seekframe.functions import vectors as V
from seekframe.functions.stem import stems
from seekframe.operators import facets as FC
from seekframe.operators import gramindex as G
from seekframe.operators import textindex as X
from seekframe.operators import vectorindex as VI
from seekframe.operators.predicates import compile_group, fields_of
from seekframe.plans import keys as K
from seekframe.plans.model import IndexSpec, SpecError
from seekframe.plans.query import Group, Query, Sort

SCORE, TEXT_SCORE, VECTOR_SCORE = "score", "text_score", "vector_score"
LEAST = 0.001


@dataclass(frozen=True)
class SearchResult:
    """Everything is lazy: nothing runs before an action on one of these."""

    rows: DataFrame
    count: DataFrame | None
    facets: dict[str, DataFrame] = field(default_factory=dict)
    degradation: dict | None = None


def order(sorts: tuple[Sort, ...], index: IndexSpec, relevance: str = SCORE) -> list[Column]:
    """Sort columns with explicit null order; the id comes last, so that pages are the same each time."""
    out = []
    for s in sorts:
        if s.field == "relevance":
            name = relevance
        elif s.field in ("id", index.id_col):
            name = index.id_col
        elif s.field in index.system or s.field in index.sortable:
            name = s.field
        else:
            raise SpecError(f"can't sort by {s.field!r}")
        out.append(F.col(name).desc_nulls_first() if s.descending else F.col(name).asc_nulls_last())
    return [*out, F.col(index.id_col).asc()]


def page(df: DataFrame, columns: list[Column], limit: int | None, offset: int) -> DataFrame:
    """Sorted and cut to a page: a top-k where there is a limit. The offset counts only with one."""
    df = df.orderBy(*columns)
    if limit is None:
        return df
    return (df.offset(offset) if offset else df).limit(limit)


def hybrid_score(text: Column, vector: Column, has_vector: Column, has_text: Column, text_weight: float, vector_weight: float) -> Column:
    """Each side that a row has counts at least a little; a row with neither gets that little."""
    t, v = F.greatest(F.lit(text_weight) * text, F.lit(LEAST)), F.greatest(F.lit(vector_weight) * vector, F.lit(LEAST))
    return F.when(has_vector & has_text, t + v).when(has_vector, v).when(has_text, t).otherwise(LEAST)


@dataclass(frozen=True)
class Items:
    """A table of items as search sees it.

    sides: tables (id, fields) of fields that lie elsewhere; each is joined only if a query names one of its fields, and
    only to the rows of the page if it is merely shown. text: the text indexes, by configuration; without the one that a
    query asks for, texts are tokenised as they are read. vectors: the vector indexes, by column; without the one that a
    query asks for, similarities of all rows are computed. grams: trigram indexes, by field: what conditions on parts of
    texts need is looked up there, and only candidates are compared. bitmaps: of facet fields, which are counted from them and the
    found ids alone.
    """

    base: DataFrame
    sides: tuple[DataFrame, ...] = ()
    text: Mapping[str, X.TextIndex] = field(default_factory=dict)
    vectors: Mapping[str, VI.VectorIndex] = field(default_factory=dict)
    grams: Mapping[str, G.GramIndex] = field(default_factory=dict)
    bitmaps: Mapping[str, DataFrame] = field(default_factory=dict)

    def attach(self, df: DataFrame, names: Collection[str], id_col: str) -> DataFrame:
        """df with the sides that have fields of these names, and which it doesn't have yet."""
        for side in self.sides:
            if any(n in side.columns and n not in df.columns for n in names):
                df = df.join(side, id_col, "left")
        return df

    def lacks(self, names: Collection[str]) -> list[str]:
        return [n for n in names if n not in self.base.columns]


def _matched(items: DataFrame, source: Items, index: IndexSpec, query: Query, node: K.Node, inner: bool) -> DataFrame:
    """items with text_rank, null where the keys don't match; only matching ones if ``inner``."""
    if not index.searchable:
        raise SpecError(f"{index.name} has no searchable field")
    node = X.stemmed(node, query.config, query.languages)
    constant = query.rank == "constant"
    if query.config in source.text:
        found = X.find(source.text[query.config], index, node, constant=constant)
        return items.join(found.withColumnRenamed("id", index.id_col), index.id_col, "inner" if inner else "left")
    if query.config not in ("simple", "english"):
        raise SpecError(f"the configuration {query.config!r} needs a text index")
    made = []
    for n in index.searchable:
        toks = TX.tokens(F.array_join(F.col(n), " ") if index.field(n).multi_value else F.col(n))
        made.append((stems(toks) if query.config == "english" else toks).alias(n))
    # an explode of one element is a barrier: texts are split once, not once for each mention of their tokens
    items = items.withColumn("_tokens", F.explode(F.array(F.struct(*made))))
    each = [(F.col(f"_tokens.{n}"), TX.WEIGHTS[index.field(n).weight]) for n in index.searchable]
    items = items.withColumn("text_rank", F.when(TX.matches_any([c for c, _ in each], node), F.lit(1.0) if constant else TX.rank(each, node))).drop("_tokens")
    return items.where("text_rank is not null") if inner else items


def _by_indexes(items: DataFrame, source: Items, index: IndexSpec, query: Query, mode: str, node: K.Node | None) -> tuple[DataFrame, bool]:
    """The vector side from its index: items near enough come from the lists that can hold them. In a hybrid search the
    similarity of others is computed only for those that the keys match."""
    vector = query.vector
    built = source.vectors[vector.column]
    near = VI.within(built, vector.vector, vector.threshold).select(F.col("id").alias(index.id_col), F.col("similarity").alias("_similarity"))
    if mode == "vector_only":
        return items.join(near, index.id_col).withColumn(SCORE, F.col("_similarity")), True
    match = _matched(items.select(*(c for c in items.columns if c == index.id_col or c in index.searchable)), source, index, query, node, True) if query.config not in source.text else None
    if match is None:
        match = X.find(source.text[query.config], index, X.stemmed(node, query.config, query.languages), constant=query.rank == "constant").withColumnRenamed("id", index.id_col)
    match = match.select(index.id_col, "text_rank")
    # of items that only the keys match, the vectors are looked up by id
    rest = match.join(near.select(index.id_col), index.id_col, "left_anti")
    unit = V.normalise(V.literal(vector.vector))
    looked_up = rest.join(built.items.select(F.col("id").alias(index.id_col), "vector"), index.id_col, "left")
    looked_up = looked_up.select(index.id_col, "text_rank", V.dot(F.col("vector"), unit).alias("_similarity"))
    both = near.join(match, index.id_col, "left").select(index.id_col, "text_rank", "_similarity").unionByName(looked_up)
    found = items.join(both, index.id_col).withColumns({TEXT_SCORE: F.coalesce("text_rank", F.lit(0.0)), VECTOR_SCORE: F.coalesce("_similarity", F.lit(0.0))})
    if not vector.guarded:
        return found.withColumn(SCORE, F.lit(vector.text_weight) * F.col(TEXT_SCORE) + F.lit(vector.vector_weight) * F.col("_similarity")), True
    score = hybrid_score(F.col(TEXT_SCORE), F.col(VECTOR_SCORE), F.col("_similarity").isNotNull(), F.col("text_rank").isNotNull(), vector.text_weight, vector.vector_weight)
    return found.withColumn(SCORE, score), True


def _scored(items: DataFrame, source: Items, index: IndexSpec, query: Query) -> tuple[DataFrame, bool, dict | None]:
    """The items that the keys and vector ask for, with scores; whether they ask for anything; and why the mode was lowered, if it was."""
    node = K.parse(query.keys)
    vector, mode, lowered = query.vector, query.mode, None
    if mode == "vector_only" and vector is None:
        lowered = {"degraded": True, "reason": "no query vector", "strategy": "text_only", "message": "searched by text alone"}
        mode = "text_only"
    elif vector is None or node is None and mode == "hybrid":
        mode = "text_only" if vector is None else "vector_only"

    if mode == "text_only":
        if node is None:
            return items.withColumn(SCORE, F.lit(1.0)), False, lowered
        return _matched(items, source, index, query, node, True).withColumn(SCORE, F.col("text_rank")), True, lowered
    if vector.column in source.vectors:
        return *_by_indexes(items, source, index, query, mode, node), lowered
    # the similarity is computed once per row, and is null without a vector, or with a zero one
    items = items.withColumn("_similarity", V.cosine(F.col(vector.column), V.literal(vector.vector)))
    near = F.coalesce(F.col("_similarity") >= vector.threshold, F.lit(False))
    if mode == "vector_only":
        return items.withColumn(SCORE, F.col("_similarity")).where(near), True, lowered
    items = _matched(items, source, index, query, node, False)
    match = F.col("text_rank").isNotNull()
    items = items.where(match | near).withColumns({TEXT_SCORE: F.coalesce("text_rank", F.lit(0.0)), VECTOR_SCORE: F.coalesce("_similarity", F.lit(0.0))})
    if not vector.guarded:
        return items.withColumn(SCORE, F.lit(vector.text_weight) * F.col(TEXT_SCORE) + F.lit(vector.vector_weight) * F.col("_similarity")), True, lowered
    score = hybrid_score(F.col(TEXT_SCORE), F.col(VECTOR_SCORE), F.col("_similarity").isNotNull(), match, vector.text_weight, vector.vector_weight)
    return items.withColumn(SCORE, score), True, lowered


def search(items: DataFrame | Items, index: IndexSpec, query: Query) -> SearchResult:
    """Run a query over a table of items. All errors of the query itself are raised here, before any job."""
    source = items if isinstance(items, Items) else Items(items)
    where = Group((query.where, FC.filters(index, query.facet_filters)))
    fields = list(query.fields) or [f.name for f in index.fields if f.kind != "vector"]
    for name in [*fields, *(f.field for f in query.facets)]:
        index.field(name)
    named = {*fields_of(where), *(s.field for s in query.sorts), *([query.vector.column] if query.vector and query.mode != "text_only" and query.vector.column not in source.vectors else [])}
    base = source.base
    # a facet ignores conditions on its own field and its forms, so these mustn't narrow the items
    free = {n for n in source.grams for f in query.facets if n == f.field or f.related and FC.related(n, f.field)}
    maybe = G.candidates(where, {n: g for n, g in source.grams.items() if n not in free}) if source.grams else None
    if maybe is not None:
        base = base.join(maybe.withColumnRenamed("id", index.id_col), index.id_col, "left_semi")
    scored, asked, lowered = _scored(source.attach(base, named, index.id_col), source, index, query)

    def filtered(without: frozenset[str] = frozenset()) -> DataFrame:
        condition = compile_group(index, where, without)
        out = scored if condition is None else scored.where(condition)
        return out if query.languages is None else out.where(F.col(index.language_col).isin(*query.languages))

    rows = filtered()
    sorts = query.sorts or ((Sort("relevance", "DESC"),) if asked else ())
    ordering = order(sorts, index)
    scores = [SCORE] + [c for c in (TEXT_SCORE, VECTOR_SCORE) if c in scored.columns]
    late = [n for n in source.lacks(fields) if n not in rows.columns]
    limit = query.limit
    if query.vector and query.vector.max_results is not None and query.mode != "text_only":
        limit = query.vector.max_results if limit is None else min(limit, query.vector.max_results)
    if late and limit is None:
        rows_shown, late = source.attach(rows, fields, index.id_col), []
    else:
        rows_shown = rows
    kept = rows_shown.select(*dict.fromkeys([*index.system, *(n for n in fields if n not in late), *scores, *(s.field for s in sorts if s.field in index.sortable)]))
    shown = page(kept, ordering, limit, query.offset)
    if late:  # what is only shown is joined to the page, which is in order again after that
        shown = source.attach(shown, late, index.id_col).orderBy(*ordering)
    shown = shown.select(*index.system, *fields, *scores)
    # a facet ignores conditions on its own field and its forms; those without any share the filtered frame
    counts = {}
    for f in query.facets:
        without = frozenset(n for n in fields_of(where) if n == f.field or f.related and FC.related(n, f.field))
        own = filtered(without) if without else rows
        if f.field in source.bitmaps:
            counts[f.field] = FC.labelled_from_bitmaps(own, index.id_col, source.bitmaps[f.field], index.field(f.field), f)
        else:
            counts[f.field] = FC.labelled(source.attach(own, (f.field,), index.id_col), index.field(f.field), f)
    count = None if query.skip_count else rows.agg(F.count(F.lit(1)).alias("result_count"))
    return SearchResult(shown, count, counts, lowered)
