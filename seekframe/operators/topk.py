"""Ranked search that stops early: high term frequencies first, until nothing that is left can reach the page.

Postings are sorted by level, the bits of tf, so those of a high level are few pages of a token. From the levels read so
far each item has a least and a most score; an item not seen at all is below a bound. Once enough items are certainly
above all others, the rest is not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions import text as TX
from seekframe.operators import textindex as X
from seekframe.operators.predicates import compile_group, fields_of
from seekframe.operators.search import SCORE, Items, order, page, search
from seekframe.plans import keys as K
from seekframe.plans.model import IndexSpec
from seekframe.plans.query import Query, Sort

#: Postings of a query's tokens up to which all are simply read.
FEW = 100_000
#: Items that are looked up by id, to complete their scores; and the longest page that stops early.
LOOKUPS, MOST = 1000, 1000
EPSILON = 1e-12


def _terms(node: K.Node | None) -> bool:
    return node is not None and all(isinstance(leaf, K.Term) for leaf in K.leaves(node))


def _grouped(rows: DataFrame, leaves: list[K.Node], fields: list[str]) -> DataFrame:
    """(id, tf of every leaf and field, null where none was read)."""
    return rows.groupBy("id").agg(*(F.max(F.when((F.col("token") == leaf.token) & (F.col("field") == f), F.col("tf"))).alias(f"{n} {f}") for n, leaf in enumerate(leaves) for f in fields))


def ranked(items: Items, index: IndexSpec, query: Query) -> DataFrame:
    """The rows of ``search`` for a query by keywords in order of relevance with a limit; with jobs of its own beforehand.

    Other queries (phrases, prefixes, vectors, other orders), and tokens with few postings, are left to ``search``.
    """
    node = K.parse(query.keys)
    plain = query.sorts in ((), (Sort("relevance", "DESC"),)) and query.vector is None and query.rank == "tf" and query.limit is not None
    if not plain or not _terms(node) or query.config not in items.text or query.limit + query.offset > MOST or not query.limit:
        return search(items, index, query).rows
    built = items.text[query.config]
    node = X.stemmed(node, query.config, query.languages)
    leaves, fields, k = K.leaves(node), index.searchable, query.limit + query.offset
    tokens = sorted({leaf.token for leaf in leaves})
    mine = built.postings.where(F.col("token").isin(tokens)).select("token", "id", "field", "tf", "level")
    counts = {r.level: r.n for r in mine.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(counts.values()) <= FEW:
        return search(items, index, query).rows

    condition = compile_group(index, query.where)
    allowed = None
    if condition is not None or query.languages is not None:
        rows = items.attach(items.base, fields_of(query.where), index.id_col)
        rows = rows if condition is None else rows.where(condition)
        rows = rows if query.languages is None else rows.where(F.col(index.language_col).isin(*query.languages))
        allowed = rows.select(F.col(index.id_col).alias("id"))
    weights = {f: TX.WEIGHTS[index.field(f).weight] for f in fields}
    cells = [(f"{n} {f}", f) for n in range(len(leaves)) for f in fields]
    part = lambda tf, f: F.lit(weights[f]) * (tf.cast("double") / (tf + 1))
    total = lambda parts: reduce(lambda a, b: a + b, parts) / len(leaves)
    least = total([F.coalesce(part(F.col(f"`{c}`"), f), F.lit(0.0)) for c, f in cells])

    def holds(at: K.Node) -> Column:
        if isinstance(at, (K.And, K.Or)):
            return reduce((lambda a, b: a & b) if isinstance(at, K.And) else (lambda a, b: a | b), map(holds, at.members))
        n = next(n for n, leaf in enumerate(leaves) if leaf is at)
        return reduce(lambda a, b: a | b, [F.col(f"`{n} {f}`").isNotNull() for f in fields])

    def finished(scored: DataFrame) -> DataFrame:
        """The page: names and fields of the best items."""
        best = scored.select(F.col("id").alias(index.id_col), F.col("lo").alias(SCORE)).orderBy(F.desc(SCORE), F.asc(index.id_col)).limit(k)
        shown = list(query.fields) or [f.name for f in index.fields if f.kind != "vector"]
        rows = items.attach(items.base.join(best, index.id_col), shown, index.id_col)
        return page(rows.select(*index.system, *shown, SCORE), order((Sort("relevance", "DESC"),), index), query.limit, query.offset)

    seen = 0
    for level in sorted(counts, reverse=True):
        seen += counts[level]
        if seen < k and level > min(counts):
            continue
        below = (1 << (level - 1)) - 1  # the most that a tf can be which wasn't read
        top = {f: weights[f] * below / (below + 1) for f in fields}
        bound = sum(top[f] for _, f in cells) / len(leaves)
        rows = _grouped(mine.where(F.col("level") >= level), leaves, fields)
        rows = rows if allowed is None else rows.join(allowed, "id", "left_semi")
        most = total([F.coalesce(part(F.col(f"`{c}`"), f), F.lit(top[f])) for c, f in cells])
        whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c, _ in cells])
        if level == min(counts):
            return finished(rows.where(holds(node)).select("id", least.alias("lo")))
        rows = rows.select("*", least.alias("lo"), most.alias("hi"), holds(node).alias("sure"), whole.alias("whole"))
        state = rows.where("sure").orderBy(F.desc("lo"), F.asc("id")).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("least")).first()
        if state.n < k or bound >= state.least - EPSILON:
            continue
        maybe = rows.where(F.col("hi") >= state.least - EPSILON)
        open_ = [r.id for r in maybe.where("not whole").select("id").limit(LOOKUPS + 1).collect()]
        if len(open_) > LOOKUPS:
            continue
        sure = maybe.where("whole").select("id", "lo", "sure")
        if open_:  # their other frequencies are lower than what was read: a few pages hold their ids
            looked = _grouped(mine.where(F.col("id").isin(open_)), leaves, fields)
            sure = sure.unionByName(looked.select("id", least.alias("lo"), holds(node).alias("sure")))
        return finished(sure.where("sure"))
    return search(items, index, query).rows
