"""The vector index: items dealt to the nearest of a few centroids, searched list by list, and ranked exactly.

An approximate query looks at the ``probes`` lists whose centroids are nearest to it, and computes the exact similarity of
all items in them. Centroids are fitted on a bounded sample of the rows, all rows are indexed, and the number of probes is
the least that finds TARGET of the true neighbours of sample queries in the sample.

An exact query (``within`` a threshold, ``nearest``) skips what can't reach it. Angles between unit vectors obey the
triangle inequality: a list whose members turn at most r from its centroid holds nothing within t of a query that is more than t + r
from the centroid; and of the other lists only those rows whose own turn differs from the query's by at most t.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions import vectors as V

#: Rows that centroids and probes are fitted on, about, and queries among them; the only bound, and it holds for fitting alone.
SAMPLE, SAMPLE_QUERIES = 20_000, 500
#: Share of true neighbours that the sample's queries must find.
TARGET = 0.97
#: Items of one list that a task compares at once; longer lists are cut into blocks.
BLOCK = 1 << 16
MOST_LISTS = 4096
#: A list is split once it holds so many times the mean of all lists, and at least so many items.
OUTGROWN, LEAST_SPLIT = 4, 1000
#: What is allowed for rounding where an angle is compared with a bound.
SLACK = 1e-7


@dataclass(frozen=True)
class VectorIndex:
    """items(list, id, vector, turn): unit vectors with their list and their angle from its centroid; centroids by rows;
    probes: lists that an approximate query looks at; spans: (least turn, most turn, items) of each list, None before it is
    written."""

    items: DataFrame
    centroids: np.ndarray
    probes: int
    spans: dict[int, tuple[float, float, int]] | None = None


def _units(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(usable, unit vectors of the usable rows): those of the right size, finite and not zero."""
    usable = np.array([v.is_valid and len(v) == size for v in column], bool) if len(column) else np.zeros(0, bool)
    rows = np.array([v.as_py() for v, ok in zip(column, usable) if ok], np.float64).reshape(-1, size)
    good = np.isfinite(rows).all(axis=1)
    good[good] &= np.abs(rows[good]).max(axis=1, initial=0) > 0
    usable[usable] = good
    rows = rows[good] / np.abs(rows[good]).max(axis=1, initial=0, keepdims=True)
    return usable, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _kmeans(rows: np.ndarray, lists: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), lists, replace=False)]
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    return centroids


def _enough_probes(rows: np.ndarray, centroids: np.ndarray, k: int, target: float) -> int:
    """The least number of lists in which queries of the sample find that share of their k nearest rows."""
    nearest = (rows @ centroids.T).argmax(axis=1)
    places = []
    for q in rows[:SAMPLE_QUERIES]:
        true = np.argsort(-(rows @ q), kind="stable")[1 : k + 1]
        rank = np.empty(len(centroids), int)
        rank[np.argsort(-(centroids @ q), kind="stable")] = np.arange(len(centroids))
        places.append(rank[nearest[true]])
    found = np.sort(np.concatenate(places)) if places else np.zeros(0, int)
    return int(found[min(len(found) - 1, int(np.ceil(target * len(found))) - 1)]) + 1 if len(found) else 1


def _fitted(rows: DataFrame, dimensions: int, lists: int | None, k: int, seed: int) -> tuple[np.ndarray, int]:
    """Centroids and probes, from a sample of rows(id, vector)."""
    total = rows.count()
    share = min(1.0, SAMPLE / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64("id", F.lit(seed + 1))).limit(2 * SAMPLE).toArrow()
    sample = _units(drawn["vector"].combine_chunks(), dimensions)[1] if drawn.num_rows else np.zeros((0, dimensions))
    lists = max(1, min(MOST_LISTS, lists or int(np.sqrt(total)), len(sample) // 8))
    centroids = _kmeans(sample, lists, seed) if len(sample) >= lists else np.eye(1, dimensions)
    return centroids, _enough_probes(sample, centroids, k, TARGET)


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(list, id, vector, turn) of rows(id, vector): usable vectors, as unit vectors, in the list of the nearest centroid."""
    dimensions = centroids.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            usable, units = _units(b.column(1), dimensions)
            scores = units @ shared.value.T if len(units) else np.zeros((0, 1))
            nearest = scores.argmax(axis=1).astype(np.int32)
            turn = np.arccos(np.clip(scores[np.arange(len(units)), nearest], -1, 1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(units) + 1) * dimensions, pa.int32()), pa.array(units.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(nearest), b.column(0).filter(pa.array(usable)), flat, pa.array(turn)], ["list", "id", "vector", "turn"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(place, f"list int, id {kind}, vector array<double>, turn double")


def build(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int, lists: int | None = None, k: int = 10, seed: int = 42) -> VectorIndex:
    """Index every usable vector: of that many dimensions, finite, not zero. Others are in no list."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    centroids, probes = _fitted(rows, dimensions, lists, k, seed)
    return VectorIndex(assigned(rows, centroids), centroids, probes)


def _spans(items: DataFrame) -> dict[int, tuple[float, float, int]]:
    """A row for each list, at most MOST_LISTS and what was split since."""
    found = items.groupBy("list").agg(F.min("turn").alias("least"), F.max("turn").alias("most"), F.count(F.lit(1)).alias("n")).collect()
    return {r.list: (r.least, r.most, r.n) for r in found}


def write_items(items: DataFrame, path: str) -> dict[int, tuple[float, float, int]]:
    """Write rows of an index; a list is a partition, which a search of few lists prunes to, sorted by turn. Its spans.

    Long lists are dealt to several tasks, so that none writes all of one.
    """
    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = items.repartition("list", F.pmod(F.floor(F.col("turn") * 1e6), F.lit(parts))).sortWithinPartitions("list", "turn")
    dealt.write.mode("overwrite").partitionBy("list").parquet(path)
    schema = f"id {items.schema['id'].dataType.simpleString()}, vector array<double>, turn double, list int"
    return _spans(items.sparkSession.read.schema(schema).parquet(path))


def read_items(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(f"id {kind}, vector array<double>, turn double, list int").parquet(path)


def write(built: VectorIndex, path: str) -> None:
    """Write an index to a folder, in place of what is there."""
    spans = write_items(built.items, f"{path}/items")
    about = json.dumps({"probes": built.probes, "centroids": built.centroids.tolist(), "spans": list(spans.items()), "kind": built.items.schema["id"].dataType.simpleString()})
    built.items.sparkSession.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def read(spark: SparkSession, path: str) -> VectorIndex:
    about = json.loads(spark.read.text(f"{path}/about").first().value)
    return VectorIndex(read_items(spark, f"{path}/items", about["kind"]), np.array(about["centroids"]), about["probes"], {k: tuple(v) for k, v in about["spans"]})


def outgrown(spans: dict[int, tuple[float, float, int]]) -> list[int]:
    """Lists that hold far more than the mean."""
    mean = sum(n for *_, n in spans.values()) / max(1, len(spans))
    return sorted(k for k, (*_, n) in spans.items() if n >= LEAST_SPLIT and n > OUTGROWN * mean)


def split(built: VectorIndex, lists: list[int], k: int = 10, seed: int = 42) -> VectorIndex:
    """The index with each of these lists split in two to OUTGROWN parts, fitted on samples of them; recall is measured again.

    A part takes the place of its list, the others are new lists at the end. Rows go to the nearest centroid of their own list's parts, so
    other lists stay as they are written.
    """
    centroids = built.centroids
    parts: dict[int, list[int]] = {}
    rng = np.random.default_rng(seed)
    for at in lists:
        own = built.items.where(F.col("list") == at)
        share = min(1.0, SAMPLE / max(1, (built.spans or {}).get(at, (0, 0, 1))[2]))
        sample = own.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)).select("vector").limit(2 * SAMPLE).toArrow()
        x = _units(sample["vector"].combine_chunks(), centroids.shape[1])[1] if sample.num_rows else np.zeros((0, centroids.shape[1]))
        if len(x) < 2 * OUTGROWN:
            continue
        fresh = _kmeans(x, OUTGROWN, int(rng.integers(1 << 30)))
        parts[at] = [at, *range(len(centroids), len(centroids) + OUTGROWN - 1)]
        centroids = np.concatenate([centroids, fresh[1:]])
        centroids[at] = fresh[0]
    if not parts:
        return built
    shared = built.items.sparkSession.sparkContext.broadcast((centroids, parts))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, of = shared.value
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(-1, every.shape[1])
            old = b.column(0).to_numpy()
            new, turn = old.copy(), b.column(3).to_numpy().copy()
            for k, choices in of.items():
                mine = np.nonzero(old == k)[0]
                if len(mine):
                    scores = x[mine] @ every[choices].T
                    best = scores.argmax(axis=1)
                    new[mine], turn[mine] = np.array(choices)[best], np.arccos(np.clip(scores[np.arange(len(mine)), best], -1, 1))
            yield pa.RecordBatch.from_arrays([pa.array(new), b.column(1), b.column(2), pa.array(turn)], ["list", "id", "vector", "turn"])

    kind = built.items.schema["id"].dataType.simpleString()
    items = built.items.select("list", "id", "vector", "turn").mapInArrow(again, f"list int, id {kind}, vector array<double>, turn double")
    return replace(built, items=items, centroids=centroids, spans=None)


def enough_probes(built: VectorIndex, k: int = 10, seed: int = 42) -> int:
    """Lists that an approximate query must look at, measured again on a sample of the items."""
    total = sum(n for *_, n in (built.spans or {}).values()) or built.items.count()
    share = min(1.0, SAMPLE / max(1, total))
    drawn = built.items.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.xxhash64("id", F.lit(seed + 1))).select("vector").limit(2 * SAMPLE).toArrow()
    sample = _units(drawn["vector"].combine_chunks(), built.centroids.shape[1])[1] if drawn.num_rows else np.zeros((0, built.centroids.shape[1]))
    return _enough_probes(sample, built.centroids, k, TARGET)


def _query(built: VectorIndex, vector: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray] | None:
    """The query as a unit vector, and its angles from all centroids; None if it can't be compared."""
    q = np.asarray(vector, np.float64)
    if len(q) != built.centroids.shape[1] or not np.isfinite(q).all() or not q.any():
        return None
    q = q / np.abs(q).max()
    q = q / np.linalg.norm(q)
    return q, np.arccos(np.clip(built.centroids @ q, -1, 1))


def _reachable(built: VectorIndex, angles: np.ndarray, most: float) -> dict[int, tuple[float, float]]:
    """The lists that may hold something within an angle of the query, with the turns it may have there."""
    out = {}
    for k, (least, furthest, _) in (built.spans if built.spans is not None else _spans(built.items)).items():
        low, high = angles[k] - most - SLACK, angles[k] + most + SLACK
        if low <= furthest and high >= least:
            out[k] = (low, high)
    return out


def _rows(built: VectorIndex, lists: dict[int, tuple[float, float]]) -> DataFrame:
    """The rows of these lists in these ranges of turns; lists prune partitions, turns prune pages."""
    if not lists:
        return built.items.where(F.lit(False))
    inside = F.coalesce(*(F.when(F.col("list") == k, F.col("turn").between(low, high)) for k, (low, high) in lists.items()))
    low, high = min(x for x, _ in lists.values()), max(x for _, x in lists.values())
    return built.items.where(F.col("list").isin(list(lists)) & F.col("turn").between(low, high) & inside)


def within(built: VectorIndex, vector: tuple[float, ...], threshold: float) -> DataFrame:
    """(id, similarity) of every item whose cosine with the vector is at least the threshold; exact, and lazy.

    Lists and rows that can't reach the threshold by their angles are never read. A vector that is zero, not finite, or of
    another size finds nothing.
    """
    asked = _query(built, vector)
    if asked is None:
        return built.items.where(F.lit(False)).select("id", F.lit(0.0).alias("similarity"))
    q, angles = asked
    rows = _rows(built, _reachable(built, angles, math.acos(max(-1.0, min(1.0, threshold)))))
    return rows.select("id", V.dot(F.col("vector"), V.literal(q.tolist())).alias("similarity")).where(F.col("similarity") >= threshold)


def nearest(built: VectorIndex, vector: tuple[float, ...], k: int, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(id, similarity) of the k most similar items, ties by id; exact. ``keep`` narrows (id, similarity) to items that count.

    Lists are looked at by the highest similarity that they can hold. Once the k-th found is above that of all other
    lists, these can't matter; the lists looked at grow by the power of two until then, so few jobs are needed.
    """
    asked = _query(built, vector)
    spans = built.spans if built.spans is not None else _spans(built.items)
    if asked is None or not spans or k <= 0:
        return built.items.where(F.lit(False)).select("id", F.lit(0.0).alias("similarity"))
    q, angles = asked
    bound = {n: math.cos(max(0.0, angles[n] - most - SLACK, least - SLACK - angles[n])) for n, (least, most, _) in spans.items()}
    order = sorted(spans, key=lambda n: (-bound[n], n))
    cosine: Column = V.dot(F.col("vector"), V.literal(q.tolist()))
    looked, need = 0, k
    while True:
        held = sum(spans[n][2] for n in order[:looked])
        while looked < len(order) and (looked == 0 or held < need):
            held += spans[order[looked]][2]
            looked += 1
        found = built.items.where(F.col("list").isin(order[:looked])).select("id", cosine.alias("similarity"))
        best = (keep(found) if keep else found).orderBy(F.desc("similarity"), F.asc("id")).limit(k)
        if looked == len(order):
            return best
        got = best.agg(F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least")).first()
        if got.n == k:
            reach = _reachable(built, angles, math.acos(max(-1.0, min(1.0, got.least))))
            if set(reach) <= set(order[:looked]):
                return best
            rows = _rows(built, reach).select("id", cosine.alias("similarity")).where(F.col("similarity") >= got.least)
            return (keep(rows) if keep else rows).orderBy(F.desc("similarity"), F.asc("id")).limit(k)
        need = max(2 * held, need)


def near(built: VectorIndex, vector: tuple[float, ...]) -> DataFrame:
    """(list, id, vector) of the lists that one query vector looks at; the scan is pruned to them."""
    q = np.asarray(vector, np.float64)
    lists = np.argsort(-(built.centroids @ q), kind="stable")[: built.probes]
    return built.items.where(F.col("list").isin([int(x) for x in lists]))


def search(built: VectorIndex, queries: DataFrame, id_col: str, vector_col: str, k: int = 10) -> DataFrame:
    """(query_id, id, similarity): the k nearest items of each query, without the query's own id; ties by id.

    Queries are sent to their lists, not lists to queries. A long list is cut into blocks, and each block returns the k
    best of each of its queries, so nothing but winners is shuffled. Unusable query vectors find nothing.
    """
    size, probes = built.centroids.shape[1], built.probes
    shared = queries.sparkSession.sparkContext.broadcast(built.centroids)
    kind = built.items.schema["id"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            usable, units = _units(b.column(1), size)
            lists = np.argsort(-(units @ shared.value.T), axis=1, kind="stable")[:, :probes]
            row = np.repeat(np.arange(len(units)), lists.shape[1])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * size, pa.int32()), pa.array(units[row].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(lists.ravel().astype(np.int32)), b.column(0).filter(pa.array(usable)).take(pa.array(row)), flat], ["list", "query_id", "q"])

    asked = queries.select(F.col(id_col).cast(kind).alias("query_id"), F.col(vector_col).cast("array<double>").alias("q")).mapInArrow(route, f"list int, query_id {kind}, q array<double>")
    lengths = lambda a, b: F.broadcast(built.items.groupBy(F.col("list").alias(a)).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(b)))  # noqa: E731  a row for each list
    asked = asked.join(lengths("of_q", "blocks_q"), F.col("list") == F.col("of_q")).select("list", "query_id", "q", F.explode(F.sequence(F.lit(0), F.col("blocks_q") - 1)).alias("block"))
    items = built.items.join(lengths("of_i", "blocks_i"), F.col("list") == F.col("of_i")).select("list", "id", "vector", F.pmod(F.xxhash64("id"), F.col("blocks_i")).cast("int").alias("block"))

    def best(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": mine["query_id"].slice(0, 0), "id": mine["query_id"].slice(0, 0), "similarity": pa.array([], pa.float64())})
        if not mine.num_rows or not theirs.num_rows:
            return empty
        x, y = (np.concatenate([c.flatten().to_numpy() for c in t[n].chunks]).reshape(-1, size) for t, n in ((mine, "q"), (theirs, "vector")))
        ids, wanted, out = theirs["id"].combine_chunks(), mine["query_id"].combine_chunks(), []
        place = np.argsort(np.array(ids.to_pylist()), kind="stable")
        y, ids = y[place], ids.take(pa.array(place))
        for at in range(0, len(x), 256):
            scores = x[at : at + 256] @ y.T
            keep = min(k + 1, scores.shape[1])  # one more, as the query itself may be among them
            top = np.argsort(-scores, axis=1, kind="stable")[:, :keep] if keep == scores.shape[1] else np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            row = np.repeat(np.arange(len(scores)), keep)
            out.append(pa.table({"query_id": wanted.slice(at, len(scores)).take(pa.array(row)), "id": ids.take(pa.array(top.ravel())), "similarity": pa.array(scores[row, top.ravel()])}))
        return pa.concat_tables(out)

    pairs = asked.groupBy("list", "block").cogroup(items.groupBy("list", "block")).applyInArrow(best, f"query_id {kind}, id {kind}, similarity double").where("id <> query_id")
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "id"))), 1, k)
    return pairs.groupBy("query_id").agg(ranked.alias("best")).select("query_id", F.explode("best").alias("x")).select("query_id", F.col("x.id").alias("id"), (-F.col("x.s")).alias("similarity"))
