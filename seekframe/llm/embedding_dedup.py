"""Near-duplicate embeddings by PCA-ordered, tiled comparison."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, settle, small
from seekframe.llm.components import Forest, components

#: Bytes of vectors in one block, about; a task holds two blocks.
BLOCK_BYTES = 16 << 20
#: Vectors of one tile; blocks are compared tile by tile.
TILE = 1024
#: Dimensions that are accumulated before each look at the bound.
STEP = 16


def _valid(vector: str) -> str:
    """SQL: not null, not empty, only finite components, not zero."""
    return f"{vector} is not null and size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists({vector}, x -> x <> 0)"


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component is taken out first, so no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def principal_axes(rows: np.ndarray) -> np.ndarray:
    """Orthonormal columns by falling second moment of the rows."""
    _, axes = np.linalg.eigh(rows.T @ rows)
    return axes[:, ::-1].copy()


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """For each row and dimension, the norm of the row from that dimension on."""
    return np.sqrt(np.maximum(0, np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]))


def close_pairs(a: np.ndarray, b: np.ndarray, tail_a: np.ndarray, tail_b: np.ndarray, threshold: float, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, sure): rows of a and b (unit vectors along the axes) whose product may reach the threshold; sure: it does.

    Leading dimensions come first. What the rest can add is at most the product of the two suffix norms, which stand as
    one more dimension behind them, so one product of matrices gives the bound of a whole tile. Pairs below the
    threshold stop there. While many are left, rows and columns that no pair can save are left out and ``step`` more
    dimensions join; few are left to the exact comparison. Single precision is enough for a bound with room for its error.
    """
    rows, cols, size = np.arange(len(a)), np.arange(len(b)), a.shape[1]
    for lead in [*range(step, size, step), size]:
        x, y = (np.zeros((len(pick), lead + 1), np.float32) for pick in (rows, cols))
        for z, source, tail, pick in ((x, a, tail_a, rows), (y, b, tail_b, cols)):
            z[:, :lead] = source[pick, :lead]
            if lead < size:
                z[:, lead] = tail[pick, lead]
        bound, room = x @ y.T, (lead + 4) * 2.0**-22
        may = bound >= threshold - room
        left = np.count_nonzero(may)
        if lead == size or 16 * left <= may.size:
            i, j = np.nonzero(may)
            sure = bound[i, j] >= threshold + room if lead == size else np.zeros(left, bool)
            return rows[i], cols[j], sure
        rows, cols = rows[may.any(axis=1)], cols[may.any(axis=0)]
    raise AssertionError


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links i, j connect it with."""
    low = np.arange(n)
    while True:
        new = low.copy()
        least = np.minimum(low[i], low[j])
        np.minimum.at(new, low[i], least)
        np.minimum.at(new, low[j], least)
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def compare(x: np.ndarray, y: np.ndarray | None, threshold: float, tile: int = TILE):
    """(i, j) of linked rows of x and y, or of x and itself if y is None, tile by tile; i and j are numbers of rows of x, then y.

    The vectors are turned onto their principal axes and sorted by the first coordinate. Tiles whose first coordinates
    are farther apart than linked vectors can be don't meet; the others accumulate leading dimensions first. The
    cosine of the vectors as they were given decides.
    """
    both = x if y is None else np.concatenate([x, y])
    turned = both @ principal_axes(both)
    tails = suffix_norms(turned)
    # |x - y|^2 = 2 - 2 cos, and no coordinate differs by more than |x - y|
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    sides = []
    for begin, end in [(0, len(x)), (len(x), len(both))] if y is not None else [(0, len(x))]:
        order = begin + np.argsort(turned[begin:end, 0], kind="stable")
        sides.append([order[k : k + tile] for k in range(0, len(order), tile)])
    for n, p in enumerate(sides[0]):
        for m, q in enumerate(sides[-1]):
            if y is None and m < n or turned[q[0], 0] - turned[p[-1], 0] > reach or turned[p[0], 0] - turned[q[-1], 0] > reach:
                continue
            i, j, sure = close_pairs(turned[p], turned[q], tails[p], tails[q], threshold)
            if y is None and m == n:
                once = i < j
                i, j, sure = i[once], j[once], sure[once]
            i, j = p[i], q[j]
            open_ = np.nonzero(~sure)[0]
            for k in range(0, len(open_), 1 << 16):
                some = open_[k : k + (1 << 16)]
                sure[some] = np.einsum("ij,ij->i", both[i[some]], both[j[some]]) >= threshold
            if sure.any():
                yield i[sure], j[sure]


def link(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors.

    Rows link if their labels are equal and not null and the cosine of their vectors is at least threshold, in double
    precision. Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, nor do
    rows with a null id, and vectors of different sizes don't link. n_links counts other rows; component_id is the
    smallest id reachable, itself included; kept: vec_id = component_id. Repeated rows count each other. Other columns
    are ignored. Empty table: no rows.

    Equal vectors are one class with a count. The classes of a label are dealt by a hash into blocks of block_bytes,
    which meet two by two, one task each; so a label with a third of all rows fills many tasks, and a vector is sent as
    often as its label has blocks. Within a task tiles are compared along the principal axes of its own vectors. A
    task returns link counts and a spanning forest, never its pairs.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    given = vectors.schema[vector_col].dataType
    kind = given.elementType.simpleString() if getattr(given, "elementType", None) is not None else "double"
    kind = "float" if kind == "float" else "double"  # single precision is sent as such, and compared in double
    v = F.col(vector_col).cast(f"array<{kind}>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    usable = F.expr(f"vec_id is not null and label is not null and ({_valid('v')})")
    # two 64-bit hashes name a class: equal labels and equal vectors
    key = [F.when(usable, F.xxhash64("label", "v")).alias("a"), F.when(usable, F.xxhash64(F.lit("second"), "label", "v")).alias("b")]
    classes = rows.where(usable).select("vec_id", "label", "v", *key).groupBy("a", "b").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes, _ = settle(classes, "embedding-classes")

    load = classes.groupBy("label", F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") * F.col("size") * 8 / block_bytes).cast("int")
    load = small(load.where("n > 1").select(fresh("label", "string").alias("_label"), F.col("size").alias("_size"), blocks.alias("blocks")), "embedding-blocks")
    met = classes.withColumn("size", F.size("v")).join(load, (F.col("label") == F.col("_label")) & (F.col("size") == F.col("_size")))
    own = F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int")
    met = met.select("label", "size", "rep", "n", "v", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("label", "size", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "n", "v")

    def task(group: pa.Table) -> pa.Table:
        size, i, j = (group.column(c)[0].as_py() for c in ("size", "i", "j"))
        own, rep, n = (group.column(c).to_numpy() for c in ("own", "rep", "n"))
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in group.column("v").chunks]).reshape(-1, size)
        order = np.argsort(own, kind="stable")
        rep, n, given = rep[order], n[order], unit(flat[order].astype(np.float64))
        first = len(given) if i == j else int((own == i).sum())
        found, forest = np.zeros(len(given), np.int64), Forest()
        for a, b in compare(given[:first], None if i == j else given[first:], threshold, tile) if first else ():
            found += (np.bincount(a, n[b], len(given)) + np.bincount(b, n[a], len(given))).astype(np.int64)
            ends, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            roots = spanning(len(ends), at[: len(a)], at[len(a) :])
            for x, y in zip(rep[ends].tolist(), rep[ends[roots]].tolist()):
                forest.union(x, y)
        used = np.nonzero(found)[0]
        return pa.table({"rep": pa.array(rep[used], pa.int64()), "links": pa.array(found[used], pa.int64()), "root": pa.array([forest.find(x) for x in rep[used].tolist()], pa.int64())})

    found, _ = settle(met.groupBy("label", "size", "i", "j").applyInArrow(task, "rep long, links long, root long"), "embedding-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")), "embedding-components")
    known = classes.select("a", "b", "rep", "n").join(counts.select(fresh("rep").alias("rep_c"), "links"), F.col("rep") == F.col("rep_c"), "left")
    known = known.join(groups, F.col("rep") == F.col("node"), "left")
    known = known.select(fresh("a").alias("class_a"), fresh("b").alias("class_b"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("class_links"), F.coalesce("component", "rep").alias("class_component"))
    out = rows.select("vec_id", *key).join(known, (F.col("a") == F.col("class_a")) & (F.col("b") == F.col("class_b")), "left")
    component = F.coalesce("class_component", "vec_id")
    return out.select("vec_id", F.coalesce("class_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
