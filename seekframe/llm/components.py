"""Connected components of a link table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, remove, settle


class Forest:
    """Union-find over 64-bit ids; the root of a set is its smallest id."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            self.parent[high] = low
            self.parent.setdefault(low, low)

    def stars(self) -> tuple[list[int], list[int]]:
        """(node, root) of every node that isn't its own root."""
        nodes = [x for x, up in self.parent.items() if x != up]
        return nodes, [self.find(x) for x in nodes]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links in one partition: never more rows than came in."""
    forest = Forest()
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            forest.union(u, v)
    nodes, roots = forest.stars()
    for i in range(0, len(nodes), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i : i + 50_000], pa.int64()), pa.array(roots[i : i + 50_000], pa.int64())], ["u", "v"])


def _signature(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component) for every id in links(u long, v long), an undirected link table.

    component is the smallest id reachable. Null ends and self links are ignored; repeated links are harmless; an
    empty table gives an empty result. Each round is written to the shared folder, so a lost executor costs one round
    at most. A hub is safe: minima are combined before they are shuffled, and the joins' exchanges can be split.
    """
    clean = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v")
    # two local contractions: where the links arise, and once they are dealt out by their smaller end
    state, path = settle(clean.mapInArrow(_contract, "u long, v long").distinct(), tag)
    before = _signature(state)
    while before[0]:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(fresh("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = settle(large, tag)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        keyed = least.select(fresh("u").alias("k"), "m")
        down = large.join(keyed, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after_state, after_path = settle(down.union(least.select("u", F.col("m").alias("v"))).distinct(), tag)
        after = _signature(after_state)
        remove(links.sparkSession, path)
        remove(links.sparkSession, large_path)
        state, path = after_state, after_path
        if after == before:
            break
        before = after
    stars = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
