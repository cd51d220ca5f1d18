"""Trigram postings of a field: substrings and likeness are looked up, and only candidates are verified on their texts.

A text's grams are the distinct three-character windows of its text in lower case, with two spaces before and one after, as
in trigram indexes. A substring's own windows are all among them, so of the rarest few of these every item that has the
substring has a posting. Likeness needs no text at all: it follows from shared grams and sizes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.plans.query import Cond, Group

#: Grams of a substring whose postings are read, rarest first.
RAREST = 4
#: Characters that are folded at once, about.
SLICE = 1 << 20
OPERATORS = frozenset({"CONTAINS", "STARTS_WITH", "ENDS_WITH", "LIKE"})


@dataclass(frozen=True)
class GramIndex:
    """postings(gram, id, size): size is the number of grams of the id's text; counts(gram, n)."""

    postings: DataFrame
    counts: DataFrame


def _folded(codes: np.ndarray) -> np.ndarray:
    """Code points in lower case, each by itself, so that a part of a text folds as the whole does."""
    chars, inverse = np.unique(codes, return_inverse=True)
    lower = [low if len(low := chr(c).lower()) == 1 else chr(c) for c in chars.tolist()]
    return np.array([ord(c) for c in lower], np.int64)[inverse]


def _codes(text: str) -> np.ndarray:
    # the one capital whose lower case is two characters
    return _folded(np.frombuffer(text.replace("İ", "i̇").encode("utf-32-le", "surrogatepass"), "<u4"))


def _windows(codes: np.ndarray) -> np.ndarray:
    """Each window as one number, exactly: three times 21 bits."""
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


def grams(text: str, before: str = "  ", after: str = " ") -> list[int]:
    """The distinct grams of a text, padded as told."""
    return np.unique(_windows(_codes(before + text + after))).tolist() if len(text) + len(before) + len(after) > 2 else []


def build(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """postings(gram, id, size) of the whole texts of a column, row by row; null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, at = b.column(0), b.column(1).to_pylist(), 0
            while at < len(texts):
                part, held = [], 0
                while at + len(part) < len(texts) and (held < SLICE or not part):
                    part.append(texts[at + len(part)].replace("İ", "i̇"))
                    held += len(part[-1]) + 3
                lengths = np.array([len(t) + 3 for t in part])
                codes = _folded(np.frombuffer("".join(f"  {t} " for t in part).encode("utf-32-le", "surrogatepass"), "<u4"))
                row = np.repeat(np.arange(len(part)), lengths)
                every = _windows(codes)
                inside = row[:-2] == row[2:]
                every, row = every[inside], row[:-2][inside]
                order = np.lexsort((every, row))
                every, row = every[order], row[order]
                first = np.append(True, (every[1:] != every[:-1]) | (row[1:] != row[:-1])) if len(every) else np.zeros(0, bool)
                every, row = every[first], row[first]
                sizes = np.bincount(row, minlength=len(part)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(every), ids.take(pa.array(row + at)), pa.array(sizes[row])], ["gram", "id", "size"])
                at += len(part)

    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    return rows.mapInArrow(run, f"gram long, id {rows.schema['id'].dataType.simpleString()}, size int")


def write(postings: DataFrame, path: str, files: int) -> None:
    """Write postings to a folder, in place of what is there: dealt by hashes of grams, common grams by ids too; sorted."""
    spark = postings.sparkSession
    # a gram that very many texts have goes to four files, whatever its share
    postings.repartition(files, "gram", F.pmod(F.xxhash64("id"), F.lit(4))).sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).repartition(1).sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{path}/counts")


def read(spark: SparkSession, path: str) -> GramIndex:
    return GramIndex(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/counts"))


def _runs(pattern: str) -> list[tuple[str, str, str]]:
    """The literal runs of a LIKE pattern, each with the padding that an anchored end has."""
    runs, now, anchored, i = [], [], True, 0
    while i < len(pattern):
        c = pattern[i]
        if c in "%_":
            runs.append(("".join(now), "  " if anchored else "", ""))
            now, anchored = [], False
        else:
            if c == "\\" and i + 1 < len(pattern):
                i += 1
                c = pattern[i]
            now.append(c)
        i += 1
    return [*runs, ("".join(now), "  " if anchored else "", " ")]


def required(op: str, value: str) -> list[int]:
    """Grams that every text has for which a condition holds; none if too little is known."""
    if op == "LIKE":
        return sorted({g for run, before, after in _runs(value) for g in grams(run, before, after)})
    before, after = {"CONTAINS": ("", ""), "STARTS_WITH": ("  ", ""), "ENDS_WITH": ("", " ")}[op]
    return grams(value, before, after)


def having(built: GramIndex, wanted: list[int]) -> DataFrame:
    """(id) of the items that have the rarest of these grams, all of those that are read."""
    found = {r.gram: r.n for r in built.counts.where(F.col("gram").isin(wanted)).groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    if len(found) < len(wanted):  # a gram that no text has
        return built.postings.where(F.lit(False)).select("id")
    rare = sorted(wanted, key=lambda g: (found[g], g))[:RAREST]
    rows = built.postings.where(F.col("gram").isin(rare))
    return rows.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rare)).select("id")


def candidates(group: Group | Cond, indexes: dict[str, GramIndex]) -> DataFrame | None:
    """(id) of all items that may satisfy a condition tree, by the trigram indexes of its fields; None where they can't tell."""
    if isinstance(group, Cond):
        if group.op not in OPERATORS or group.field not in indexes or not isinstance(group.value, str):
            return None
        wanted = required(group.op, group.value)
        return having(indexes[group.field], wanted) if wanted else None
    each = [candidates(m, indexes) for m in group.members]
    if group.conjunction == "OR":
        if not each or any(x is None for x in each):
            return None
        out = each[0]
        for x in each[1:]:
            out = out.union(x)
        return out.distinct()
    out = None
    for x in each:
        if x is not None:
            out = x if out is None else out.join(x, "id", "left_semi")
    return out


def similar(built: GramIndex, text: str, least: float) -> DataFrame:
    """(id, similarity) of the items whose texts have a trigram similarity of at least ``least`` to a text, least > 0.

    Shared grams by all grams of both. Sizes alone refuse texts that are too short or too long for it; the rest is
    counted from postings.
    """
    mine = grams(text)
    rows = built.postings.where(F.col("gram").isin(mine) & (F.col("size") >= least * len(mine)) & (F.col("size") * least <= len(mine)))
    shared = rows.groupBy("id").agg(F.count(F.lit(1)).cast("double").alias("n"), F.max("size").alias("size"))
    return shared.select("id", (F.col("n") / (F.col("size") + len(mine) - F.col("n"))).alias("similarity")).where(F.col("similarity") >= least)


def ilike(built: GramIndex, pattern: str) -> DataFrame | None:
    """(id) of the items that may match a LIKE pattern in any case of letters; None where the index can't tell."""
    wanted = required("LIKE", pattern) if re.fullmatch(r"[\x00-\x7f]*", pattern) else []
    return having(built, wanted) if wanted else None
