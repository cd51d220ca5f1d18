"""SimHash near-duplicates, found with a byte-position inverted index and count filtering."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, keyed, row_hashes, settle, small, unused
from seekframe.llm.components import Forest, components

SEED = 42
BYTES = 8
#: Rows of one posting list that one tile holds; longer lists are cut into blocks of this size.
TILE = 1024
#: Fingerprints that a posting key should have on average at most; keys get more bytes as the table grows.
KEY_LOAD = 16

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Hashes of the word shingles of one text, in order and with repeats; words as for ``fingerprint``."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        return np.array([_hash(b" ".join(words))], np.uint64)
    return np.fromiter(map(_hash, map(b" ".join, zip(*(words[i:] for i in range(width))))), np.uint64, len(words) - width + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes, as an unsigned number; 0 if there are none."""
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # whole texts, in slices of bounded memory
        bits += np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(bits * 2 > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of the word shingles of one text, as an unsigned number of 64 bits.

    A-Z are lower-cased, words are runs of anything but ASCII white space, repeated shingles count each time. Fewer
    words than ``width``: the whole sequence is the one shingle. No words, or null: 0.
    """
    return majority(shingle_hashes(text, width))


def signed(print_: int) -> int:
    """A fingerprint as a signed long."""
    return print_ - (1 << 64) if print_ >> 63 else print_


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row, as a signed long; row by row, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([signed(fingerprint(t.as_py(), width)) for t in b.column(1)], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def plan(max_distance: int, prints: int) -> tuple[int, list[tuple[int, ...]]]:
    """(matches that a pair must have, posting keys as positions of bytes).

    Fingerprints that differ in d bits differ in d bytes at most, so 8 - d positional bytes are guaranteed to match. Of
    any d + k positions at least k match; each choice of k of the first d + k is one posting key, so every pair meets.
    k is three, or more where so many fingerprints would make lists of three bytes long.
    """
    if not 0 <= max_distance < BYTES:
        raise ValueError("max_distance must be 0 to 7 for an index on 8 positional bytes")
    need = BYTES - max_distance
    k = min(need, 3)
    while k < need and prints > KEY_LOAD << 8 * k:
        k += 1
    return need, list(combinations(range(max_distance + k), k))


def enough_bytes(differ: np.ndarray, need: int) -> np.ndarray:
    """The count filter: which pairs, given as XORs of fingerprints, share at least ``need`` positional bytes."""
    return (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1) >= need


def links(reps: DataFrame, max_distance: int = 3, tile: int = TILE) -> DataFrame:
    """(u, v): links that connect the same fingerprints as the pairs found within max_distance differing bits do.

    reps(fp, rep): one row for each distinct fingerprint. The index maps (positions, their bytes) to postings. The
    positional bytes that the pairs of a list share are tallied, pairs below the guaranteed minimum are dropped, and
    the rest are verified by counting differing bits. A pair that meets in several lists counts only in the first. A
    list longer than ``tile`` is cut into blocks that meet two by two, in tasks of bounded size, so no key, however
    common, falls to one task; and each task returns a spanning forest, never all its pairs.
    """
    need, keys = plan(max_distance, reps.count())
    width = len(keys[0])
    byte = lambda p: F.shiftrightunsigned("fp", 8 * (BYTES - 1 - p)).bitwiseAND(F.lit(255))
    # a key is the number of its choice of positions, and their bytes side by side
    packed = lambda ps: sum((F.shiftleft(byte(p), 8 * i) for i, p in enumerate(ps)), F.lit(0).cast("long"))
    postings = F.array(*(F.struct(F.lit(k).alias("which"), packed(ps).alias("bytes")) for k, ps in enumerate(keys)))
    posts = reps.select("fp", "rep", F.explode(postings).alias("p")).select("fp", "rep", F.col("p.which").alias("which"), F.col("p.bytes").alias("bytes"))
    long_lists = small(posts.groupBy("which", "bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile), "simhash-long-lists")
    blocks = F.coalesce(F.ceil(F.col("n") / tile), F.lit(1)).cast("int")
    long_lists = long_lists.select(fresh("which", "int").alias("w"), fresh("bytes").alias("k"), "n")
    dealt = posts.join(long_lists, (F.col("which") == F.col("w")) & (F.col("bytes") == F.col("k")), "left").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = dealt.select("fp", "rep", "which", "bytes", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("which", "bytes", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "fp")
    positions = np.array(keys).reshape(len(keys), width)

    def tally(which: np.ndarray, key: np.ndarray, i: np.ndarray, j: np.ndarray, own: np.ndarray, rep: np.ndarray, prints: np.ndarray, forest: Forest) -> None:
        """Every pair of rows in the same tile, at distance 1, 2, 3 ... in the sorted rows, until no tile is as long."""
        begins = np.ones(len(key), bool)
        begins[1:] = (which[1:] != which[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        tile_of, crossed = np.cumsum(begins), i != j
        left, step = np.arange(len(key)), 1
        while len(left):
            left = left[left + step < len(key)]
            left = left[tile_of[left] == tile_of[left + step]]
            a = left[~crossed[left] | (own[left] != own[left + step])]
            for at in range(0, len(a), 1 << 16):
                x = a[at : at + (1 << 16)]
                differ = prints[x] ^ prints[x + step]
                counted = np.nonzero(enough_bytes(differ, need))[0]
                x, differ = x[counted], differ[counted]
                near = np.nonzero(np.bitwise_count(differ) <= max_distance)[0]
                if len(near):
                    x, shared = x[near], differ[near].view(np.uint8).reshape(-1, BYTES) == 0
                    x = x[shared[:, positions].all(axis=2).argmax(axis=1) == which[x]]
                    for u, v in zip(rep[x].tolist(), rep[x + step].tolist()):
                        forest.union(u, v)
            step += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held = Forest(), None
        for b in batches:
            now = [b.column(n).to_numpy() for n in range(6)]
            # bytes in the order of positions, so that a byte's place in memory is its position
            now.append(b.column(6).to_numpy().astype(">i8").view(np.uint64))
            if held is not None:
                now = [np.concatenate([x, y]) for x, y in zip(held, now)]
            # the last tile may go on in the next batch; a tile has about 2 * TILE rows, so what is held is bounded
            last = np.all([x == x[-1] for x in now[:4]], axis=0) if len(now[0]) else np.zeros(0, bool)
            cut = int(np.argmax(last)) if len(last) else 0
            tally(*(x[:cut] for x in now), forest)
            held = [x[cut:] for x in now]
            if len(forest.parent) > 200_000:
                yield from emit(forest)
                forest = Forest()
        if held is not None:
            tally(*held, forest)
        yield from emit(forest)

    def emit(forest: Forest) -> Iterator[pa.RecordBatch]:
        nodes, roots = forest.stars()
        for at in range(0, len(nodes), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 50_000], pa.int64()), pa.array(roots[at : at + 50_000], pa.int64())], ["u", "v"])

    order = ["which", "bytes", "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs, other columns are ignored.

    fingerprint: 16 lower-case hex digits. Rows link if their fingerprints differ in at most max_distance bits;
    component_id is the smallest id reachable, itself included. Null and empty texts have fingerprint zero and link
    like any other. Very long texts are counted whole, in slices. Repeated rows stay repeated and share their component;
    a row with a null id keeps its fingerprint and takes the component of its fingerprint (null if no other row has an
    id there). Empty table: no rows.
    """
    prints, prints_path = settle(fingerprints(docs, id_col, text_col, width), "simhash-prints")
    reps, _ = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    found = components(links(reps.where("rep is not null"), max_distance), "simhash-components")
    classes = reps.join(found.select(fresh("node").alias("node"), "component"), F.col("rep") == F.col("node"), "left")
    classes = classes.select(fresh("fp").alias("class"), F.coalesce("component", "rep").alias("component_id"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, F.col("fp") == F.col("class"), "left").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", find: Callable[..., DataFrame] = near_duplicates, **how) -> DataFrame:
    """docs without near-duplicates: of each group that ``find`` makes one row stays, with all its columns.

    That is the row with the smallest id, null ids last, then by a hash of the whole row; rows that agree in all
    columns leave one. Whole rows are not shuffled while those to drop are few enough to broadcast. Null and empty
    texts are one group. Columns of any name and type stay. Empty table: no rows.

    A row is named by one 64-bit hash of its values, and where different rows share that, by another (common.keyed).
    """
    mark, gone, again, second = (unused(docs, n) for n in ("mark", "gone", "again", "second"))
    h1, h2 = row_hashes(docs)
    marked = docs.withColumns({mark: h1, second: h2})
    each, _ = settle(marked.groupBy(F.col(mark).alias("h1"), F.col(second).alias("h2")).agg(F.min(F.col(f"`{id_col}`").cast("long")).alias("id"), F.count(F.lit(1)).alias("rows")), "simhash-rows")
    other = keyed(docs, "key", each.select("h1", "h2"))
    if other is not None:
        one, two, new = (unused(marked, n) for n in ("one", "two", "new"))
        names = small(other.select(F.col("h1").alias(one), F.col("h2").alias(two), F.col("key").alias(new)), "simhash-other")
        marked = marked.join(names, (F.col(mark) == F.col(one)) & (F.col(second) == F.col(two)), "left").withColumn(mark, F.coalesce(new, mark)).drop(one, two, new)
        each = each.join(other, ["h1", "h2"], "left").withColumn("h1", F.coalesce("key", "h1"))
    marked = marked.drop(second)
    thin = marked.select(F.col(mark).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = find(thin, **how).groupBy("doc_id").agg(F.min("component_id").alias("group"))
    each = each.select(fresh("h1").alias("mark"), "id", "rows")
    each, _ = settle(found.join(each, F.col("doc_id") == F.col("mark")).select("mark", "id", "group", "rows"), "simhash-marks")
    best = each.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("best"))
    best = best.select(fresh("group").alias("_group"), F.col("best.mark").alias("best"))
    each, _ = settle(each.join(best, F.col("group") == F.col("_group")).select("mark", "rows", (F.col("mark") == F.col("best")).alias("kept")), "simhash-ids")
    dropped = small(each.where("not kept").select(fresh("mark").alias(gone)), "simhash-dropped")
    repeated = small(each.where("kept and rows > 1").select(fresh("mark").alias(again)), "simhash-repeated")
    once = marked.join(dropped, F.col(mark) == F.col(gone), "left_anti")
    if repeated.isEmpty():
        return once.drop(mark)
    copies = marked.join(repeated, F.col(mark) == F.col(again), "left_semi").dropDuplicates([mark])
    return once.join(repeated, F.col(mark) == F.col(again), "left_anti").unionByName(copies).drop(mark)
