"""Near copies at an exact Jaccard similarity of five-word shingles: SimHash's index first, then what its bits can't promise.

The SimHash index finds the closest copies. Texts with four fifths of their shingles in common differ in more bits than
any number of shared bytes covers, so an inverted index on each text's first shingles completes the search; both
give candidates, and one exact comparison of shingle sets decides all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, keyed, remove, settle, slices, small
from seekframe.llm.components import Forest, components
from seekframe.llm.simhash import links, majority, shingle_hashes, signed

WIDTH = 5
#: Least similarity of a link, as a fraction: four fifths.
PART, WHOLE = 4, 5
#: SimHash bits at which texts become candidates; whether they link is decided by their shingles.
MAX_DISTANCE = 3
#: Share of the texts that frequencies are estimated on, and texts at least; the count from which a shingle is put last,
#: and how many are, at most. They only steer the order of shingles, and any order finds every pair. As a share, the
#: sample lets posting lists grow as long in a large table as in a small one.
SAMPLE_SHARE, SAMPLE, COMMON, MOST_COMMON = 0.1, 2000, 5, 1_000_000
#: Classes that a task remembers in order to write their first shingles once.
SEEN = 200_000
#: Bins of the histogram of a set's hashes, by which most candidates are refused before their sets are sent.
BINS = 256
#: Sets, and bytes of them, in one block of a tile, about.
BLOCK_SETS, BLOCK_BYTES = 1024, 8 << 20
#: Members of a list up to which those that aren't connected meet as pairs; those of longer lists meet in tiles.
LIST = 1024
#: Rows up to which a table of one long is broadcast.
LONGS = 2_000_000


def class_names(shingles: bytes) -> tuple[int, int]:
    """Two 64-bit names of a set of shingles; sets that share the first are told apart by the second."""
    return tuple(int.from_bytes(xxhash.xxh64_digest(shingles, seed), "big", signed=True) for seed in (0, 1))


def _bucket(size: Column) -> Column:
    """Sizes in steps of WHOLE / PART: sets that can be alike are in the same step or in neighbouring ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / F.log(F.lit(WHOLE / PART)) + 1e-9).cast("int")


def _meeting(posts: DataFrame) -> DataFrame:
    """The rows of posts(key, cls, size, pos) that another row of their list may match by its size.

    A list is summed up where it arises, as its number of rows and the steps of size that it has, a bit each; single rows
    and those without a neighbour go. No list is ever in one place.
    """
    mark = F.expr("shiftleft(1L, least(step, 62))")
    steps = posts.withColumn("step", _bucket(F.col("size")))
    lists = steps.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_or(mark).alias("steps")).where("n > 1")
    lists, _ = settle(lists.select(fresh("key").alias("_key"), "n", "steps"), "shingles-met")
    met = steps.join(lists, F.col("key") == F.col("_key"))
    beside = F.expr("(shiftleft(1L, least(step + 1, 62)) | shiftleft(1L, least(greatest(step - 1, 0), 62))) & ~shiftleft(1L, least(step, 62)) & steps") != 0
    shared = F.col("n") > F.bit_count("steps")  # some step has two rows; this may be the one
    last = F.col("step") >= 62
    return met.where(beside | shared | last).select("key", "cls", "size", "pos")


def _parts(rows: Iterable[tuple[np.ndarray, ...]], most: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """Columns of many rows joined, in parts of about ``most`` values."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[0])
        if n >= most:
            yield [np.concatenate(x) for x in zip(*held)]
            held, n = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _common(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, their counts) of the most frequent shingles in a sample of different texts."""
    share = min(1.0, max(SAMPLE_SHARE, SAMPLE / max(1, texts.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _parts((np.unique(shingle_hashes(t.as_py(), WIDTH)).view(np.int64),) for t in b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["h"])

    drawn = texts.where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) < share * (1 << 30)).select("text").distinct()
    counts = drawn.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).cast("int").alias("n")).where(F.col("n") >= COMMON)
    counts, path = settle(counts, "shingles-common")
    # the least count at which no more than MOST_COMMON shingles are left; counts are few, and their histogram is small
    least, left = COMMON, 0
    for r in counts.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).collect():
        left += r.k
        if left > MOST_COMMON:
            least = r.n + 1
            break
    got = counts.where(F.col("n") >= least).toArrow()
    remove(texts.sparkSession, path)
    hashes, n = got["h"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def ordered(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Distinct shingles, rare ones first, in an order that is the same for all texts."""
    known, counts = common
    if not len(known) or not len(hashes):
        return hashes
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return hashes[np.argsort(np.where(known[at] == hashes, counts[at], 0), kind="stable")]


def prefix(size: int) -> int:
    """Shingles at the front of which two sets of that similarity share at least one."""
    return size - -(-PART * size // WHOLE) + 1 if size else 0


def histogram(hashes: np.ndarray) -> bytes | None:
    """How many of the hashes fall into each bin, a byte each; None where a byte is too small, which refuses nothing."""
    counts = np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=BINS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


def _may_be_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v, ...) whose histograms leave room for enough common hashes: no bin has more than the lesser count."""
    for b in batches:
        a, c, sizes = b.column("sig_u"), b.column("sig_v"), b.column("size_u").to_numpy().astype(np.int64) + b.column("size_v").to_numpy()
        both = np.nonzero(~np.asarray(a.is_null()) & ~np.asarray(c.is_null()))[0]
        keep = np.ones(b.num_rows, bool)
        if len(both):
            x, y = (np.frombuffer(b"".join(s.take(pa.array(both)).to_pylist()), np.uint8).reshape(-1, BINS) for s in (a, c))
            keep[both] = np.minimum(x, y).sum(axis=1, dtype=np.int64) * (PART + WHOLE) >= sizes[both] * PART
        yield b.select(["u", "v", "cu", "cv"]).filter(pa.array(keep))


def _alike(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    """Links of groups by those pairs of one tile whose sets have PART / WHOLE of their union in common; a forest."""
    held = {c: np.frombuffer(x.as_buffer(), np.uint64) for c, x in zip(sets["cls"].to_pylist(), sets["shingles"].combine_chunks() if sets.num_rows else [])}
    forest = Forest()
    for u, v, cu, cv in zip(*(pairs[n].to_pylist() for n in ("u", "v", "cu", "cv"))):
        if forest.find(cu) != forest.find(cv):
            x, y = held[u], held[v]
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if WHOLE * shared >= PART * (len(x) + len(y) - shared):
                forest.union(cu, cv)
    nodes, roots = forest.stars()
    return pa.table({"u": pa.array(nodes, pa.int64()), "v": pa.array(roots, pa.int64())})


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts, which are larger than these, in parts of bounded size."""
    for b in batches:
        at = 0
        for texts in slices(b.column(1)):
            sets = [np.unique(shingle_hashes(t, WIDTH)).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(sets, pa.binary())], ["cls", "shingles"])
            at += len(texts)


def _sets(known: DataFrame, texts: DataFrame, tag: str) -> DataFrame:
    """(cls, shingles) of the classes known(cls, id), from their texts; texts that share an id give equal rows."""
    ids = small(known.select(fresh("id").alias("_id"), "cls"), f"{tag}-ids", LONGS // 2)
    return texts.join(ids, F.col("doc_id") == F.col("_id")).select("cls", "text").mapInArrow(_whole, "cls long, shingles binary")


def _verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, tag: str) -> DataFrame:
    """Links (u, v) of the groups cu and cv of alike classes, from pairs (u, v, cu, cv) of classes.

    Histograms refuse most pairs that aren't alike. The sets of the others are made again, from one text of each class,
    and each is sent once to the pairs of its bundle, which are all that hang together; a large bundle is cut into
    blocks that meet two by two.
    """
    pairs, pairs_path = settle(pairs.distinct(), f"{tag}-pairs")
    ends = lambda df: small(df.select(F.explode(F.array("u", "v")).alias("_end")).distinct(), f"{tag}-ends", LONGS)
    mine = rows.where("first").join(ends(pairs).select(fresh("_end").alias("_end")), F.col("cls") == F.col("_end"), "left_semi")
    mine, mine_path = settle(mine.groupBy("cls").agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), F.first("sig").alias("sig")), f"{tag}-classes")
    side = lambda x: mine.select(fresh("cls").alias(f"cls_{x}"), F.col("size").alias(f"size_{x}"), F.col("sig").alias(f"sig_{x}"))
    met = pairs.join(side("u"), F.col("u") == F.col("cls_u")).select("u", "v", "cu", "cv", "size_u", "sig_u")
    met = met.join(side("v"), F.col("v") == F.col("cls_v")).select("u", "v", "cu", "cv", "size_u", "size_v", "sig_u", "sig_v")
    pairs, near_path = settle(met.mapInArrow(_may_be_alike, "u long, v long, cu long, cv long"), f"{tag}-near")
    remove(rows.sparkSession, pairs_path)

    bundle, _ = settle(components(pairs.select("u", "v"), f"{tag}-bundles"), f"{tag}-bundle")
    known = mine.join(bundle.select(fresh("node").alias("node"), "component"), F.col("cls") == F.col("node")).select("cls", "id", "size", "component")
    known, _ = settle(known, f"{tag}-known")
    load = known.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("long") * 8).alias("bytes"))
    load = load.select(fresh("component").alias("_component"), F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("long").alias("blocks"))
    known = known.join(load, F.col("component") == F.col("_component")).select("cls", "id", "component", "blocks", (F.col("size").cast("long") * 8).alias("bytes"))
    known, _ = settle(known, f"{tag}-dealt")

    sets = _sets(known, texts, tag)
    total = known.agg(F.sum("bytes").alias("bytes")).first().bytes or 0
    tiles = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (BLOCK_BYTES // 2)))
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(13)), F.col("blocks"))
    # small bundles share the tiles; each two blocks of a large one have a tile of their own
    tile = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(tiles))).otherwise(F.xxhash64("component", F.least(block("u"), block("v")), F.greatest(block("u"), block("v"))))
    dealt = pairs.join(known.select(fresh("cls").alias("_cls"), "component", "blocks"), F.col("u") == F.col("_cls")).select("u", "v", "cu", "cv", tile.alias("tile"))
    dealt, _ = settle(dealt, f"{tag}-tiles")
    where = dealt.select(F.explode(F.array("u", "v")).alias("_end"), "tile").distinct().select(fresh("_end").alias("_end"), "tile")
    sent = sets.join(where, F.col("cls") == F.col("_end")).select(fresh("tile").alias("at"), "cls", "shingles").dropDuplicates(["at", "cls"])
    found, _ = settle(dealt.groupBy("tile").cogroup(sent.groupBy("at")).applyInArrow(_alike, "u long, v long"), f"{tag}-links")
    for path in (mine_path, near_path):
        remove(rows.sparkSession, path)
    return found


def _tile(rows: pa.Table) -> pa.Table:
    """Links of groups by the alike classes of one tile (own, comp, shingles); a forest.

    Each set's hashes are looked up in an inverted index of the tile, which counts what it has in common with all others.
    """
    comps, own = rows["comp"].to_numpy(), rows["own"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for c in rows["shingles"].chunks for x in c]
    size = np.array([len(x) for x in sets])
    hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    crossed, forest = rows["i"][0].as_py() != rows["j"][0].as_py(), Forest()
    for u, mine in enumerate(sets):
        begin, length = np.searchsorted(hashes, mine), np.searchsorted(hashes, mine, side="right")
        length = length - begin
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        alike = WHOLE * shared >= PART * (size + len(mine) - shared)
        alike[: u + 1] = False
        if crossed:
            alike &= own != own[u]
        for c in np.unique(comps[alike]).tolist():
            forest.union(int(comps[u]), c)
    nodes, roots = forest.stars()
    return pa.table({"u": pa.array(nodes, pa.int64()), "v": pa.array(roots, pa.int64())})


def _met_in_tiles(members: DataFrame, rows: DataFrame, texts: DataFrame, tag: str) -> DataFrame:
    """Links (u, v) of the components of members(key, cls, comp) of long lists, whose classes all meet one another.

    A list is cut into blocks that meet two by two, so its length bounds no task and no pair is ever a row; of lists
    with the same members one is looked at.
    """
    members, members_path = settle(members, f"{tag}-members")
    lists = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(3))).alias("y"))
    lists = lists.groupBy("n", "x", "y").agg(F.min("key").alias("_key")).select(fresh("_key").alias("_key"), F.ceil(F.col("n") / BLOCK_SETS).cast("int").alias("blocks"))
    dealt = members.join(lists, F.col("key") == F.col("_key")).withColumn("own", F.pmod(F.xxhash64("cls", F.lit(5)), F.col("blocks")).cast("int"))
    dealt = dealt.select("key", "cls", "comp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt, _ = settle(dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "comp"), f"{tag}-tiles")
    ends = small(dealt.select(fresh("cls").alias("_end")).distinct(), f"{tag}-ends", LONGS)
    known = rows.where("first").join(ends, F.col("cls") == F.col("_end"), "left_semi").groupBy("cls").agg(F.min("doc_id").alias("id"))
    sets = _sets(known, texts, tag).dropDuplicates(["cls"]).select(fresh("cls").alias("_cls"), "shingles")
    met = dealt.join(sets, F.col("cls") == F.col("_cls")).select("key", "i", "j", "own", "comp", "shingles")
    found, _ = settle(met.groupBy("key", "i", "j").applyInArrow(_tile, "u long, v long"), f"{tag}-links")
    remove(rows.sparkSession, members_path)
    return found


def _enough(a: str, b: str) -> Column:
    """From their first common shingle on, both sets must still hold what they need in common: 4/9 of both sizes."""
    size, left = F.col(f"size{a}") + F.col(f"size{b}"), F.least(F.col(f"size{a}") - F.col(f"pos{a}"), F.col(f"size{b}") - F.col(f"pos{b}"))
    return left * (PART + WHOLE) >= size * PART


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id) for every row: texts link if at least four fifths of their distinct shingles agree.

    Rows with equal shingle sets are one class. Candidates come from two indexes. The first is SimHash's byte-position
    index over fingerprints of distinct shingles, at MAX_DISTANCE bits. The second is exact: in an order that is common
    to all, rare shingles first, two sets of that similarity share a shingle among the first of each (``prefix``),
    which are posted to an inverted index, of which sizes and positions allow few pairs. All candidates are verified on the whole
    sets. In the second index each member first meets that of its list which is in most lists; then those of the same
    list that aren't connected yet meet one another, in long lists by tiles, so a large group of copies never has all its
    pairs as rows.

    component_id names the group, and is no id of a row. Every row needs an id, and rows that share one must share
    their text. Null and empty texts are one class. Very long texts count whole. Empty table: no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    common = spark.sparkContext.broadcast(_common(texts))

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        names = ["doc_id", "cls", "cls2", "size", "first", "fp", "sig", "front"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]

        def described(doc: int, text: str | None) -> tuple:
            hashes = np.unique(shingle_hashes(text, WIDTH))
            c = class_names(hashes.tobytes())
            if c in seen:
                return doc, *c, len(hashes), False, None, None, None
            if len(seen) < SEEN:
                seen.add(c)
            return doc, *c, len(hashes), True, signed(majority(hashes)), histogram(hashes), ordered(hashes, common.value)[: prefix(len(hashes))].tobytes()

        for b in batches:
            at = 0
            for part in slices(b.column(1)):
                out = list(map(described, b.column(0).slice(at, len(part)).to_pylist(), part))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)
                at += len(part)

    def posts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fronts = ((np.frombuffer(x.as_buffer(), np.int64), c, n) for c, n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)))
            for part in _parts((x, np.full(len(x), c, np.int64), np.full(len(x), n, np.int32), np.arange(len(x), dtype=np.int32)) for x, c, n in fronts):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], ["key", "cls", "size", "pos"])

    every, every_path = settle(texts.mapInArrow(classes, "doc_id long, cls long, cls2 long, size int, first boolean, fp long, sig binary, front binary"), "shingles-all")
    other = keyed(every, "name", every.select(F.col("cls").alias("h1"), F.col("cls2").alias("h2")))
    if other is not None:
        names = small(other.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("name").alias("_name")), "shingles-other")
        every = every.join(names, (F.col("cls") == F.col("_1")) & (F.col("cls2") == F.col("_2")), "left").withColumn("cls", F.coalesce("_name", "cls")).drop("_1", "_2", "_name")
    every = every.drop("cls2")

    # the second index: a list's members that no other member can match, by their sizes, are left out
    posted = every.where("first").select("cls", "size", "front").mapInArrow(posts, "key long, cls long, size int, pos int")
    lists = _meeting(posted).groupBy("key", "cls").agg(F.first("size").alias("size"), F.first("pos").alias("pos"))
    lists, _ = settle(lists, "shingles-lists")
    rows, _ = settle(every.drop("front"), "shingles-rows")
    remove(spark, every_path)

    # the first index: fingerprints that are near, and classes that share one
    prints, _ = settle(rows.where("first").groupBy("fp").agg(F.min("cls").alias("rep")), "shingles-prints")
    same = rows.where("first").select("cls", fresh("fp").alias("of")).join(prints, F.col("of") == F.col("fp")).where(F.col("cls") != F.col("rep")).select(F.col("rep").alias("u"), F.col("cls").alias("v"))
    near = links(prints.select("fp", "rep"), MAX_DISTANCE).union(same)
    # of each list every member meets the one that is in most lists: the likeliest original of a group of copies
    degree = lists.groupBy("cls").agg(F.count(F.lit(1)).alias("degree")).select(fresh("cls").alias("of"), "degree")
    ranked, _ = settle(lists.join(degree, F.col("cls") == F.col("of")).select("key", "cls", "size", "pos", "degree"), "shingles-ranked")
    best = ranked.groupBy("key").agg(F.max(F.struct("degree", "cls", "size", "pos")).alias("best")).select(fresh("key").alias("_key"), "best")
    stars = ranked.join(best, F.col("key") == F.col("_key")).select("cls", "size", "pos", F.col("best.cls").alias("clso"), F.col("best.size").alias("sizeo"), F.col("best.pos").alias("poso"))
    stars = stars.where((F.col("cls") != F.col("clso")) & _enough("", "o")).select(F.col("clso").alias("u"), F.col("cls").alias("v"))
    stars = _verified(near.union(stars).select("u", "v", F.col("u").alias("cu"), F.col("v").alias("cv")), rows, texts, "shingles-stars")
    known, _ = settle(components(stars, "shingles-known"), "shingles-first")

    open_ = lists.join(known.select(fresh("node").alias("node"), "component"), F.col("cls") == F.col("node"), "left").select("key", "cls", "size", "pos", F.coalesce("component", "cls").alias("comp"))
    open_, _ = settle(open_, "shingles-joined")
    still = open_.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high")
    open_ = open_.join(still.select(fresh("key").alias("_key"), "n"), F.col("key") == F.col("_key")).select("key", "cls", "size", "pos", "comp", "n")
    open_, _ = settle(open_, "shingles-open")
    short = open_.where(F.col("n") <= LIST)
    one, two = (short.select(fresh("key").alias(f"key{s}"), *(F.col(c).alias(f"{c}{s}") for c in ("cls", "size", "pos", "comp"))) for s in "ab")
    pairs = one.join(two, (F.col("keya") == F.col("keyb")) & (F.col("clsa") < F.col("clsb")) & (F.col("compa") != F.col("compb")) & _enough("a", "b"))
    rest = _verified(pairs.select(F.col("clsa").alias("u"), F.col("clsb").alias("v"), F.col("compa").alias("cu"), F.col("compb").alias("cv")), rows, texts, "shingles-rest")
    long = _met_in_tiles(open_.where(F.col("n") > LIST).select("key", "cls", "comp"), rows, texts, "shingles-long")
    found = components(stars.union(rest).union(long), "shingles-components")
    return rows.join(found.select(fresh("node").alias("node"), "component"), F.col("cls") == F.col("node"), "left").select("doc_id", F.coalesce("component", "cls").alias("component_id"))
