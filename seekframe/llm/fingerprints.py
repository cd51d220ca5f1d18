"""Document fingerprints: threshold-scaled sketches of word shingles."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import settle

SEED = 42
WIDTH = 5
#: A sketch holds all hashes among the lowest 1 / SCALE of all 64-bit values: the fixed fraction, whatever the length.
SCALE = 2
LIMIT = (1 << 64) // SCALE
#: Bytes of text in one range of ids, about, and most ranges that are made.
RANGE_BYTES, MOST_RANGES = 16 << 20, 4096

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


@dataclass(frozen=True, eq=False)
class Sketch:
    """Sorted distinct hashes: all below 1 / SCALE of the hash range, and the lowest one where none is there.

    A sketch is complete up to its reach: that limit, or the lowest hash above it.
    """

    hashes: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray) -> Sketch:
        """From the hashes of all shingles, in any order and with repeats."""
        low = hashes[hashes < np.uint64(LIMIT)]
        return Sketch(np.unique(low) if len(low) else hashes.min(keepdims=True) if len(hashes) else low)

    @property
    def empty(self) -> bool:
        return not len(self.hashes)

    @property
    def reach(self) -> int:
        return (1 << 64) - 1 if self.empty else max(LIMIT - 1, int(self.hashes[-1]))

    def to_text(self) -> str:
        """Base64 of the hashes, each in eight bytes, big-endian."""
        return base64.b64encode(self.hashes.astype(">u8").tobytes()).decode()

    @staticmethod
    def from_text(text: str) -> Sketch:
        return Sketch(np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64))


def sketch(text: str | None, width: int = WIDTH) -> Sketch:
    """The sketch of a whole text.

    A-Z are lower-cased, words are runs of anything but ASCII white space. Fewer words than ``width``: the whole
    sequence is the one shingle. No words, or null: nothing. The hash of every shingle of the whole text is looked at.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        hashes = np.zeros(0, np.uint64)
    elif len(words) <= width:
        hashes = np.array([_hash(b" ".join(words))], np.uint64)
    else:
        hashes = np.fromiter(map(_hash, map(b" ".join, zip(*(words[i:] for i in range(width))))), np.uint64, len(words) - width + 1)
    return Sketch.of(hashes)


def merge(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of both texts' shingles together, from their sketches alone."""
    return Sketch.of(np.concatenate([a.hashes, b.hashes]))


def _common(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    """Hashes of a, of b and of both, up to where both sketches are complete."""
    x, y = a.hashes, b.hashes
    reach = min(a.reach, b.reach)
    if len(x) and int(x[-1]) > reach:  # the one above the limit
        x = x[:0]
    if len(y) and int(y[-1]) > reach:
        y = y[:0]
    both = np.concatenate([x, y])
    both.sort()
    return len(x), len(y), int((both[1:] == both[:-1]).sum())


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of a's shingles that b has too; 1 if a has none.

    0.0 also where a has words but no hash that can be compared, which 2 ** -n of all texts of n shingles have; the standard error
    of a share c is sqrt(c (1 - c) / n) at this fraction, so long texts are told well, and texts of a few words roughly.
    """
    n, _, both = _common(a, b)
    return both / n if n else float(a.empty)


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of the smaller text's shingles that the other has too, 0 to 1; two texts without words: 1.

    The smaller is that with fewer hashes; 0.0 also where it has none that can be compared (see containment).
    """
    if a.empty or b.empty:
        return float(a.empty and b.empty)
    n, m, both = _common(a, b)
    return both / min(n, m) if min(n, m) else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) for every row, row by row. A null text is an empty one, whose fingerprint is ''; repeated rows
    and null ids stay; other columns are ignored. Very long texts count whole. Empty table: no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sketch(t.as_py()).to_text() for t in b.column(1)], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """text with the last third of its code points replaced by the first as many of the following text."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def _bounds(thin: DataFrame, ranges: int) -> list[tuple[bool, int, int]]:
    """First keys of at most ``ranges`` ranges with about as many bytes each, from thin(o, bytes)."""
    fine = thin.repartitionByRange(4 * ranges, "o").groupBy(F.spark_partition_id().alias("p")).agg(F.min("o").alias("o"), F.sum("bytes").alias("bytes"))
    parts = sorted(((r.o.n, r.o.m, r.o.h), r.bytes) for r in fine.collect())  # four rows for each range
    most, held, out = max(1, sum(b for _, b in parts) // ranges), None, []
    for key, size in parts:
        if held is None or held + size > most:
            out.append(key)
            held = 0
        held += size
    return out


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, tail, doc_id, text): rows dealt into ranges of descending ids, sorted, each followed by its next row.

    Ranges hold about as many bytes of text each; their first keys are found on ids, hashes and lengths alone. A range's
    first row is also sent, as tail, to the range before it (that of the first range to the last). So whole texts are
    shuffled once, and no range needs another. Rows with the same id are ordered by a hash of their text, and may fall
    into different ranges; null ids come last.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    key = F.struct(doc_id.isNull().alias("n"), F.coalesce(F.bitwise_not(doc_id), F.lit(0).cast("long")).alias("m"), F.xxhash64(text).alias("h"))
    thin, _ = settle(docs.select(key.alias("o"), F.octet_length(text).cast("long").alias("bytes")), "fingerprint-keys")
    total = thin.agg(F.sum("bytes").alias("b")).first().b
    if total is None:
        return docs.select(F.lit(0).alias("range"), F.lit(0).alias("tail"), doc_id.alias("doc_id"), text.alias("text"))
    # not below the session's parallelism; above MOST_RANGES ranges grow instead, and a task reads one as a stream
    starts = _bounds(thin, min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))))
    ranges = len(starts)
    bounds = F.expr("array(" + ",".join(f"named_struct('n', {str(n).lower()}, 'm', {m}L, 'h', {h}L)" for n, m, h in starts) + ")")
    # how many ranges start at or before this key: a binary search in the starts
    reached = lambda at, s: (at + s <= ranges) & (F.element_at(bounds, F.least(at + s, F.lit(ranges))) <= F.col("o"))
    steps = F.array(*(F.lit(1 << k) for k in range(ranges.bit_length(), -1, -1)))
    place = F.aggregate(steps, F.lit(0), lambda at, s: F.when(reached(at, s), at + s).otherwise(at))
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), key.alias("o")).withColumn("range", F.greatest(place, F.lit(1)) - 1)
    own = F.struct(F.col("range"), F.lit(0).alias("tail"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(ranges)).alias("range"), F.lit(1).alias("tail"))
    leads = F.element_at(bounds, F.col("range") + 1) == F.col("o")
    dealt = rows.withColumn("x", F.explode(F.when(leads, F.array(own, before)).otherwise(F.array(own)))).select("x.range", "x.tail", "doc_id", "o", "text")
    return dealt.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "tail", "o")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and their likeness to each other and to the next row.

    The next row is the one with the next lower id, after the last the first; a single row is its own next. Returns
    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). A null text is an empty
    one. Rows with one id follow one another by a hash of their texts, repeated rows stay; null ids come last. Other
    columns are ignored. Very long texts are whole in one task, with the text before. Empty table: no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: range, id, text, sketch
        out: list[tuple] = []
        for b in batches:
            for where, tail, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), (t.as_py() for t in b.column(3))):
                own = sketch(text)
                if held is not None and held[0] == where:
                    changed = edited(held[2], text)
                    other = sketch(changed)
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), held[3].to_text(), other.to_text(), likeness(held[3], other), likeness(held[3], own)))
                # a tail ends its range; repeated rows may send several equal tails, one is enough
                held = None if tail else (where, doc, text, own)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _in_order(docs, id_col, text_col).select("range", "tail", "doc_id", "text").mapInArrow(run, kind)
