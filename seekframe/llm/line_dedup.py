"""Line dedup: hashes of lines dealt by ranges and sorted by document and position; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import BROADCAST_BYTES, BROADCAST_ROWS, fresh, settle

#: White space that a line's key lacks at both ends: space and x09 to x0D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 10
#: Lines in one range of hashes, about; most ranges, above which they grow; and lines of the sample, for each range, in
#: which hashes that need ranges of their own are found. The sample steers the balance of ranges alone.
RANGE_LINES, MOST_RANGES, SAMPLE_LINES = 1 << 19, 1 << 14, 512
WORD = 64


def _hashes(c: Column, *names: str) -> list[Column]:
    """128 bits that name a string."""
    return [F.xxhash64(c).alias(names[0]), F.xxhash64(F.lit(17), c).alias(names[1])]


def keys(text: Column) -> Column:
    """The keys of a text's lines, in order: A-Z lower-cased, no white space at both ends."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n"), lambda x: F.trim(x, F.lit(BLANKS)))


def lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, doc_id, t1, t2, pos, src) of docs(doc_id, text): the hashed keys of at least so many code points."""
    each = docs.select("doc_id", *_hashes(F.col("text"), "t1", "t2"), F.spark_partition_id().alias("src"), F.posexplode(keys(F.col("text"))).alias("pos", "key"))
    return each.where(F.char_length("key") >= least_chars).select(*_hashes(F.col("key"), "h1", "h2"), "doc_id", "t1", "t2", "pos", "src")


def _hot(every: DataFrame, total: int, ranges: int) -> DataFrame:
    """(hot1, hot2, base, k, first): hashes with more lines than a range holds, their own ranges, and their first document.

    At most twice as many hashes as ranges are hot, so the table may be broadcast. First documents come from all rows.
    """
    spark = every.sparkSession
    drawn = F.pmod(F.xxhash64("h1", "doc_id", "pos", "src", F.lit(5)), F.lit(1 << 30)) < min(1.0, ranges * SAMPLE_LINES / max(1, total)) * (1 << 30)
    sample = every.where(drawn)
    counts = sample.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SAMPLE_LINES // 2).collect()
    found, base = [], ranges
    for r in sorted(counts):
        k = -(-r.n // (SAMPLE_LINES // 2))
        found.append((r.h1, r.h2, base, k))
        base += k
    hot = F.broadcast(spark.createDataFrame(found, "hot1 long, hot2 long, base int, k int"))
    first = every.join(hot, (F.col("h1") == F.col("hot1")) & (F.col("h2") == F.col("hot2"))).groupBy("hot1", "hot2", "base", "k").agg(F.min("doc_id").alias("first"))
    return first


def dropped(every: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, pos) of the lines that a smaller document has too, from lines().

    Hashes are dealt into ranges of equal width; those with very many lines get several ranges of their own. A range is
    sorted by hash, document and position, and streamed: the first row of a hash names the document that keeps its
    lines. For hashes in several ranges that document is the least of theirs.
    """
    spark = every.sparkSession
    total = every.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_RANGES, -(-total // RANGE_LINES)))
    hot, _ = settle(_hot(every, total, ranges), "lines-hot")
    most = hot.agg(F.max(F.col("base") + F.col("k")).alias("n")).first().n or ranges
    met = every.join(F.broadcast(hot), (F.col("h1") == F.col("hot1")) & (F.col("h2") == F.col("hot2")), "left")
    cold = F.shiftright((F.shiftright("h1", 32) + F.lit(1 << 31)) * F.lit(ranges), 32).cast("int")
    split = F.col("base") + F.pmod(F.xxhash64("doc_id", "pos", "src"), F.col("k")).cast("int")
    dealt = met.select(F.coalesce(split, cold).alias("range"), "h1", "h2", "doc_id", "pos", "t1", "t2", "first", F.col("base").isNotNull().alias("hot"))
    order = ["range", "h1", "h2", F.col("doc_id").asc_nulls_last(), "pos"]
    sorted_ = dealt.repartitionById(most, F.col("range")).sortWithinPartitions(*order)
    so_far = Window.partitionBy("range", "h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = sorted_.withColumn("least", F.first("doc_id").over(so_far))
    keeper = F.when(F.col("hot"), F.col("first")).otherwise(F.col("least"))
    later = F.when(F.col("doc_id").isNull(), keeper.isNotNull()).otherwise(F.col("doc_id") > keeper)
    return streamed.where(later).select("doc_id", "t1", "t2", "pos")


def bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, t1, t2, keep): the keep bitmap of every document that loses a line; t1 and t2 name its text.

    keep: array of (at, bits) in order; bit i of the word at stands for line 64 * at + i, set if the line stays. Words that keep
    all their lines are left out. Rows that share an id are one document to the others: they lose nothing to each
    other. Null ids come after all others. Repeated rows have one bitmap. Empty table: no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    every, _ = settle(lines(rows, least_chars), "lines-all")
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = dropped(every).groupBy("doc_id", "t1", "t2", F.floor(F.col("pos") / WORD).cast("int").alias("at")).agg(F.bit_or(bit).alias("gone"))
    kept = F.struct("at", F.bitwise_not("gone").alias("bits"))
    return words.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_list(kept)).alias("keep"))


def apply(lines_: Column, keep: Column) -> Column:
    """Those of a text's lines that its bitmap keeps, in one pass over both."""
    before = F.concat(F.array(F.lit(-1)), F.transform(keep, lambda w: w["at"]))
    dense = F.flatten(F.zip_with(keep, F.slice(before, F.lit(1), F.size(keep)), lambda w, b: F.concat(F.array_repeat(F.lit(-1).cast("long"), w["at"] - b - 1), F.array(w["bits"]))))
    # words after the last one of a bitmap keep all
    bits = lambda d, i: F.coalesce(F.get(d, F.floor(i / WORD).cast("int")), F.lit(-1).cast("long"))
    # an array of one element makes the dense words once, not once for each line
    return F.flatten(F.transform(F.array(dense), lambda d: F.filter(lines_, lambda x, i: F.getbit(bits(d, i), i % WORD) == 1)))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for every row: lines whose key a smaller document has too are gone.

    Lines are what stands between line breaks; a null or empty text is one empty line. All lines of a key of at least
    ``least_chars`` code points stay in the document with the smallest id that has it, and go from all others. Rows that share an
    id are one document; null ids come after all others. Repeated rows stay repeated; other columns are ignored. Very
    long texts are whole. Empty table: no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", *_hashes(F.col("text"), "t1", "t2"))
    found, _ = settle(bitmaps(docs, id_col, text_col, least_chars).select(F.col("doc_id").alias("of"), fresh("t1").alias("of1"), fresh("t2").alias("of2"), "keep"), "lines-keep")
    n = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("keep")), F.lit(0)).alias("words")).first()
    found = F.broadcast(found) if n.n <= BROADCAST_ROWS and 16 * n.words <= BROADCAST_BYTES else found.hint("shuffle_hash")
    met = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("t1") == F.col("of1")) & (F.col("t2") == F.col("of2")), "left")
    split = F.split("text", "\n")
    done = met.select("doc_id", "text", F.size(split).cast("long").alias("n_lines"), F.when(F.col("keep").isNotNull(), apply(split, F.col("keep"))).alias("kept"))
    return done.select("doc_id", F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"), "n_lines", F.when(F.col("kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"))


def oracle(least_chars: int = LEAST_CHARS) -> str:
    """The same in DuckDB's SQL, over documents."""
    key = f"trim(translate(line, '{UPPER}', '{LOWER}'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    return f"""
WITH rows_ AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
each AS (SELECT doc_id, r, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM rows_),
keyed AS (SELECT doc_id, r, pos, line, {key} AS key FROM each),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {least_chars} GROUP BY key),
marked AS (SELECT r, pos, line, coalesce(k.doc_id > f.first, k.doc_id IS NULL AND f.first IS NOT NULL) AS gone FROM keyed k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= {least_chars}),
kept AS (SELECT r, count(*) AS n_lines, count_if(gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY r)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(text) AS kept_sha256 FROM rows_ JOIN kept USING (r)"""
