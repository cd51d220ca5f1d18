"""Filter interaction audit: what five filters remove, together and in every order, from one pass over all words."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, settle

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: The filters' conditions, fixed by the contract: least words, least percent of distinct words, most percent of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
SPACE, CAPITAL, MARK = r"[\x20\x09-\x0D]+", r"[A-Z]", r"[#$%&*|]"
#: Bytes of text whose words one task counts, about, and most such parts; beyond these parts grow instead.
PART_BYTES, MOST_PARTS = 8 << 20, 1 << 15


def _hashes(text: Column) -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(31), text).alias("h2")]


def word_counts(texts: DataFrame, parts: int) -> DataFrame:
    """(h1, h2, words, different) for every different text of texts(h1, h2, text).

    Texts are shuffled once, by their hashes and the partition they come from, so that copies of one text stay spread.
    Words are exploded there, counted by (text, word) and then by text: that needs no shuffle of words. Every text also
    has one empty word for each of its copies, which counts them, and stands for texts without words.
    """
    key = ["h1", "h2", "origin"]
    dealt = texts.withColumn("origin", F.spark_partition_id()).repartition(parts, *key)
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    each = dealt.select(*key, F.explode(F.concat(words, F.array(F.lit("")))).alias("word"))
    by_word = each.groupBy(*key, "word").agg(F.count(F.lit(1)).alias("n"))
    copies = F.sum(F.when(F.col("word") == "", F.col("n")))
    total, different = F.sum(F.when(F.col("word") != "", F.col("n")).otherwise(0)), F.count_if(F.col("word") != "")
    by_part = by_word.groupBy(*key).agg((total / copies).cast("long").alias("words"), different.alias("different"))
    return by_part.groupBy("h1", "h2").agg(F.max("words").alias("words"), F.max("different").alias("different"))


def flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, fails, rows): which filters every document fails, as bits A = 1 to E = 16; equal rows are counted.

    A: fewer than 200 words; B: under half of the words are different; C: over 3 % capitals A-Z; D: any of #$%&*|; E: a
    smaller id has the same text. A null text is empty, a null part is the empty string. Null ids come after all others:
    they fail E if any row with an id has their text, and never make another fail. Rows that share an id don't make
    each other fail E. Very long texts count whole. Empty table: no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    whole = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    capitals = 100 * F.regexp_count("text", F.lit(CAPITAL)).cast("long") > MOST_CAPITALS * F.char_length("text").cast("long")
    marks = F.col("text").rlike(MARK)
    own = F.when(capitals, 4).otherwise(0) + F.when(marks, 8).otherwise(0)
    thin = whole.select("doc_id", "part", *_hashes(F.col("text")), own.alias("own"), F.octet_length("text").cast("long").alias("bytes"))
    keys = ["doc_id", "part", "h1", "h2", "own", "bytes"]
    rows, _ = settle(thin.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "audit-rows")

    size = rows.agg(F.sum(F.col("bytes") * F.col("rows")).alias("bytes")).first().bytes or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, -(-size // PART_BYTES)))
    counts = word_counts(whole.select(*_hashes(F.col("text")), "text"), parts)
    firsts = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"))
    texts = firsts.join(counts, ["h1", "h2"], "left").select(fresh("h1").alias("t1"), fresh("h2").alias("t2"), "first", "words", "different")
    # copies of one text may be a third of all rows: their side of the join has an exchange of its own, which can be split
    met = rows.select("doc_id", "part", "own", "rows", "h1", "h2").join(texts, (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2")), "left")
    words, different = F.coalesce("words", F.lit(0)), F.coalesce("different", F.lit(0))
    few = F.when(words < LEAST_WORDS, 1).otherwise(0)
    repeated = F.when(100 * different < LEAST_DISTINCT * words, 2).otherwise(0)
    copied = F.when(F.when(F.col("doc_id").isNull(), F.col("first").isNotNull()).otherwise(F.col("doc_id") > F.col("first")), 16).otherwise(0)
    return met.select("doc_id", "part", (few + repeated + F.col("own") + copied).alias("fails"), "rows")


def sets(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, all, good, toxic): for each part three arrays of 32 counts, one for each set of failed filters.

    labels(doc_id, quality, toxic): a document is good or toxic if any of its labels says so; without one it is neither.
    """
    known = labels.where("doc_id is not null").groupBy(fresh(F.col("doc_id").cast("long")).alias("labelled"))
    known = known.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    met = marked.join(known, F.col("doc_id") == F.col("labelled"), "left")
    met = met.select("part", "fails", "rows", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("bad", F.lit(False)).alias("toxic"))
    counts = met.groupBy("part", "fails", "good", "toxic").agg(F.sum("rows").alias("rows"))  # few rows for each part
    of = {"all": "true", "good": "good", "toxic": "toxic"}
    wide = counts.groupBy("part").agg(*(F.expr(f"sum(CASE WHEN fails = {m} AND {which} THEN rows ELSE 0L END) AS {n}{m}") for n, which in of.items() for m in range(SETS)))
    return wide.select("part", *(F.array(*(f"{n}{m}" for m in range(SETS))).alias(n) for n in of))


def _total(counts: str, holds: Column) -> Column:
    """The sum of those of the 32 counts whose set, as ``m``, satisfies a condition."""
    chosen = F.transform(F.col(counts), lambda n, m: F.when(holds(m), n).otherwise(F.lit(0).cast("long")))
    return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, n: a + n)


def report(counted: DataFrame) -> DataFrame:
    """600 rows for each part: every order of the filters, and every step of it, from the 32 counts of failed sets.

    A document is removed by the first filter of the order that it fails. shapley: a filter comes first among the k
    that a document fails in one k-th of the 120 orders.
    """
    every = ["".join(p) for p in permutations(FILTERS)]
    rows = counted.withColumn("filter_order", F.explode(F.split(F.lit(",".join(every)), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    # the bits of the step's own filter, and of those before it
    bits = lambda letters: F.aggregate(F.split(letters, ""), F.lit(0), lambda a, x: a + F.when(x == "", 0).otherwise(F.pow(F.lit(2), F.ascii(x) - ord(FILTERS[0])).cast("int")))
    rows = rows.withColumns({"bit": bits(F.substr("filter_order", F.col("step"), F.lit(1))), "before": bits(F.substr("filter_order", F.lit(1), F.col("step") - 1))})
    bit, before = F.col("bit"), F.col("before")
    has = lambda m, bits: m.bitwiseAND(bits) != 0
    share = F.transform(F.col("all"), lambda n, m: F.when(has(m, bit), n * F.lit(len(every)) / F.bit_count(m)).otherwise(F.lit(0.0)).cast("long"))
    removed = lambda m: has(m, bit) & ~has(m, before)
    return rows.select(
        "part", "filter_order", "step",
        _total("all", lambda m: ~has(m, before.bitwiseOR(bit))).alias("kept"), _total("all", removed).alias("removed"),
        _total("all", lambda m: has(m, bit) & has(m, before)).alias("redundant"), _total("all", lambda m: m == bit).alias("unique_fails"),
        _total("good", removed).alias("good_lost"), _total("toxic", removed).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("long"), lambda a, n: a + n).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The report of all documents, by part; repeated rows count as often as they come. Empty table: no rows."""
    counted, _ = settle(sets(flags(docs, id_col, text_col, part_col), labels), "audit-sets")
    return report(counted)


def oracle() -> str:
    """The audit in DuckDB's SQL, over documents and labels."""
    letters = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(FILTERS))
    order = " || ".join(f"{x}.l" for x in "pqrst")
    joins = " ".join(f"JOIN letters {x} ON {' AND '.join(f'{x}.l <> {y}.l' for y in 'pqrst'[:i])}" for i, x in enumerate("pqrst") if i)
    return f"""
WITH letters(l, b) AS (VALUES {letters}),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda w: w <> '') AS w FROM documents),
firsts AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first FROM documents GROUP BY 1),
failed AS (
  SELECT doc_id, part, (len(w) < {LEAST_WORDS})::INT + 2 * (100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(text))::INT
    + 8 * regexp_matches(text, '{MARK}')::INT + 16 * coalesce(doc_id > first, first IS NOT NULL)::INT AS fails
  FROM texts JOIN firsts USING (text)),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
counted AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, fails),
orders AS (SELECT {order} AS o FROM letters p {joins}),
steps AS (SELECT o AS filter_order, k::INT AS step, b AS bit, coalesce((SELECT sum(x.b) FROM letters x WHERE strpos(substr(o, 1, k - 1), x.l) > 0), 0)::INT AS before
  FROM orders, range(1, 6) r(k) JOIN letters ON l = substr(o, k, 1))
SELECT part, filter_order, step,
  sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN fails & bit <> 0 AND fails & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails & bit <> 0 AND fails & before = 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN fails & bit <> 0 THEN n * 120 // bit_count(fails) ELSE 0 END)::BIGINT AS shapley
FROM counted, steps GROUP BY part, filter_order, step"""
