"""License scans by diagonal voting; DataFrame functions only.

All rolling word k-gram hashes of the documents are joined to the positions of the same k-grams in templates. Matches on
one diagonal (position in the document less position in the template) vote for a copy of the template that begins there.
Neighbouring diagonals are merged, so that inserted or dropped words don't split a copy: those within an eighth of the
template's length of the one around which most votes lie. Spans are verified: of the template's k-grams a share must
stand in them in the template's order, and so none is longer than five fourths of the template.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import settle
from seekframe.llm.license_texts import TEXTS

K = 2
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The phrases and labels of the scan.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Notices by which a document states its license, in the words of the public notices.
NOTICES = {
    "gpl-3.0": ["this work is licensed under the gnu general public license version 3", "either version 3 of the license or at your option any later version"],
    "gpl-2.0": ["licensed under the gnu general public license version 2", "either version 2 of the license or at your option any later version"],
    "apache-2.0": ["licensed under the apache license version 2 0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"],
    "cc-by-4.0": ["licensed under cc by 4 0", "licensed under a creative commons attribution 4 0 international license"],
    "cc-by-sa-4.0": ["licensed under cc by sa 4 0", "licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc-by-nc-4.0": ["licensed under cc by nc 4 0", "licensed under a creative commons attribution noncommercial 4 0 international license"],
    "mit-notice": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "public-domain": ["this work has been dedicated to the public domain"],
    "all-rights-reserved": ["all rights reserved"],
}

# Words too common to vote; a k-gram of nothing else is left out of a notice's positions.
COMMON = frozenset("a an and any are at be by for from has in is it may no not of on or other that the this to under was will with you your".split())


#: Stands for a hash in the row that each text has for itself, matched or not.
OWN = -0x5EEC_F4A3_0000_0001
#: Diagonals are counted in units of which this many are the reach of a template; a power of two, as all reaches are.
UNITS = 64
SHARE = 0.75


@dataclass(frozen=True)
class Template:
    """A text to find. exact: its words must stand consecutively; else a share of its k-grams in their order will do."""

    label: str
    words: tuple[str, ...]
    exact: bool

    def grams(self) -> list[tuple[int, tuple[str, ...]]]:
        found = [(i, self.words[i : i + K]) for i in range(len(self.words) - K + 1)]
        return found if self.exact else [g for g in found if not COMMON.issuperset(g[1])]

    @property
    def reach(self) -> int:
        """How far diagonals of one copy may lie from its main one: the largest power of two up to an eighth of the length."""
        eighth = min(len(self.words) // 8, UNITS)
        return 1 << eighth.bit_length() - 1 if eighth else 0

    @property
    def unit(self) -> int:
        return UNITS // self.reach if self.reach else 2 * UNITS


def split_words(text: str) -> tuple[str, ...]:
    """Words as of ``words``, of a template."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return tuple(w for w in re.split(SEPARATOR, lowered) if w)


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, list[str]] = NOTICES, texts: dict[str, str] = TEXTS) -> list[Template]:
    out = [Template(label, split_words(text), True) for text, label in phrases.items()]
    out += [Template(label, split_words(text), False) for label, all_ in notices.items() for text in all_]
    return out + [Template(label, split_words(text), False) for label, text in texts.items()]


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at all ASCII characters but digits and lower-case letters."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lowered, SEPARATOR), lambda w: w != "")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: list[Template] | None = None, share: float = SHARE) -> DataFrame:
    """(doc_id, h, n_words, rows, template, label, exact, start, end, share): verified spans, and one row for each text.

    h: a hash of the text, which tells rows with the same id apart; rows: how many rows have this id and text. For an
    exact template a span is one place. For another it begins with the first and ends with the last k-gram that
    stands in order, and share is how many of the voting k-grams do. The row for the text as such has template -1 and
    no label. Templates may have any length.

    Texts are split and hashed once; what is written, and then shuffled, are k-grams that some template has, never texts.
    """
    every = templates() if every is None else every
    spark = docs.sparkSession
    # the templates are parameters; their k-grams, a few hundred, are all that is broadcast
    about = spark.createDataFrame([(n, x.label, x.exact, len(x.grams()), len(x.words), x.reach, x.unit) for n, x in enumerate(every)], "of int, label string, exact boolean, due int, length int, reach int, unit int")
    grams = spark.createDataFrame([(t, n, list(gram)) for n, x in enumerate(every) for t, gram in x.grams()], "t int, template int, gram array<string>")
    grams = grams.select(F.xxhash64(*(F.col("gram")[i] for i in range(K))).alias("g"), "t", "template")
    own = spark.createDataFrame([(OWN, 0, -1)], "g long, t int, template int")
    known = sorted({r.g for r in grams.select("g").collect()})

    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), words(F.col(text_col)).alias("w"))
    rolled = F.transform("w", lambda x, i: F.struct(i.alias("at"), F.xxhash64(x, *(F.get("w", i + j) for j in range(1, K))).alias("g")))
    hits = F.filter(rolled, lambda x: (x["at"] <= F.size("w") - K) & x["g"].isin(known))
    hits = F.concat(hits, F.array(F.struct(F.lit(0).alias("at"), F.lit(OWN).alias("g"))))
    met = split.select("doc_id", "h", F.size("w").alias("n_words"), F.explode(hits).alias("x")).select("doc_id", "h", "n_words", F.col("x.at").alias("at"), F.col("x.g").alias("g"))
    votes, _ = settle(met.join(F.broadcast(grams.union(own)), "g").select("doc_id", "h", "n_words", "template", "t", "at"), "license-votes")

    keys = ["doc_id", "h", "template"]
    whole = votes.where("template < 0").groupBy("doc_id", "h", "n_words").agg(F.count(F.lit(1)).alias("rows"))
    # repeated rows vote for the same places, so distinct positions of the template are counted
    diagonals = votes.where("template >= 0").groupBy("doc_id", "h", "n_words", "template", (F.col("at") - F.col("t")).alias("d")).agg(F.collect_set("t").alias("ts"))
    diagonals = diagonals.join(F.broadcast(about), F.col("template") == F.col("of")).withColumn("n", F.size("ts"))
    places = diagonals.where(F.col("exact") & (F.col("n") == F.col("due")))

    scaled = Window.partitionBy(*keys).orderBy("place")
    around = scaled.rangeBetween(-UNITS, UNITS)
    merged = diagonals.where(~F.col("exact")).withColumn("place", F.col("d").cast("long") * F.col("unit"))
    merged = merged.withColumn("near", F.sum("n").over(around)).withColumn("offer", F.when(F.col("near") >= F.col("due") * share, F.struct("near", (-F.col("d")).alias("back"))))
    merged = merged.withColumn("main", F.when(F.col("offer") == F.max("offer").over(around), F.col("d")))
    below = F.last("main", ignorenulls=True).over(scaled.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first("main", ignorenulls=True).over(scaled.rowsBetween(0, Window.unboundedFollowing))
    merged = merged.withColumns({"below": below, "above": above})
    nearest = F.when(F.col("above").isNull() | (F.col("d") - F.col("below") <= F.col("above") - F.col("d")), F.col("below")).otherwise(F.col("above"))
    merged = merged.withColumn("main", nearest).where(F.abs(F.col("d") - F.col("main")) <= F.col("reach"))
    # of each k-gram the match nearest to the main diagonal; those behind all before them are in order
    copy = ["doc_id", "h", "n_words", "template", "label", "exact", "due", "main"]
    picked = merged.select(*copy, "d", F.explode("ts").alias("t")).groupBy(*copy, "t").agg(F.min(F.struct(F.abs(F.col("d") - F.col("main")).alias("off"), "d")).alias("x"))
    picked = picked.withColumn("at", F.col("t") + F.col("x.d"))
    before = F.max("at").over(Window.partitionBy("doc_id", "h", "template", "main").orderBy("t").rowsBetween(Window.unboundedPreceding, -1))
    ordered = picked.withColumn("in_order", before.isNull() | (F.col("at") > before)).where("in_order")
    runs = ordered.groupBy(*copy).agg(F.min("at").alias("start"), (F.max("at") + K).alias("end"), (F.count(F.lit(1)) / F.first("due")).alias("share")).where(F.col("share") >= share)

    none = F.lit(None)
    return (
        places.select("doc_id", "h", "n_words", none.cast("long").alias("rows"), "template", "label", "exact", F.col("d").alias("start"), (F.col("d") + F.col("length")).alias("end"), F.lit(1.0).alias("share"))
        .union(runs.select("doc_id", "h", "n_words", none.cast("long").alias("rows"), "template", "label", "exact", "start", "end", "share"))
        .union(whole.select("doc_id", "h", "n_words", "rows", F.lit(-1).alias("template"), none.cast("string").alias("label"), F.lit(True).alias("exact"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(1.0).alias("share")))
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: list[Template] | None = None, share: float = SHARE) -> DataFrame:
    """One row for every row of docs: (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    n_base: places where a phrase's words stand consecutively; first_word, last_word: the smallest and largest of
    their starts (null if none). base_labels: the phrases' labels; labels: these and those of notices and license texts.
    score: 1 if a phrase is there, else the largest share of a notice or text that is (0 if none). Null and empty texts
    have 0 words and no labels. Very long texts are scanned whole. Repeated rows stay; other columns are ignored; rows
    with one id and different texts are kept apart. Empty table: no rows.
    """
    found = spans(docs, id_col, text_col, every, share)
    base = F.col("exact") & (F.col("template") >= 0)
    join = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  labels are few: one for each template at most
    each = found.groupBy("doc_id", "h").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.max("rows").alias("rows"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        join(F.when(base, F.col("label"))).alias("base_labels"),
        join("label").alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") >= 0, F.col("share"))), F.lit(0.0)).alias("score"),
    )
    out = each.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle(share: float = SHARE) -> str:
    """The scan in DuckDB's SQL, over documents: the same votes, from words instead of hashes."""
    rows = [(n, x.label, x.exact, len(x.grams()), x.reach, x.unit, t, *gram) for n, x in enumerate(templates()) for t, gram in x.grams()]
    values = ", ".join(f"({n}, '{label}', {str(exact).lower()}, {due}, {reach}, {unit}, {t}, '{a}', '{b}')" for n, label, exact, due, reach, unit, t, a, b in rows)
    around = f"PARTITION BY r, template ORDER BY d * unit RANGE BETWEEN {UNITS} PRECEDING AND {UNITS} FOLLOWING"
    return f"""
WITH grams(template, label, exact, due, reach, unit, t, a, b) AS (VALUES {values}),
texts AS (
  SELECT doc_id, row_number() OVER () AS r,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
single AS (SELECT r, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS pos FROM texts),
pairs AS (SELECT r, pos, a, lead(a) OVER (PARTITION BY r ORDER BY pos) AS b FROM single),
votes AS (
  SELECT r, template, label, exact, due, reach, unit, pos - t AS d, count(*)::BIGINT AS n, list(t) AS ts FROM pairs JOIN grams USING (a, b) GROUP BY ALL),
near AS (SELECT *, sum(n) OVER ({around}) AS near FROM votes WHERE NOT exact),
best AS (SELECT *, max(CASE WHEN near >= due * {share} THEN near * 1000000000 - d END) OVER ({around}) AS best FROM near),
mains AS (SELECT *, CASE WHEN near >= due * {share} AND near * 1000000000 - d = best THEN d END AS m FROM best),
sides AS (
  SELECT *, max(m) OVER (PARTITION BY r, template ORDER BY d ROWS UNBOUNDED PRECEDING) AS below,
    min(m) OVER (PARTITION BY r, template ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM mains),
owned AS (
  SELECT r, template, label, due, reach, d, ts, CASE WHEN above IS NULL OR d - below <= above - d THEN below ELSE above END AS main FROM sides),
picked AS (
  SELECT r, template, label, due, main, t, t + arg_min(d, abs(d - main) * 1000000000 + d) AS place
  FROM (SELECT *, unnest(ts) AS t FROM owned WHERE abs(d - main) <= reach) GROUP BY r, template, label, due, main, t),
steps AS (SELECT *, max(place) OVER (PARTITION BY r, template, main ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM picked),
runs AS (
  SELECT r, template, label, main, count(*) / any_value(due)::DOUBLE AS share FROM steps WHERE before IS NULL OR place > before GROUP BY r, template, label, main
  HAVING count(*) / any_value(due)::DOUBLE >= {share}),
found AS (
  SELECT r, label, true AS base, d, 1.0::DOUBLE AS share FROM votes WHERE exact AND n = due
  UNION ALL SELECT r, label, false, NULL, share FROM runs),
each AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(d) FILTER (base) AS first_word, max(d) FILTER (base) AS last_word,
    coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score
  FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN each USING (r)"""
