"""The text index: token postings that are written with the items, and searched instead of them.

Postings (token, id, field, tf, level, positions) are made once, when items are indexed: each text's tokens are counted
where it is read, so nothing but postings is shuffled, in blocks of those that a slice of the texts has of one token and
tf. Blocks are dealt by ranges of tokens and sorted by token, level (the bits of tf, high ones first) and their first id,
and are written as rows; so a query's tokens and prefixes prune files and pages, a ranked query can stop after the
high levels, and a token that every item has fills many files. A row with an empty token stands for each text, with its
length and number of distinct tokens.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions import text as X
from seekframe.functions.snowball import STEMMERS
from seekframe.functions.stem import porter
from seekframe.plans import keys as K
from seekframe.plans.model import IndexSpec, SpecError
from seekframe.plans.query import CONFIGS

#: Items, about, in whose texts the bounds of token ranges are found; they steer the balance of files alone.
SAMPLE = 2000
#: Tokens that are counted at once, about.
SLICE = 1 << 19
#: Postings of one block, at most, and tokens of one range, about: what a task sorts doesn't grow with the table.
BLOCK, RANGE = 4096, 1 << 22
#: Distinct words whose stems a task remembers; nothing else remembers them there.
STEMS = 1 << 16
#: Stems by text configuration, and the configuration of each language that the configuration "language" goes by.
STEMS_OF: dict[str, Callable[[str], str]] = {"english": porter.__wrapped__, **STEMMERS}
OF_LANGUAGE = {"en": "english", "de": "german", "es": "spanish", "fr": "french"}


@dataclass(frozen=True)
class TextIndex:
    """Postings and lengths of one index, under one text configuration."""

    postings: DataFrame
    lengths: DataFrame
    config: str = "simple"
    tokenised: DataFrame | None = None


def _texts(items: DataFrame, index: IndexSpec, config: str) -> DataFrame:
    """(id, field, text, lang): a row for each searchable field that holds anything."""
    if not index.searchable:
        raise SpecError(f"{index.name} has no searchable field")
    each = [F.struct(F.lit(n).alias("field"), (F.array_join(F.col(n), " ") if index.field(n).multi_value else F.col(n).cast("string")).alias("text")) for n in index.searchable]
    lang = F.col(index.language_col).cast("string") if config == "language" else F.lit(None).cast("string")
    return items.select(F.col(index.id_col).alias("id"), F.explode(F.array(*each)).alias("x"), lang.alias("lang")).select("id", "x.field", "x.text", "lang").where("text is not null")


def _tokenised(items: DataFrame, index: IndexSpec, config: str) -> DataFrame:
    return _texts(items, index, config).select("id", "field", X.tokens(F.col("text")).alias("toks"), "lang")


def _stemmer(config: str) -> Callable[[str, str | None], str] | None:
    """Stems by word and, if the configuration goes by it, language; words of languages without stems stay."""
    if config == "simple":
        return None
    known: dict[tuple[str, str | None], str] = {}

    def stem(word: str, lang: str | None) -> str:
        if (found := known.get((word, lang))) is None:
            if len(known) >= STEMS:
                known.clear()
            by = STEMS_OF.get(OF_LANGUAGE.get(lang or "", "") if config == "language" else config)
            found = known[word, lang] = by(word) if by else word
        return found

    return stem


def _fold(toks: pa.ListArray, langs: pa.Array, stem: Callable[[str, str | None], str] | None) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.ListArray, np.ndarray, np.ndarray]:
    """(token, row, tf, positions) of every different token of each row; and each row's length and distinct tokens."""
    coded = toks.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(toks.offsets.to_numpy()).astype(np.int64)
    row = np.repeat(np.arange(len(toks)), lengths)
    if stem is not None and len(codes):
        spoken = langs.fill_null("").dictionary_encode()
        both, inverse = np.unique(spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * len(words) + codes, return_inverse=True)
        names, plain = spoken.dictionary.to_pylist(), words.to_pylist()
        again = pa.array([stem(plain[k % len(plain)], names[k // len(plain)]) for k in both.tolist()], pa.string()).dictionary_encode()
        words, codes = again.dictionary, again.indices.to_numpy(zero_copy_only=False).astype(np.int64)[inverse]
    key = row * max(1, len(words)) + codes
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.nonzero(np.append(True, key[1:] != key[:-1]))[0] if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(starts, len(key)))
    places = (np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row])[order].astype(np.int32)
    positions = pa.ListArray.from_arrays(pa.array(np.append(starts, len(key)), pa.int32()), pa.array(places))
    first = order[starts]
    return words.take(pa.array(codes[first])), row[first], tf, positions, lengths, np.bincount(row[first], minlength=len(toks))


def _blocked(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Postings (range, token, id, field, tf, level, positions) as blocks of one range, token, field and tf, with all positions
    one after another."""
    key = rows["range"].to_numpy().astype(np.int64)
    for codes in (rows[n].dictionary_encode().indices.to_numpy(zero_copy_only=False) for n in ("token", "field", "tf")):
        key = key * (1 + int(codes.max(initial=0))) + codes
    order = np.argsort(key, kind="stable")
    key, rows = key[order], rows.take(pa.array(order))
    group = np.nonzero(np.append(True, key[1:] != key[:-1]))[0] if len(key) else np.zeros(0, np.int64)
    within = np.arange(len(key)) - np.repeat(group, np.diff(np.append(group, len(key))))
    starts = np.nonzero(within % BLOCK == 0)[0]
    ends, first = np.append(starts, len(key)), rows.select(["range", "token", "field", "tf", "level"]).take(pa.array(starts))
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows["id"])
    places = pa.ListArray.from_arrays(pa.array(rows["positions"].offsets.to_numpy()[ends], pa.int32()), rows["positions"].values)
    return pa.RecordBatch.from_arrays([*first.columns, ids, places], ["range", "token", "field", "tf", "level", "ids", "places"])


def _unblocked(blocks: DataFrame) -> DataFrame:
    """Blocks as rows (token, id, field, tf, level, positions), in order."""
    each = F.expr("inline(transform(ids, (id, i) -> struct(id, slice(places, i * (size(places) div size(ids)) + 1, size(places) div size(ids)) AS positions)))")
    return blocks.select("token", "field", "tf", "level", each).select("token", "id", "field", "tf", "level", "positions")


def _postings(tokenised: DataFrame, config: str, bounds: list[tuple[str, int]] | None, files: int, blocks: bool = False) -> DataFrame:
    """(range, token, id, field, tf, level, positions); a range is the number of bounds that don't follow a token. With
    ``blocks``: (range, token, field, tf, level, ids, places), a row for each block of postings.

    bounds: in order, with the number of ranges that the token of each fills by itself (0: it only begins a range).
    """
    tokens, place, wide, at = [], [0], [], 1
    for token, fills in bounds or []:  # ranges before, of, and after a token that fills some by itself
        tokens.append(token)
        wide.append(fills)
        place.append(at if not fills else at + fills)
        at = place[-1] + 1
    begin = [place[k] + (1 if w else 0) for k, w in enumerate(wide)]

    def spots(words: pa.Array, rows: np.ndarray) -> np.ndarray:
        coded = words.dictionary_encode()
        base, more = [], []
        for w in coded.dictionary.to_pylist():
            k = bisect_right(tokens, w)
            own = k and tokens[k - 1] == w and wide[k - 1]
            base.append(begin[k - 1] if own else place[k])
            more.append(own or 1)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if not len(codes):
            return np.zeros(0, np.int64)
        return np.array(base)[codes] + rows % np.array(more)[codes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stem, seen = _stemmer(config), 0
        for b in batches:
            b_toks = b.column(2)
            ends = np.cumsum(np.diff(b_toks.offsets.to_numpy()))
            at = 0
            while at < b.num_rows:
                until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
                part = b.slice(at, until - at)
                toks = pa.concat_arrays([part.column(2)])  # offsets from 0
                words, row, tf, positions, lengths, different = _fold(toks, part.column(3), stem)
                take = pa.array(row)
                everywhere = seen + np.arange(len(toks))
                rows = pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([spots(words, everywhere[row]), everywhere % max(1, files)]).astype(np.int32)), pa.concat_arrays([words, pa.array([""] * len(toks), pa.string())]),
                    pa.concat_arrays([part.column(0).take(take), part.column(0)]), pa.concat_arrays([part.column(1).take(take), part.column(1)]),
                    pa.array(np.concatenate([tf, lengths]).astype(np.int32)), pa.array(np.concatenate([np.frexp(tf)[1], np.full(len(toks), 31)]).astype(np.int32)),
                    pa.concat_arrays([positions, pa.ListArray.from_arrays(pa.array(np.arange(len(toks) + 1), pa.int32()), pa.array(different.astype(np.int32)))]),
                ], ["range", "token", "id", "field", "tf", "level", "positions"])
                yield _blocked(rows) if blocks else rows
                seen += len(toks)
                at = until

    kind = tokenised.schema["id"].dataType.simpleString()
    if blocks:
        return tokenised.mapInArrow(run, f"range int, token string, field string, tf int, level int, ids array<{kind}>, places array<int>")
    return tokenised.mapInArrow(run, f"range int, token string, id {kind}, field string, tf int, level int, positions array<int>")


def _lengths(postings: DataFrame) -> DataFrame:
    return postings.where("token = ''").select("id", "field", F.col("tf").alias("length"), F.get("positions", F.lit(0)).alias("distinct"))


def _of(postings: DataFrame, config: str, tokenised: DataFrame | None = None) -> TextIndex:
    plain = postings.drop("range")
    return TextIndex(plain.where("token <> ''"), _lengths(plain), config, tokenised)


def build(items: DataFrame, index: IndexSpec, config: str = "simple") -> TextIndex:
    """The index of items, lazily."""
    if config not in CONFIGS:
        raise SpecError(f"unknown text configuration {config!r}")
    tokenised = _tokenised(items, index, config)
    return _of(_postings(tokenised, config, None, 1), config, tokenised)


def _bounds(tokenised: DataFrame, config: str, files: int) -> tuple[list[tuple[str, int]], int]:
    """Tokens at which ranges begin, from the postings of a sample; (token, ranges that it fills by itself). And the files to
    deal postings to: as many as were asked for, or more if ranges would hold over RANGE tokens."""
    if files < 2:
        return [], files
    share = min(1.0, SAMPLE / max(1, tokenised.count()))
    drawn = tokenised.where(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1 << 30)) < share * (1 << 30))
    counts = _postings(drawn, config, None, 1).where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf")).collect()  # the words of a bounded sample
    found = sorted((r.token, r.n) for r in counts)
    files = max(files, math.ceil(sum(r.tf for r in counts) / share / RANGE))
    most, held, out = max(1, sum(n for _, n in found) / files), 0.0, []
    for token, n in found:
        if n > most:
            out.append((token, round(n / most)))
            held = 0.0
        else:
            if held + n > most:
                out.append((token, 0))
                held = 0.0
            held += n
    return out, files


def write(built: TextIndex, path: str, files: int) -> None:
    """Write an index to a folder, in place of what is there: postings by ranges of tokens, sorted; built texts are read twice,
    once for a sample of them."""
    spark = built.postings.sparkSession
    if built.tokenised is not None:
        bounds, files = _bounds(built.tokenised, built.config, files)
        rows = _postings(built.tokenised, built.config, bounds, files, blocks=True)
        ranges = 1 + sum(1 + fills for _, fills in bounds)
        dealt = rows.repartitionById(max(ranges, files), F.col("range"))
        dealt = _unblocked(dealt.sortWithinPartitions(F.col("token"), F.col("level").desc(), F.get("ids", F.lit(0))))
    else:
        texts = built.lengths.select(F.lit("").alias("token"), "id", "field", F.col("length").alias("tf"), F.lit(31).alias("level"), F.array(F.col("distinct")).alias("positions"))
        dealt = built.postings.unionByName(texts).repartitionByRange(files, "token", "id")
        dealt = dealt.sortWithinPartitions(F.col("token"), F.col("level").desc(), F.col("id"))
    dealt.write.mode("overwrite").parquet(f"{path}/postings")
    spark.createDataFrame([(json.dumps({"config": built.config}),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def read(spark: SparkSession, path: str) -> TextIndex:
    about = json.loads(spark.read.text(f"{path}/about").first().value)
    return _of(spark.read.parquet(f"{path}/postings"), about["config"])


def update(old: TextIndex, index: IndexSpec, changed: DataFrame, gone: DataFrame | None = None) -> TextIndex:
    """The index after items were upserted (whole rows of the index) or deleted (ids): only their texts are tokenised.

    Lazy, over all postings; a store (operators.store) writes changes alone.
    """
    new = build(changed, index, old.config)
    ids = changed.select(F.col(index.id_col).alias("id"))
    if gone is not None:
        ids = ids.union(gone.select(F.col(index.id_col).alias("id")))
    ids = ids.distinct()
    return TextIndex(*(a.join(ids, "id", "left_anti").select(*a.columns).unionByName(b.select(*a.columns)) for a, b in ((old.postings, new.postings), (old.lengths, new.lengths))), old.config)


def stemmed(node: K.Node | None, config: str, languages: tuple[str, ...] | None = None) -> K.Node | None:
    """A key tree with its tokens as the configuration indexes them; "language" needs the one language that is searched."""
    if config == "language":
        if languages is None or len(languages) != 1:
            raise SpecError("the configuration 'language' searches one language at a time")
        config = OF_LANGUAGE.get(languages[0], "simple")
    by = STEMS_OF.get(config)
    return K.mapped(node, by) if by is not None and node is not None else node


def _wanted(leaves: list[K.Node]) -> Column:
    """The postings that leaves ask for, as conditions that reach the scan."""
    tokens = sorted({t for leaf in leaves if not isinstance(leaf, K.Prefix) for t in (leaf.tokens if isinstance(leaf, K.Phrase) else (leaf.token,))})
    parts = [F.col("token").isin(tokens)] if tokens else []
    parts += [F.col("token").startswith(p) for p in sorted({leaf.token for leaf in leaves if isinstance(leaf, K.Prefix)})]
    return reduce(lambda a, b: a | b, parts)


def _phrase_count(places: list[Column]) -> Column:
    """How often tokens at these positions follow one another, without overlap."""
    def moved(places: Column, by: int) -> Column:
        return F.transform(F.coalesce(places, F.array().cast("array<int>")), lambda x: x - by)

    starts = reduce(F.array_intersect, [moved(p, k) for k, p in enumerate(places)])
    step = lambda acc, x: F.when(x >= acc["free"], F.struct((acc["n"] + 1).alias("n"), (x + len(places)).alias("free"))).otherwise(acc)
    return F.aggregate(F.array_sort(starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("free")), step, lambda acc: acc["n"])


def by_id(rows: DataFrame) -> DataFrame:
    """Rows dealt by their ids to all shuffle partitions. Those of a plain shuffle are joined by their compressed size, which
    ids and small counts make tiny: one task would hold all that is found, many times larger in memory."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("id"))


def find(built: TextIndex, index: IndexSpec, node: K.Node, fields: list[str] | None = None, constant: bool = False) -> DataFrame:
    """(id, text_rank) of the items that satisfy a key tree; the rank is that of functions.text, or 1 if ``constant``.

    A term, prefix or phrase is satisfied by any one of the fields. Only postings of the tree's own tokens are read.
    """
    fields = fields or index.searchable
    leaves = K.leaves(node)
    mine = built.postings.where(_wanted(leaves))
    if set(fields) != set(index.searchable):
        mine = mine.where(F.col("field").isin(fields))
    many = len(index.searchable) > 1
    counts, phrases = [], {}
    for n, leaf in enumerate(leaves):
        for f in fields:
            here = (F.col("field") == f) if many else F.lit(True)
            if isinstance(leaf, K.Phrase):
                for token in set(leaf.tokens):
                    phrases[f"{f}\n{token}"] = F.max(F.when(here & (F.col("token") == token), F.col("positions")))
            else:
                hit = F.col("token").startswith(leaf.token) if isinstance(leaf, K.Prefix) else F.col("token") == leaf.token
                counts.append(F.coalesce(F.sum(F.when(here & hit, F.col("tf"))), F.lit(0)).alias(f"{n} {f}"))
    names = {key: f"p{k}" for k, key in enumerate(phrases)}
    grouped = by_id(mine).groupBy("id").agg(*counts, *(c.alias(names[key]) for key, c in phrases.items()))
    for n, leaf in enumerate(leaves):
        if isinstance(leaf, K.Phrase):
            for f in fields:
                grouped = grouped.withColumn(f"{n} {f}", _phrase_count([F.col(names[f"{f}\n{token}"]) for token in leaf.tokens]))
    tf = {id(leaf): [F.col(f"`{n} {f}`") for f in fields] for n, leaf in enumerate(leaves)}

    def holds(part: K.Node) -> Column:
        if isinstance(part, (K.And, K.Or)):
            return reduce((lambda a, b: a & b) if isinstance(part, K.And) else (lambda a, b: a | b), map(holds, part.members))
        return reduce(lambda a, b: a | b, [c > 0 for c in tf[id(part)]])

    weights = [X.WEIGHTS[index.field(f).weight] for f in fields]
    parts = [F.lit(w) * (c.cast("double") / (c + 1)) for leaf in leaves for w, c in zip(weights, tf[id(leaf)])]
    rank = F.lit(1.0) if constant else reduce(lambda a, b: a + b, parts) / len(leaves)
    return grouped.where(holds(node)).select("id", rank.alias("text_rank"))


def vocabulary(built: TextIndex) -> DataFrame:
    """(token, n): how often each token occurs in all items."""
    return built.postings.groupBy("token").agg(F.sum("tf").alias("n"))
