"""Text as Columns: tokens, matching, rank, highlighting, normalisation and trigrams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.plans import keys as K

#: Weights of field classes A to D, as published for weighted text search.
WEIGHTS = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
MAX_TEXT = 1_000_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order; an empty array for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def _spaced(words: tuple[str, ...]) -> str:
    return "".join(f" {w} " for w in words)


def _joined(toks: Column) -> Column:
    """Tokens as one string in which each has a space of its own on either side, so that phrases are substrings."""
    return F.concat(F.lit(" "), F.array_join(toks, "  "), F.lit(" "))


def matches(toks: Column, node: K.Node) -> Column:
    """Whether the tokens satisfy a key tree."""
    if isinstance(node, K.Term):
        return F.array_contains(toks, node.token)
    if isinstance(node, K.Prefix):
        return F.exists(toks, lambda t: t.startswith(node.token))
    if isinstance(node, K.Phrase):
        return _joined(toks).contains(_spaced(node.tokens))
    if isinstance(node, K.Or) and all(isinstance(m, K.Term) for m in node.members):
        return F.arrays_overlap(toks, F.array(*(F.lit(m.token) for m in node.members)))
    join = (lambda a, b: a & b) if isinstance(node, K.And) else (lambda a, b: a | b)
    return reduce(join, [matches(toks, m) for m in node.members])


def matches_any(fields: list[Column], node: K.Node) -> Column:
    """Whether texts satisfy a key tree together: each term, prefix or phrase in any one of them."""
    if isinstance(node, (K.And, K.Or)) and len(fields) > 1:
        join = (lambda a, b: a & b) if isinstance(node, K.And) else (lambda a, b: a | b)
        return reduce(join, [matches_any(fields, m) for m in node.members])
    return reduce(lambda a, b: a | b, [matches(toks, node) for toks in fields])


def frequency(toks: Column, leaf: K.Node) -> Column:
    """How often a term, prefix or phrase occurs (phrases without overlap)."""
    if isinstance(leaf, K.Term):
        return F.size(F.filter(toks, lambda t: t == leaf.token))
    if isinstance(leaf, K.Prefix):
        return F.size(F.filter(toks, lambda t: t.startswith(leaf.token)))
    phrase = _spaced(leaf.tokens)
    text = _joined(toks)
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(phrase), F.lit("")))) / len(phrase)).cast("int")


def rank(fields: list[tuple[Column, float]], node: K.Node) -> Column:
    """Relevance in [0, 1): the sum of weight * tf / (tf + 1) over leaves and fields, by the number of leaves.

    This formula is the library's own; weights are those of the fields' classes.
    """
    found = K.leaves(node)
    parts = [F.lit(w) * (tf / (tf + 1)) for toks, w in fields for leaf in found for tf in [frequency(toks, leaf).cast("double")]]
    return reduce(lambda a, b: a + b, parts) / len(found)


def normalised(score: Column, length: Column, distinct: Column, code: int) -> Column:
    """score divided as the bits of code ask: 1 by 1 + log(length), 2 by length, 8 by distinct tokens, 16 by 1 + log
    of these, 32 by score + 1. Bit 4 (distance between matches) has no counterpart in this rank and is refused."""
    if code & 4 or code & ~59:
        raise ValueError(f"normalisation code {code} isn't supported")
    length, distinct = F.greatest(length, F.lit(1)), F.greatest(distinct, F.lit(1))
    for bit, by in ((1, 1 + F.ln(length)), (2, length), (8, distinct), (16, 1 + F.ln(distinct))):
        if code & bit:
            score = score / by
    return score / (score + 1) if code & 32 else score


def highlight(text: Column, node: K.Node, open_: str = "<strong>", close: str = "</strong>", before: int = 8, most: int = 35) -> Column:
    """Up to ``most`` words around the first match, with matching words marked; null if nothing matches."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    wanted = [(t, isinstance(leaf, K.Prefix)) for leaf in K.leaves(node) for t in (leaf.tokens if isinstance(leaf, K.Phrase) else (leaf.token,))]
    bare = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", "")
    hit = lambda w: reduce(lambda a, b: a | b, [bare(w).startswith(t) if p else bare(w) == t for t, p in wanted])
    first = F.array_min(F.transform(words, lambda w, i: F.when(hit(w), i + 1)))
    window = F.slice(words, F.greatest(first - before, F.lit(1)), F.lit(most))
    return F.when(first.isNotNull(), F.array_join(F.transform(window, lambda w: F.when(hit(w), F.concat(F.lit(open_), w, F.lit(close))).otherwise(w)), " "))


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<[^>]*>", " ")


def collapse(text: Column) -> Column:
    """Runs of ASCII white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def normalise(text: Column) -> Column:
    """Index text: no tags, no control characters, single spaces."""
    return collapse(drop_controls(strip_tags(text)))


def keep_word_lengths(text: Column, least: int = 3, most: int = 40) -> Column:
    """Only words of ``least`` to ``most`` characters, joined by spaces."""
    return F.array_join(F.filter(F.split(collapse(text), " "), lambda w: (F.char_length(w) >= least) & (F.char_length(w) <= most)), " ")


def trigrams(text: Column) -> Column:
    """Distinct three-character windows of the lower-case text, padded as in trigram indexes."""
    one = F.split(F.concat(F.lit("  "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), "")
    two = F.zip_with(one, F.slice(one, F.lit(2), F.size(one)), lambda a, b: F.concat(a, b))
    three = F.zip_with(two, F.slice(one, F.lit(3), F.size(one)), lambda a, b: F.concat(a, b))
    return F.array_distinct(F.array_compact(three))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared trigrams by all trigrams."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.try_divide(both, F.size(a) + F.size(b) - both)
