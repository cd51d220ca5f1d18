"""English stems by Porter's published algorithm (1980), for whole token arrays in Arrow batches."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffix rules of steps 2, 3 and 4 of the published algorithm, in its order.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(word: str) -> str:
    """c for each consonant, v for each vowel; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(word):
        out += "v" if ch in "aeiou" or ch == "y" and i and out[-1] == "c" else "c"
    return out


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short(word: str) -> bool:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, endings) -> str | None:
    return max((e for e in endings if word.endswith(e)), key=len, default=None)


@lru_cache(100_000)
def porter(word: str) -> str:
    """The stem of a lower-case word; words of one or two letters, or with other letters than a-z, stay as they are."""
    if len(word) < 3 or not (word.isascii() and word.isalpha()):
        return word
    for ending, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(ending):
            word = word[: len(word) - len(ending)] + new
            break
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for ending in ("ed", "ing"):
            stem = word[: len(word) - len(ending)]
            if word.endswith(ending) and "v" in _shape(stem):
                word = stem
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif _double(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for rules in (dict(STEP2), dict(STEP3)):
        ending = _longest(word, rules)
        if ending and _measure(word[: len(word) - len(ending)]) > 0:
            word = word[: len(word) - len(ending)] + rules[ending]
    ending = _longest(word, STEP4)
    if ending:
        stem = word[: len(word) - len(ending)]
        if _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or _measure(stem) == 1 and not _short(stem):
            word = stem
    return word[:-1] if _measure(word) > 1 and word.endswith("ll") else word


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(tokens: pd.Series) -> pd.Series:
    """Stems of token arrays, in order."""
    return tokens.map(lambda ts: None if ts is None else [porter(t) for t in ts])
