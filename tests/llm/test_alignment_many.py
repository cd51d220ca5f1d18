"""Alignment of many parts at once: the transducer side by side, parts of irregular texts, work in Python for each new part."""

import cProfile
import pstats
import random
from itertools import product

import numpy as np
import public_tokenizers

from seekframe.llm import alignment as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_many_sequences_as_one_at_a_time(monkeypatch):
    rng = random.Random(8)
    tokens = [bytes(p) for n in (1, 2, 3) for p in product(b"ab", repeat=n)]

    def cut(text):
        ids, at = [], 0
        while at < len(text):
            n = rng.randrange(1, min(3, len(text) - at) + 1)
            ids.append(tokens.index(text[at : at + n]))
            at += n
        return ids

    machine = A.Transducer(tokens, tokens)
    for clear in (A.CACHE, 5):
        monkeypatch.setattr(A, "CACHE", clear)
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(200)]
        a, b = [list(map(cut, texts)) for _ in range(2)]
        stops = [np.cumsum(list(map(len, side))) for side in (a, b)]
        flat = [np.array(sum(side, [])) for side in (a, b)]
        ends_a, ends_b, links = machine.align_many(*flat, *stops, 64)
        pairs, ends = [], []
        for x, y in zip(a, b):
            ends.append(machine.align(x, y, pairs, 64))
        flags = [[k in {e[side] for e in own} for own, ids in zip(ends, (a, b)[side]) for k in range(1, len(ids) + 1)] for side in (0, 1)]
        assert [ends_a.tolist(), ends_b.tolist(), links.tolist()] == [*flags, pairs]
        wrong = flat[1].copy()
        wrong[-1] = tokens.index(bytes(195 - c for c in tokens[wrong[-1]]))
        assert machine.align_many(flat[0], wrong, *stops, 64) is None  # the last bytes differ
        assert machine.align_many(flat[0], flat[1][:-1], stops[0], np.minimum(stops[1], len(flat[1]) - 1), 64) is None  # a token is missing


def test_parts_of_irregular_texts():
    both = A.Pair(*PATHS)
    rng = random.Random(4)
    texts = [None, "", " ", "  ", "a b", "a\nb c", " a b", "a b ", "a  b c d", "a \n b", "　a b", "a\x1c b", "a  b c", "a\n", "\na", *("".join(rng.choice("ab \n ") for _ in range(12)) for _ in range(300))]
    names, codes, sizes = both.cut(texts)
    assert len(set(names)) == len(names) and set(codes.tolist()) == set(range(len(names)))
    for text, numbers in zip(texts, np.split(codes, np.cumsum(sizes)[:-1])):
        parts = [names[k] for k in numbers.tolist()]
        cuts = [k for k, c in enumerate(text or "") if c == " " and 0 < k < len(text) - 1 and not text[k - 1].isspace() and not text[k + 1].isspace()]
        assert parts == ([text[i + 1 : j] for i, j in zip([-1, *cuts], [*cuts, len(text)])] if text else [])


def test_new_parts_take_few_calls():
    """A corpus' rare words are new to a worker again and again: what Python does for each of their tokens is the cost of the job."""
    both = A.Pair(*PATHS)
    rng = random.Random(6)
    words = lambda n: list({"".join(rng.choice("etaoinshrdlu") for _ in range(14)) for _ in range(n)})
    both.learn(words(2000))  # most steps are known then
    new = words(4000)
    profile = cProfile.Profile()
    profile.runcall(both.learn, new)
    assert pstats.Stats(profile).total_calls < 20 * len(new)
