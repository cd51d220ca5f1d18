"""The pipeline's near-duplicate stage against brute force on exact shingle similarity."""

import random

import pytest

import corpus_pipeline
from seekframe.llm import shingles as J, simhash as S

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, rng, n):
    copy = list(words)
    for at in rng.sample(range(len(copy)), n):
        copy[at] = f"x{rng.randrange(10**9)}"
    return copy


def brute_kept(rows):
    sets, parent = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [r[0] for i, r in enumerate(rows) if find(i) == i]


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], KIND)
    return sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())


def pairs(seed, low, high, n, length=150):
    """n pairs of texts whose similarity is from low to under high."""
    rng, rows = random.Random(seed), []
    while len(rows) < 2 * n:
        words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        copy = edited(words, rng, rng.randrange(1, 12))
        if low <= similarity(shingles(" ".join(words)), shingles(" ".join(copy))) < high:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(copy))]
    return rows


def test_distinct_texts_are_all_kept(spark):
    """Pairs at 0.6 to just below 0.8 are no copies, though many differ in few SimHash bits."""
    rows = pairs(1, 0.6, 0.75, 60) + [(i + 1000, t) for i, t in pairs(2, 0.75, 0.8, 60)]
    assert kept(spark, rows) == [i for i, _ in rows]


def test_every_near_copy_is_found(spark):
    """Groups of two at 0.8 and just above, which no third copy can connect."""
    rows = pairs(3, 0.8, 0.84, 150)
    assert kept(spark, rows) == [i for i, _ in rows if i % 2 == 0]


@pytest.mark.parametrize("common, most, longest, block", [(5, 200_000, 64, 1024), (2, 50, 2, 1024), (10**9, 10, 2, 10)])
def test_groups_agree_with_brute_force(spark, monkeypatch, common, most, longest, block):
    """Chains, a large group of copies, short texts, and a passage that many unlike texts share; any order of shingles, and lists of any length."""
    monkeypatch.setattr(J, "LIST", longest)
    monkeypatch.setattr(J, "BLOCK_SETS", block)
    monkeypatch.setattr(J, "COMMON", common)
    monkeypatch.setattr(J, "MOST_COMMON", most)
    rng, texts = random.Random(4), []
    passage = [f"p{i}" for i in range(12)]
    base = [f"b{i}" for i in range(60)]
    texts += [edited(base, rng, rng.randrange(4)) for _ in range(80)]
    for _ in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))]
        texts.append(words + passage)
        for _ in range(3):
            words = edited(words, rng, 1)
            texts.append(words + passage)
    texts += [["a", "b"], ["A", "b"], ["a", "b", "c"], [], ["c"]] + [[f"s{i}" for i in range(n)] for n in range(4, 16)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(len(texts), None)]
    assert kept(spark, rows) == brute_kept(rows)
