"""Links and components against brute force: components, SimHash, embeddings."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekframe.llm import components as C, embedding_dedup as D, simhash as S


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], [(5, None), (3, 4)],
    [(random.Random(i).randrange(300), random.Random(i + 999).randrange(300)) for i in range(220)],
])
def test_components(spark, links):
    df = spark.createDataFrame(links, "u long, v long")
    got = sorted(map(tuple, C.components(df).collect()))
    real = [(a, b) for a, b in links if None not in (a, b) and a != b]
    assert got == sorted(brute_components({x for p in real for x in p}, real).items())


def brute_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    hashes = [S._hash(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [None, "", " \n", "a", "A b", "a B c", "a b c d", " x y\x1cz", "é É ß", " ".join(f"w{i % 7}" for i in range(500)), "x " * 300]:
        assert S.fingerprint(text) == brute_fingerprint(text), text


def brute_groups(prints, distance):
    return [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if bin(a ^ b).count("1") <= distance]


@pytest.mark.parametrize("distance, tile", [(3, 1024), (3, 3), (1, 5), (5, 1024)])
def test_links_connect_what_all_pairs_do(spark, distance, tile):
    rng = random.Random(distance * 100 + tile)
    prints = set()
    for _ in range(60):
        p = rng.getrandbits(64)
        for _ in range(5):
            prints.add(p)
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance + 1)))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame(list(zip(signed, range(len(prints)))), "fp long, rep long")
    got = {(r.u, r.v) for r in S.links(df, distance, tile).collect()}
    at = {p: i for i, p in enumerate(prints)}
    want = [(at[a], at[b]) for a, b in brute_groups(prints, distance)]
    nodes = range(len(prints))
    assert brute_components(nodes, got) == brute_components(nodes, want)


def test_count_filter_comes_before_verification(spark):
    """Of the pairs that meet under a key few share enough bytes, and of these not all are near."""
    rng = np.random.default_rng(7)
    prints = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    prints[:, None].view(np.uint8)[:, :3] = 5  # all meet under one key
    prints[1::2] = prints[::2] ^ (np.uint64(1) << rng.integers(0, 64, 1500, dtype=np.uint64)) ^ (np.uint64(0xFF) << np.uint64(8 * 5))
    need, keys = S.plan(3, len(prints))
    assert need == 5 and len(keys) == 20 and {len(k) for k in keys} == {3}
    a, b = np.triu_indices(len(prints), 1)
    differ = prints[a] ^ prints[b]
    counted = differ[S.enough_bytes(differ, need)]
    near = counted[np.bitwise_count(counted) <= 3]
    assert len(near) < len(counted) < len(differ) / 100
    assert len(near) == (np.bitwise_count(differ) <= 3).sum()  # nothing near is lost


def test_links_pass_the_count_filter(spark, monkeypatch):
    """Pairs reach verification through the filter alone: one that refuses all leaves no links."""
    df = spark.createDataFrame([(5, 1), (7, 2), (1 << 40, 3)], "fp long, rep long")
    assert S.links(df).count() == 2
    monkeypatch.setattr(S, "enough_bytes", lambda differ, need: np.zeros(len(differ), bool))
    assert S.links(df).count() == 0


def test_every_near_pair_meets_under_a_key():
    for distance in range(8):
        for prints in (10, 1 << 40):
            need, keys = S.plan(distance, prints)
            assert need == 8 - distance and len(keys[0]) <= need
            for lost in range(256):
                if lost.bit_count() <= distance:
                    assert any(not any(lost >> p & 1 for p in key) for key in keys)


def test_near_duplicates_table(spark):
    text = " ".join(f"word{i * i % 97}" for i in range(200))
    rows = [(5, text, "a"), (3, text + " end", "b"), (9, None, "c"), (8, "", "d"), (7, " ", None), (1, "else entirely here now", "e"), (1, "else entirely here now", "e"), (None, text, "f")]
    rows = [(*r, "z", 1, 2) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, _mark string, _gone int, MARK int")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()}
    prints = {(i, f"{brute_fingerprint(t):016x}") for i, t, *_ in rows}
    assert {g[:2] for g in got} == prints
    component = {g[0]: g[2] for g in got}
    assert component[9] == component[8] == component[7] == 7 and component[1] == 1
    near = bin(brute_fingerprint(text) ^ brute_fingerprint(text + " end")).count("1") <= 3
    assert component[5] == component[None] == (3 if near else 5)
    kept = S.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == ([1, 3, 7] if near else [1, 3, 5, 7])
    assert S.near_duplicates(df.limit(0)).count() == 0 == S.keep_one(df.limit(0)).count()


def brute_vectors(rows, threshold):
    usable = [i for i, (a, v, label) in enumerate(rows) if a is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    groups = defaultdict(list)
    for i in usable:
        groups[rows[i][2], len(rows[i][1])].append(i)
    pairs = []
    for members in groups.values():
        x = np.array([rows[i][1] for i in members], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        pairs += [(members[p], members[q]) for p, q in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1)))]
    links = [sum(i in p for p in pairs) for i in range(len(rows))]
    ids = brute_components({r[0] for r in rows if r[0] is not None}, [(rows[a][0], rows[b][0]) for a, b in pairs])
    return sorted(((r[0], n, ids.get(r[0]), r[0] is not None and ids[r[0]] == r[0]) for r, n in zip(rows, links)), key=str)


def clouds(seed, n, size, labels):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    return [(int(i), (centres[rng.integers(8)] + rng.normal(size=size) * 0.25).tolist(), int(rng.integers(labels))) for i in rng.permutation(n)]


@pytest.mark.parametrize("rows, tile, threshold", [
    ([], 8, 0.93), (clouds(1, 150, 12, 3), 16, 0.93), (clouds(2, 120, 5, 1), 512, 0.9), (clouds(3, 100, 30, 2), 7, 0.97),
    ([(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.01], 1), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [float("nan"), 1.0], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.0], 2), (11, [1.0, 0.0, 0.0], 1), (13, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [float("inf"), 1.0], 1)], 4, 0.93),
])
def test_embedding_links(spark, rows, tile, threshold):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, tile int")
    for block in (1 << 20, 2000)[: 1 + (tile in (4, 16))]:  # one block for each label, and many
        got = sorted(map(tuple, D.link(df, threshold, tile=tile, block_bytes=block).collect()), key=str)
        assert got == brute_vectors(rows, threshold)
    if tile != 16:
        return
    single = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
    rounded = [(a, v and [x if x is None else float(np.float32(x)) for x in v], label) for a, v, label in rows]
    assert sorted(map(tuple, D.link(single, threshold, tile=tile).collect()), key=str) == brute_vectors(rounded, threshold)


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(5)
    for size in (1, 7, 8, 9, 40):
        a, b = (D.unit(rng.normal(size=(60, size))) for _ in range(2))
        b[:20] = D.unit(a[:20] + 0.1 * rng.normal(size=(20, size)))
        want = set(zip(*(x.tolist() for x in np.nonzero(a @ b.T >= 0.9))))
        for step in (3, 16):
            i, j, sure = D.close_pairs(a, b, D.suffix_norms(a), D.suffix_norms(b), 0.9, step)
            assert want <= set(zip(i.tolist(), j.tolist())) and set(zip(i[sure].tolist(), j[sure].tolist())) <= want
        for tile in (7, 100):
            found = {(p, q - 60) for i, j in D.compare(a, b, 0.9, tile) for p, q in zip(i.tolist(), j.tolist())}
            assert found == set(zip(*(x.tolist() for x in np.nonzero(a @ b.T >= 0.9))))


def test_spanning():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randrange(1, 40)
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(40))]
        i, j = (np.array([x[k] for x in links], int) for k in range(2))
        assert D.spanning(n, i, j).tolist() == [brute_components(range(n), links)[x] for x in range(n)]
