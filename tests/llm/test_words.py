"""Token counts, BPE and fingerprints against the libraries and brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seekframe.llm import bpe, fingerprints as fp, language_id as L, licenses, mixing as M, simhash as S, token_counts as tc

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = [
    "", " ", "\n", "a", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<s></s><unk>", "<0x0A>", "  x   y\n\n z\t", "x" * 300, "ab" * 3000, " " * 1000, "\n" * 70 + "a",
    "é" * 300, "don't I'LL we're", "日本語テキスト" * 40, "😀" * 50, " \u0085a\x1c\x1d b\x00c", "12345678 ²³ ½", "▁▁ ▁a▁b", "aaa aaaa aaaaa " + "a" * 20, "the\nthe ", "a\r\nb", " " * 10 + "\n   x",
]


def odd_texts(n, seed):
    rng = random.Random(seed)
    pools = [lambda: chr(rng.choice([32, 32, 10, 9, 13, rng.randrange(32, 127), rng.randrange(97, 102), rng.randrange(0x80, 0x500), rng.randrange(0, 0x3000), rng.randrange(0x1F300, 0x1F700)])), lambda: rng.choice("etaoinshr  "), lambda: rng.choice("ab "), lambda: rng.choice("the in er\n.,")]
    return ["".join(pool() for _ in range(rng.randrange(1, 300))) for _ in range(n) for pool in [rng.choice(pools)]]


def test_token_counts_equal_the_library():
    texts = EDGES + odd_texts(400, 1)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = tc.PieceCounter(PIECES)
    want = [len(x) for x in library.encode(texts)]
    assert counter.count_batch(texts) == want
    assert counter.count_batch(texts[::-1]) == want[::-1]  # from the cache
    assert counter.count_batch([None, ""]) == [0, 0]


def test_texts_above_a_megabyte(spark):
    """Whole texts, across the size at which batches are cut: many words, and one word without an end."""
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(230_000)), "short", "".join(rng.choice("abcdé") for _ in range(30_000)), None]
    assert len(texts[0]) > 1 << 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces, library = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(BPE)
    assert {r.doc_id: r.n_tokens for r in tc.token_counts(df, PIECES).collect()} == {i: len(pieces.encode(t or "")) for i, t in enumerate(texts)}
    for r in bpe.digests(df, BPE).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)
    assert S.fingerprint(texts[0]) == S.fingerprint(texts[0] + " ") != S.fingerprint(texts[2])  # more shingles than one slice holds
    model = L.fit(spark.createDataFrame([(i, texts[0][i * 100 : i * 100 + 90], "en") for i in range(40)], "doc_id long, text string, lang string"))
    assert model.predict(texts[0])[0] == "en"
    assert licenses.scan(spark.createDataFrame([(1, texts[0] + " mit license")], "doc_id long, text string")).first().first_word == 230_000
    assert M.mix(df.withColumn("source", F.lit("a"))).where("doc_id = 0").first()["size"] == 230_000


def test_token_counts_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(tc, "CACHE", 20)
    texts = odd_texts(40, 2)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = tc.PieceCounter(PIECES)
    assert [n for t in texts for n in counter.count_batch([t])] == [len(x) for x in library.encode(texts)]


def test_token_counts_table(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (3, "", None), (None, "é" * 5000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(tc.token_counts(df, PIECES).collect(), key=str)
    assert len(got) == 5 and {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got if r.doc_id in (2, 3)} == {(2, 0, 0, False), (3, 0, 0, False)}
    long = next(r for r in got if r.doc_id is None)
    assert long.n_bytes == 10000 and long.over_limit == (long.n_tokens > 4096)
    assert tc.token_counts(df.limit(0), PIECES).count() == 0


def test_bpe_equals_the_library():
    texts = EDGES + odd_texts(300, 3)
    library, own = Tokenizer.from_file(BPE), bpe.ByteBPE(BPE)
    for text, ids, want in zip(texts, own.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert own.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_decodes_broken_bytes_as_the_library():
    library, own, rng = Tokenizer.from_file(BPE), bpe.ByteBPE(BPE), random.Random(4)
    for _ in range(200):
        ids = [rng.choice([int(own.byte_ids[rng.randrange(256)]), rng.randrange(50257)]) for _ in range(rng.randrange(1, 12))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_segment_trees_agree_with_plain_merging():
    own, rng = bpe.ByteBPE(BPE), random.Random(5)

    def plain(ids):
        while True:
            best = min(((own.table.one[a << 32 | b][0], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a << 32 | b in own.table.one), default=None)
            if best is None:
                return ids
            i = best[1]
            ids = ids[:i] + [own.table.one[ids[i] << 32 | ids[i + 1]][1]] + ids[i + 2 :]

    for _ in range(100):
        raw = bytes(rng.choice(b"etaoin shrdlu") for _ in range(rng.randrange(1, 60)))
        ids = own.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        want = plain(ids)
        size = max(2, 1 << (len(ids) - 1).bit_length())
        rows = np.full((1, size), -1, np.int64)
        rows[0, : len(ids)] = ids
        merged = bpe.merge_many(rows, np.array([len(ids)]), own.table)[0]
        assert bpe.merge_one(ids, own.table) == want == merged[merged >= 0].tolist()


def test_bpe_table(spark):
    df = spark.createDataFrame([(1, "a b", 5), (1, "a b", 5), (2, None, 6)], "doc_id long, text string, ids int")
    got = sorted(map(tuple, bpe.digests(df, BPE).collect()))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[0] == got[1] and got[2] == (2, 0, empty, empty)
    assert [r.decoded for r in bpe.encode(df, BPE).collect()] == ["a b", "a b", ""]
    assert bpe.digests(df.limit(0), BPE).count() == 0


def brute_hashes(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return sorted(fp._hash(s) for s in shingles)


def test_sketches():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 4, 5, 6, 40, 300, 3000)] + ["x " * 2000, "a b c d e f g " * 300]
    kept = lambda hashes: [h for h in hashes if h * fp.SCALE < 1 << 64] or hashes[:1]
    for t in texts:
        s, hashes = fp.sketch(t), brute_hashes(t)
        assert s.hashes.tolist() == kept(hashes)  # the fixed fraction, however short the text; never nothing
        again = fp.Sketch.from_text(s.to_text())
        assert again.to_text() == s.to_text() and fp.likeness(s, again) == 1 == fp.containment(s, again)
    a, b = texts[7], texts[6]
    assert fp.merge(fp.sketch(a), fp.sketch(b)).hashes.tolist() == kept(sorted(set(brute_hashes(a)) | set(brute_hashes(b))))
    part = " ".join(a.split()[:600])  # a fifth of the long text
    assert fp.containment(fp.sketch(part), fp.sketch(a)) > 0.9 and fp.containment(fp.sketch(a), fp.sketch(part)) == pytest.approx(0.2, abs=0.06)
    assert fp.likeness(fp.sketch(""), fp.sketch("a")) == 0 == fp.likeness(fp.sketch(a), fp.sketch(b)) and fp.likeness(fp.sketch(None), fp.sketch("")) == 1


def test_one_estimator_for_all_lengths():
    u = lambda *x: fp.Sketch.of(np.array(x, np.uint64))
    high, other = 3 << 62, (3 << 62) + 5
    assert fp.likeness(u(1, 2, 3), u(1, high)) == 1 and fp.containment(u(1, 2, 3), u(1)) == pytest.approx(1 / 3)
    assert fp.likeness(u(high), u(high)) == 1 and fp.likeness(u(high), u(other)) == 0 == fp.likeness(u(high), u(1, high)) and fp.containment(u(high), u(1, high)) == 0
    rng = random.Random(12)
    words = [f"w{i}" for i in range(4000)]
    long = " ".join(rng.choice(words) for _ in range(3000))
    whole, split, missed = fp.sketch(long), long.split(), {}
    for n in (10, 20, 100):  # parts of a long text
        parts = [fp.sketch(" ".join(split[k : k + n])) for k in range(0, 2900, 9)]
        missed[n] = sum(fp.likeness(p, whole) == 0 for p in parts) / len(parts)
        assert all(fp.likeness(p, whole) in (0, 1) for p in parts)
    assert missed[10] < 0.05 and missed[20] < 0.001 and missed[100] == 0
    half = [fp.containment(fp.sketch(" ".join(split[k : k + 50] + [f"x{k}{i}" for i in range(50)])), whole) for k in range(0, 2900, 29)]
    assert np.mean(half) == pytest.approx(46 / 96, abs=0.02) and np.std(half) < 1.5 * (0.25 / 96) ** 0.5


@pytest.mark.parametrize("rows", [
    [], [(1, "a b c d e f g")], [(1, "same"), (1, "same"), (1, "other"), (2, None), (None, "x")],
    [(i * 7, " ".join(f"w{(i * j) % 13}" for j in range(i % 40))) for i in range(90)],
    [(3, f"text {i} of one id " * (i % 5 + 1)) for i in range(60)] + [(None, f"none {i}") for i in range(9)] + [(-(1 << 63), "least"), ((1 << 63) - 1, "most"), (4, "long " * 50_000), (4, None)],
])
def test_compare_with_next(spark, monkeypatch, rows):
    monkeypatch.setattr(fp, "RANGE_BYTES", 200)
    schema = "doc_id long, text string, range int, tail int, o int"
    df = spark.createDataFrame([(i, t, 9, 9, 9) for i, t in rows], schema)
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        e = fp.edited(text, after)
        a, b, c = map(fp.sketch, (text, e, after))
        want.append((i, len(text), hashlib.sha256(e.encode()).hexdigest(), a.to_text(), b.to_text(), fp.likeness(a, b), fp.likeness(a, c)))
    assert sorted(map(str, map(tuple, fp.compare_with_next(df).collect()))) == sorted(map(str, want))


def test_edited():
    assert fp.edited("abcdefg", "XYZ") == "abcdeXY" and fp.edited("abcdefghi", "X") == "abcdefX" and fp.edited("ab", "XY") == "ab"
