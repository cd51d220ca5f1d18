"""Line dedup, the filter audit and cross-tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import permutations

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seekframe.llm import alignment as A, filter_audit as FA, line_dedup as LD

BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = {c: c + 32 for c in range(65, 91)}
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_lines(rows):
    key = lambda x: x.strip(BLANKS).translate(CAPITALS)
    first = {}
    for i, t in rows:
        for x in map(key, (t or "").split("\n")):
            if len(x) >= 10:
                first[x] = min((first.get(x, (True, 0)), (i is None, i or 0)))
    out = []
    for i, t in rows:
        every = (t or "").split("\n")
        kept = [x for x in every if key(x) not in first or first[key(x)] == (i is None, i or 0)]
        out.append((i, "\n".join(kept), len(every), len(every) - len(kept)))
    return sorted(out, key=str)


def line_tables():
    rng = random.Random(5)
    pool = [f"Line number {i} of the pool" for i in range(30)] + ["short", "nine char", "ten chars!", "", "  ", "é" * 9, "é" * 10, "İstanbul is long", "a common line of all documents"]
    vary = lambda x: rng.choice([x, x.upper(), f" \t{x}\r", f"{x}\x0b", f" {x}"])
    text = lambda n: "\n".join(vary(rng.choice(pool)) if rng.random() < 0.6 else f"own {rng.random()}" for _ in range(n))
    odd = [(1, None), (2, ""), (3, "\n"), (4, "\n\n"), (None, "Line number 3 of the pool"), (None, "only without an id"), (None, "only without an id"), (7, "a" * 200_000), (8, "a" * 200_000 + "\nb")]
    many = [(i * 3, text(rng.randrange(1, 12))) for i in range(60)] + [(500, text(700)), (501, text(300)), (9, "twice in one document\nx\ntwice in one document"), (10, "x\nTwice in one document ")]
    hot = [(i, f"a common line of all documents\nown line {i} here\nA COMMON line of all documents") for i in range(1000, 1400)] + [(None, "a common line of all documents\nthe rest is here")] * 90
    return [[], odd, many, odd + many + many[:9] + [(0, t) for _, t in many[:4]], hot + many]


@pytest.mark.parametrize("rows", line_tables(), ids=["empty", "odd", "many", "repeated", "hot"])
@pytest.mark.parametrize("sample, range_lines", [(512, 1 << 19), (8, 50)])
def test_line_dedup(spark, monkeypatch, rows, sample, range_lines):
    monkeypatch.setattr(LD, "SAMPLE_LINES", sample)
    monkeypatch.setattr(LD, "RANGE_LINES", range_lines)
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, pos int, keep string, t1 string")
    for bound in (LD.BROADCAST_ROWS, 0):
        monkeypatch.setattr(LD, "BROADCAST_ROWS", bound)
        assert sorted(map(tuple, LD.deduplicate(df).collect()), key=str) == brute_lines(rows)


def test_line_bitmaps_are_sparse(spark):
    rows = [(1, "the one line that is shared"), (2, "\n".join(f"line {i} of the second" for i in range(1000)) + "\nThe one line that is shared")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    (found,) = LD.bitmaps(df).collect()
    assert found.doc_id == 2 and [(w.at, w.bits) for w in found.keep] == [(15, ~(1 << 40))]
    built = LD.dropped(LD.settle(LD.lines(df), "t")[0])._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert built.count("Exchange ") - built.count("BroadcastExchange ") == 1  # lines are shuffled once, and streamed as they are sorted
    plain = LD.deduplicate(df)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Python" not in built and "InArrow" not in built and "Python" not in plain and "InArrow" not in plain


def brute_fails(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, lang in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in BLANKS else c for c in t).split(" ") if w]
        bits = (len(words) < 200) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t)) + 8 * any(c in "#$%&*|" for c in t)
        out.append((i, lang or "", bits + 16 * (t in first and (i is None or i > first[t]))))
    return out


def audit_rows():
    rng = random.Random(9)
    words = lambda n, of, low: " ".join(rng.choice([w, w.capitalize()]) if not low else w for w in (f"w{rng.randrange(of)}é" for _ in range(n)))
    out = [(i, words(rng.choice([5, 199, 200, 300]), rng.choice([30, 10_000]), rng.random() < 0.5) + rng.choice(["", "", " #", "\t|\x0b"]), rng.choice(["en", "de", None, ""])) for i in range(120)]
    out += [(i + 500, *rng.choice(out[:40])[1:]) for i in range(60)]
    return out + [(None, out[3][1], "en"), (None, "never else", "en"), (None, "never else", "en"), (7, out[7][1], "fr"), (8, None, "en"), (9, "", None), (9, "", None), (1000, "one two " * 60_000, "xx")]


def test_filter_audit(spark, monkeypatch):
    rows = audit_rows()
    monkeypatch.setattr(FA, "PART_BYTES", 5000)
    labels = [(i, i % 3 % 2, int(i % 5 == 0)) for i in range(0, 600, 2)] + [(4, 1, 1), (6, None, None), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "a") for r in rows], "doc_id long, text string, lang string, word int, part string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = Counter(brute_fails(rows))
    got = Counter()
    for r in FA.flags(docs).collect():
        got[r.doc_id, r.part, r.fails] += r.rows
    assert got == want
    good, bad = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    each = [(part, {x for k, x in enumerate("ABCDE") if fails >> k & 1}, i) for i, part, fails in brute_fails(rows)]
    expected, first = {}, Counter()
    for part in {e[0] for e in each}:
        mine = [(f, i) for p, f, i in each if p == part]
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [i for f, i in mine if x in f and not f & before]
                first[part, x] += len(gone)
                expected[part, order, step] = (sum(not f & (before | {x}) for f, _ in mine), len(gone), sum(x in f and bool(f & before) for f, _ in mine), sum(f == {x} for f, _ in mine), sum(i in good for i in gone), sum(i in bad for i in gone))
    report = FA.audit(docs, known).collect()
    assert {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) for r in report} == expected and len(report) == len(expected)
    assert all(r.shapley == first[r.part, r.filter_order[r.step - 1]] for r in report)
    assert FA.audit(docs.limit(0), known).count() == 0 and FA.audit(docs, known.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_audit_shuffles_no_words(spark):
    texts = spark.createDataFrame([(1, 2, "a b a")], "h1 long, h2 long, text string")
    assert [tuple(r) for r in FA.word_counts(texts, 3).collect()] == [(1, 2, 3, 2)]
    plan = FA.word_counts(texts, 3)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert all("word" not in line for line in plan.splitlines() if "Exchange" in line)


def token_bytes():
    library = Tokenizer.from_file(A_PATH)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a = lambda i: bytes(back[c] for c in library.id_to_token(i))
    b = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    return a, b


def brute_alignment(texts):
    library, pieces = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    library.encode_special_tokens = True
    a_of, b_of = token_bytes()
    found, docs = [], defaultdict(set)
    for n, t in enumerate(texts):
        a, b = (library.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)) if t else ([], [])
        if not t or b"".join(map(a_of, a)) != (" " + t).encode() or b"".join(map(b_of, b)) != (" " + t).encode():
            found.append(None)
            continue
        spans = []
        for ids, of in ((a, a_of), (b, b_of)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(of(i)), i))
                at += len(of(i))
            spans.append(own)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ";".join("|".join(",".join(str(i) for s, e, i in own if lo <= s and e <= hi) for own in spans) for lo, hi in zip([0, *cuts], cuts))
        links = [(x, y) for s, e, x in spans[0] for u, v, y in spans[1] if s < v and u < e]
        for p in set(links):
            docs[p].add(n)
        found.append((len(a), len(b), len(cuts), links, groups))
    most = defaultdict(int)
    for (x, _), held in docs.items():
        most[x] = max(most[x], len(held))
    out = []
    for x in found:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            counts = [(len(docs[p]), most[p[0]]) for p in x[3]]
            out.append((x[0], x[1], x[2], len(x[3]), sum(n == m for n, m in counts), sum(n for n, _ in counts), hashlib.sha256(x[4].encode()).hexdigest()))
    return out


def alignment_texts():
    rng = random.Random(11)
    edges = ["", None, " ", "\n", "a", "<|endoftext|>", "x<|endoftext|> y", "<s></s><unk>", "<0x0A>", "  x   y\n\n z\t", "x" * 300, " " * 90, "é" * 40, "don't I'LL", "日本語テキスト" * 9, "😀 😀", "a\x00b", "▁a", "a ▁b", "12345678 ½", "a\r\nb"]
    words = ["the", "of", "tokenizer", "alignment", "Zürich", "naïve", "10%", "(see)", "https://a.b/c", "…", "x_y"]
    return edges + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(40)] + ["".join(chr(rng.choice([32, 97, 98, 233, 0x4E00 + rng.randrange(99), rng.randrange(33, 127)])) for _ in range(60)) for _ in range(40)]


def test_alignment(spark, monkeypatch):
    texts = alignment_texts()
    want = brute_alignment(texts)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, n_a int, row int")
    for clear in (A.CACHE, 5):
        monkeypatch.setattr(A, "CACHE", clear)
        got = {r.doc_id: tuple(r)[1:] for r in A.link_counts(df, A_PATH, B_PATH).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert sum(w[0] > 0 for w in want) > 80 and want[17] == want[18] == (0, 0, 0, 0, 0, 0, "")
    monkeypatch.setattr(A, "small", lambda df, tag: A.settle(df, tag)[0].hint("merge"))
    got = {r.doc_id: tuple(r)[1:] for r in A.link_counts(df, A_PATH, B_PATH).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_alignment_of_repeated_rows_and_long_texts(spark):
    long = " ".join(f"w{i * i % 9973}" for i in range(60_000)) + "y" * 20_000
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (3, None), (4, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = A.link_counts(df, A_PATH, B_PATH).collect()
    same = [r for r in got if r.n_links and r.doc_id != 4]
    assert len(same) == 3 and all(r.n_best == r.n_links for r in same)
    (big,) = [r for r in got if r.doc_id == 4]
    assert big.n_links == big.n_a + big.n_b - big.n_groups and big.n_b == len(sentencepiece.SentencePieceProcessor(model_file=B_PATH).encode(long))
    assert A.link_counts(df.limit(0), A_PATH, B_PATH).count() == 0
    shown = A.align(df.where("doc_id = 1"), A_PATH, B_PATH).first()
    assert list(shown.a_ends) == [1, 2] and len(shown.b_ids) == shown.b_ends[-1]


def test_transducer_against_offsets():
    """Groups of any two cuts of a byte string: those at common offsets; and none where the bytes differ."""
    rng = random.Random(3)
    tokens = [bytes(p) for n in (1, 2, 3) for p in __import__("itertools").product(b"ab", repeat=n)]
    for _ in range(300):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30)))
        sides = []
        for _ in range(2):
            ids, at = [], 0
            while at < len(text):
                n = rng.randrange(1, min(3, len(text) - at) + 1)
                ids.append(tokens.index(text[at : at + n]))
                at += n
            sides.append(ids)
        machine, pairs = A.Transducer(tokens, tokens), []
        ends = machine.align(*sides, pairs, 64)
        offset = lambda ids: [sum(len(tokens[i]) for i in ids[: k + 1]) for k in range(len(ids))]
        x, y = map(offset, sides)
        assert [(x[i - 1], y[j - 1]) for i, j in ends] == [(c, c) for c in sorted(set(x) & set(y))] and len(pairs) == len(x) + len(y) - len(ends)
        assert machine.align(sides[0], sides[1][:-1], [], 64) is None and machine.align(sides[0][:-1], sides[1], [], 64) is None
        wrong = [tokens.index(bytes([195 - text[0]]))] + sides[1]
        assert machine.align(sides[0], wrong, [], 64) is None
