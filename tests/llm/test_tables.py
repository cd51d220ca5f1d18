"""URL filters, WARC archives, mixing, language identification, license scans and the pipeline on small fixtures."""

import base64
import hashlib
import io
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from seekframe.llm import common, language_id as L, licenses, mixing as M, simhash as S, url_filters as U, warc as W


def views(**frames):
    c = duckdb.connect()
    for name, df in frames.items():
        c.register(name, df.toArrow())
    return c


URLS = [None, "", "no scheme", "http://", "http://a.org", "http://a.org/", "HTTPS://WWW.Example.ORG/es/x?y#z", "http://example.org/en/1", "http://example.org/en/19", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/a",
        "http://com/de/", "http://x.com/de", "ftp://u@h.org:80/a", "http://a.net/x://b.org/", "http://b.spam-farm.example.net/q", "http://spam-farm.example.org/", "x://?q=://a.org/", "http://org/#", "http://a.org?x/", "http://é.org/\nes/", "http://.../", "http://." + "a." * 300 + "org/"]


def test_urls_agree_with_sql(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string, rule string")
    blocked = spark.createDataFrame([(h,) for h in U.BLOCKED_HOSTS], "key string")
    got = U.judge(pages, list(U.RULES), blocked)
    want = views(pages=pages).sql(U.oracle())
    assert got.columns == want.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
    many = U.judge(pages, list(U.RULES), spark.range(4000).select(F.concat(F.lit("h"), "id").alias("key")).union(blocked), shard_bytes=512)
    assert sorted(map(str, many.collect())) == sorted(map(str, got.collect()))
    long = spark.createDataFrame([("." + "a." * 200 + "org",), (None,)], "key string")  # 202 labels
    by_host = {r.page_id: r.verdict for r in U.judge(pages, [], long).collect()}
    assert [i for i, v in by_host.items() if v == "block"] == [] and U.judge(pages, [], long.limit(0)).where("verdict = 'block'").count() == 0
    long = spark.createDataFrame([("a." * 200 + "org",)], "key string")
    assert {r.page_id for r in U.judge(pages, [], long).collect() if r.verdict == "block"} == {len(URLS) - 1}
    assert U.judge(pages.limit(0), list(U.RULES), blocked).count() == 0


@pytest.mark.parametrize("shard, held", [(1 << 20, 1 << 20), (48, 100)])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, shard, held):
    monkeypatch.setattr(U, "HELD_BYTES", held)
    key = lambda n: F.concat(F.lit("k"), n.cast("string")).alias("key")
    universe = spark.range(6000).select(key(F.col("id")))
    for listed in (spark.range(0, 6000, 7), spark.range(0), spark.range(6000), spark.range(5990, 6050)):
        listed = listed.select(key(F.col("id")))
        cascade = U.Cascade.build(listed, universe, first_rate=0.3, shard_bytes=shard)
        assert len(cascade.levels[0].paths) > 1 if cascade.levels and shard < 64 and len(listed.collect()) > 1000 else True
        rows = universe.select("key", *(h.alias(n) for h, n in zip(U._hashes(F.col("key")), "ab"))).toArrow()
        found = cascade.has(*(rows[n].to_numpy().view("uint64") for n in "ab"))
        held = {r.key for r in listed.collect()}
        assert found.tolist() == [k in held for k in rows["key"].to_pylist()]


PAGES = [(1, "http://x/\r\ny", "same"), (2, None, "same"), (3, "u", "same"), (4, "u", None), (5, "u", ""), (None, "u", "same"), (6, "u", "é" * 70_000), (7, "u", "<p>x</p>"), (7, "u", "<p>x</p>")]


@pytest.mark.parametrize("least, size", [(0, 1 << 20), (3, 1 << 20), (0, 1)])
def test_archives_round_trip(spark, least, size):
    pages = spark.createDataFrame([(*p, 5) for p in PAGES], "page_id long, url string, html string, records int")
    got = W.round_trip(spark, pages, least_bytes=least, archive_bytes=size).collect()
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        first = max((j for j, _, h in PAGES if (h or "").encode() == raw and j is not None), default=None)
        again = first is not None and len(raw) >= least and (i is None or i < first)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert W.round_trip(spark, pages.limit(0)).count() == 0
    archives = W.write_archives(pages, least_bytes=least, archive_bytes=size)
    back = W.read_archives(archives).collect()
    assert len({r.record_id for r in back}) == len(back) == sum(r.records for r in archives.collect())
    responses = {r.record_id: r.payload_digest for r in back if r.record_type == "response"}
    assert all(responses[r.refers_to] == r.payload_digest for r in back if r.record_type == "revisit")
    for r in archives.collect():  # the smallest table has a dictionary too
        assert int.from_bytes(open(r.path.removeprefix("file://"), "rb").read(4), "little") == W.DICTIONARY_MAGIC


def test_archive_format(tmp_path):
    samples = [f"<html><body>{i} {'common words here ' * (i % 9)}</body></html>".encode() for i in range(500)]
    dictionary = zstandard.train_dictionary(4096, samples).as_bytes()
    writer = W.Writer(f"file://{tmp_path}/a.warc.zst", dictionary)
    records = [W.response(f"urn:page:{i}", "http://x/", s) for i, s in enumerate(samples[:20])]
    for r in records:
        writer.add(r)
    writer.close()
    raw = (tmp_path / "a.warc.zst").read_bytes()
    assert int.from_bytes(raw[:4], "little") == W.DICTIONARY_MAGIC
    assert list(W.read(io.BytesIO(raw))) == records == list(W.read(io.BytesIO(raw), chunk=7))
    start = 8 + int.from_bytes(raw[4:8], "little")
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompressobj().decompress(raw[start:])
    assert plain == records[0]  # one frame is one record
    with pytest.raises(ValueError):
        list(W.read(io.BytesIO(raw[:-5])))
    for broken in (records[0][:-1], records[0].replace(b"WARC/1.1", b"WARC/9"), records[1].replace(b"common", b"commom"), records[0].replace(b"WARC-Date", b"WARC-Late"), records[1].replace(b"Content-Length: ", b"Content-Length: 1"), b""):
        with pytest.raises(ValueError):
            W.parse(broken)


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, free, target = sum(sizes.values()), set(order), {}
    while free:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mixture(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([None, "", " \x0b ", "w " * rng.randrange(1, 40), "x\u00a0y\x1cz"]), rng.choice(["a", "a", "a", "b", "B", "é", "", None, "z"]), i, 1) for i in range(600)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, h long, target int")
    got = M.mix(df).collect()
    size = lambda t: len([w for w in (t or "").encode().split()])
    sizes = Counter()
    for _, t, s, *_ in rows:
        sizes[s] += size(t)
    targets, taken = brute_targets(sizes), Counter()
    source = {i: s for i, _, s, *_ in rows}
    assert len(got) == len(rows) and sorted((r.doc_id, r.size) for r in got) == sorted((i, size(t)) for i, t, *_ in rows)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(targets[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 80 for s in sizes)  # a document that comes twice, at most
    assert sorted(map(tuple, M.mix(df.repartition(7)).collect())) == sorted(map(tuple, got))
    rebuilt = M.resample(df)
    assert rebuilt.columns == df.columns
    words = Counter()
    for r in rebuilt.collect():
        words[r.source] += size(r.text)
    assert words == Counter({s: n for s, n in taken.items() if n})
    assert M.mix(df.limit(0)).count() == 0 == M.resample(df.limit(0)).count()


def test_native_plans_have_no_python(spark, monkeypatch):
    """Every step that is written on the way, and the last one."""
    plans, settle = [], common.settle

    def watched(df, tag):
        plans.append((tag, df._jdf.queryExecution().toString()))
        return settle(df, tag)

    for module in (common, M, licenses):
        if hasattr(module, "settle"):
            monkeypatch.setattr(module, "settle", watched)
    df = spark.createDataFrame([(1, "a b", "x"), (2, "a b mit license", "y")], "doc_id long, text string, source string")
    for out in (M.mix(df), M.resample(df), licenses.scan(df)):
        plans.append(("last", out._jdf.queryExecution().toString()))
    assert len(plans) > 8
    for tag, plan in plans:
        assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "CartesianProduct")), tag


@pytest.mark.parametrize("names", [("_source", "_target", "_whole", "_h", "_words", "_passes"), ("row", "pass", "passes", "bound", "bits", "of", "nth"), ("H", "size", "low", "open", "range", "r", "before", "take_bound")])
def test_clashing_names(spark, names):
    """Columns that are named as something inside stay as they are, in every stage that returns documents."""
    rows = [(i, f"text of words number {i % 7} " * 3, "en", "ab"[i % 2], i, *(f"{n}{i}" for n in names)) for i in range(30)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    for out in (M.resample(df), L.keep_identified(df, L.fit(df))):
        assert out.columns == df.columns and set(map(tuple, out.collect())) <= set(rows)
    once = S.keep_one(df, find=lambda thin: thin.select("doc_id", F.xxhash64("text").alias("component_id")))
    assert once.columns == df.columns and sorted(map(tuple, once.collect())) == rows[:7] and M.mix(df).count() == 30


def test_no_labels_drop_nothing(spark):
    """A model that learned nothing can't reject a language; only texts without a letter go."""
    df = spark.createDataFrame([(1, "some words", None), (2, "mehr worte", None), (3, "12", None), (4, None, None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in L.keep_identified(df, L.fit(df)).collect()) == [1, 2]


WORDS = {"one": "aba cab dab lab fab gab ".split(), "two": "xuz zux quz vux wuz yux ".split(), "drei": "straße größe über öfter mähen kühe".split()}


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(5, 60))), lang) for i in range(n) for lang in [rng.choice(list(WORDS))]]


def test_languages(spark):
    rows = texts(300) + [(1000, None, "one"), (1001, "", "two"), (1002, "123 !? 😀", "two"), (1003, "aba cab", None)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, score string")
    model = L.fit(df)
    got = {r.doc_id: r for r in L.identify(df, model).collect()}
    assert len(got) == len(rows) and all(got[i].lang_pred == lang for i, _, lang in rows[:300])
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002)) and got[1003].lang_pred == "one"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = L.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() == 301
    held = {r.doc_id: r.h for r in df.select("doc_id", L.held_out().alias("h")).collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in held.items())
    none = L.fit(df.where(L.held_out()))
    assert none.languages == () and {r.lang_pred for r in L.identify(df, none).collect()} == {"und"}
    assert L.identify(df.limit(0), model).count() == 0 and L.keep_identified(df.limit(0), model).count() == 0


def test_labels_of_held_out_rows_dont_matter(spark):
    df = spark.createDataFrame(texts(200), "doc_id long, text string, lang string")
    lied = df.withColumn("lang", F.when(L.held_out(), "lie").otherwise(F.col("lang")))
    a, b = L.fit(df), L.fit(lied)
    assert a.languages == b.languages and all((getattr(a, n) == getattr(b, n)).all() for n in ("offsets", "lang", "count", "base", "totals"))


def test_mixed_texts_have_shares(spark):
    model = L.fit(spark.createDataFrame(texts(300), "doc_id long, text string, lang string"))
    lang, share = model.predict(" ".join(WORDS["one"] * 20 + WORDS["two"] * 10))
    assert lang == "one" and share == pytest.approx(2 / 3, abs=0.1)
    assert model.predict(" ".join(WORDS["drei"] * 30)) == ("drei", 1.0)
    # a small share of a long text is a member too, if it pays
    shares = model.shares(" ".join(WORDS["one"] * 400 + WORDS["two"] * 10))
    assert set(shares) == {"one", "two"} and shares["two"] == pytest.approx(10 / 410, abs=0.01)


def plain_trigrams(text):
    """Character trigrams by dictionaries, of runs of letters with one space between."""
    spaced = " ".join(re.sub(r"[^\W\d_]|(.)", lambda m: " " if m.group(1) else m.group(), text.lower(), flags=re.S).split(" ")).split()
    joined = " " + " ".join(spaced) + "  "
    return Counter(joined[i : i + 3] for i in range(len(joined) - 2))


def plain_em(p, counts):
    shares = {x: 1 / len(p) for x in p}
    for _ in range(3000):
        new = dict.fromkeys(p, 0.0)
        for t, n in counts.items():
            whole = sum(shares[x] * p[x][t] for x in p)
            for x in p:
                new[x] += n * shares[x] * p[x][t] / whole
        total = sum(new.values())
        before, shares = shares, {x: n / total for x, n in new.items()}
        if max(abs(before[x] - shares[x]) for x in p) < 1e-9:
            break
    return shares, sum(n * math.log(sum(shares[x] * p[x][t] for x in p)) for t, n in counts.items())


def plain_choice(p, counts):
    """The best set of all sets, by the likelihood less its penalty."""
    total = sum(counts.values())
    best = None
    for k in range(1, len(p) + 1):
        for some in itertools.combinations(sorted(p), k):
            shares, likelihood = plain_em({x: p[x] for x in some}, counts)
            score = likelihood / 3 - (k - 1) * math.log(max(math.e, total / 3)) / 2
            if best is None or score > best[0] + 1e-9:
                best = (score, shares)
    return best[1]


def test_languages_agree_with_brute_force(spark):
    """Plain dictionaries, EM to the end, and every set of languages, against what the operator selects."""
    rng = random.Random(5)
    rows = [r for r in texts(150, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df)
    learned = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    counts = {lang: sum((plain_trigrams(t) for t, x in learned if x == lang), Counter()) for lang in WORDS}
    pooled = sum(counts.values(), Counter())
    every = sum(pooled.values()) + 0.01 * L.BUCKETS

    def likelihood(lang, t):
        return (counts[lang][t] + L.SMOOTHING * (pooled[t] + 0.01) / every) / (sum(counts[lang].values()) + L.SMOOTHING)

    asked = [" ".join(rng.choice(WORDS[lang]) for lang in mix for _ in range(rng.randrange(1, 25))) for mix in itertools.chain.from_iterable(itertools.product(WORDS, repeat=k) for k in (1, 2, 3))]
    for text in [t for _, t, _ in rows[:10]] + asked + ["Straße 12, aba!", "x"]:
        found = plain_trigrams(text)
        want = plain_choice({lang: {t: likelihood(lang, t) for t in found} for lang in WORDS}, found)
        got = model.shares(text)
        assert set(got) == set(want) and all(got[x] == pytest.approx(want[x], abs=0.03) for x in want), text


def test_any_number_of_languages_is_learned(spark):
    rng = random.Random(1)
    letters = [chr(i) for i in range(0x4E00, 0x4E00 + 300)]
    rows = [(1000 * n + k, "".join(rng.choice(letters[4 * n : 4 * n + 4]) for _ in range(40)), f"l{n:03}") for n in range(70) for k in range(20 + 40 * (n < 3))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(df)
    assert len(model.languages) == 70
    assert all(r.lang_pred == lang for r, lang in ((r, f"l{r.doc_id // 1000:03}") for r in L.identify(df, model).collect()))


def test_stage_uses_its_result(spark):
    """Random letters, and texts of no learned language, go; the languages asked for decide the rest."""
    rng = random.Random(2)
    df = spark.createDataFrame([*texts(200), (900, "".join(rng.choice("bcdfghjklmnpqrstvwxz ") for _ in range(400)), None), (901, "語学の勉強は楽しい" * 20, None)], "doc_id long, text string, lang string")
    model = L.fit(df)
    assert L.keep_identified(df, model).count() == 200
    some = L.keep_identified(df, model, languages=frozenset({"one"}), least=0.5)
    assert {r.lang for r in some.collect()} == {"one"}


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.identify(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(L.held_out())
    assert out.where("lang = lang_pred").count() / out.count() >= 0.97


LICENSED = [
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.", "MIT License mit license", "cc by", "CC-BY-NC 4.0: licensed under CC BY-NC 4.0", None, "", "one", "gnu general public",
    "permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and associated documentation files", "all rights reserved all rights reserved", "mit é license", "mit license" * 3, "the apache\nlicense " * 50, "words " * 5000 + "mit license",
]


def test_license_scan_agrees_with_sql(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(LICENSED)] + [(2, LICENSED[2], "x", 1), (2, LICENSED[0], "x", 1), (None, LICENSED[0], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, template string, n_words int")
    got, want = licenses.scan(df), views(documents=df).sql(licenses.oracle())
    assert got.columns == want.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
    by = {r.doc_id: r for r in got.where("doc_id in (0, 9, 11)").collect()}
    assert by[0].base_labels == "apache" and by[0].labels == "apache,apache-2.0" and by[9].labels == "mit-notice" and 0.75 <= by[9].score < 1 and by[11].n_base == 0
    assert licenses.scan(df.limit(0)).count() == 0


def brute_order(words, template, reach):
    """The most k-grams of a template that stand in order on diagonals within reach of one another's middle, anywhere."""
    at = defaultdict(list)
    for i in range(len(words) - 1):
        at[tuple(words[i : i + 2])].append(i)
    matches = [(t, i) for t, gram in template.grams() for i in at[gram]]
    best = 0
    for middle in {i - t for t, i in matches}:
        longest = {}
        for t, i in sorted((t, i) for t, i in matches if abs(i - t - middle) <= reach):
            longest[t, i] = 1 + max((n for (s, j), n in longest.items() if s < t and j < i), default=0)
        best = max(best, max(longest.values(), default=0))
    return best


def test_spans_agree_with_alignment(spark):
    """Copies of a whole license with words changed, dropped and put in are found; scrambled and doubled ones aren't."""
    rng = random.Random(3)
    all_ = {t.label: t for t in licenses.templates()}
    rows, wanted = [], {}
    for label in ("mit-text", "bsd-3-text", "zlib-text", "bsd", "mit-notice"):
        words, due = list(all_[label].words), len(all_[label].grams())
        for edits in (0, 1, 2, 5, 12):
            copy = list(words)
            for _ in range(edits):
                k = rng.randrange(1, len(copy) - 1)
                copy[k : k + rng.randrange(2)] = [f"x{rng.randrange(99)}"] * rng.randrange(2)
            rows.append((f"{label}+{edits}", ["before"] * 30 + copy + ["after"] * 30, label))
        shuffled = list(words)
        rng.shuffle(shuffled)
        rows += [(f"{label} shuffled", shuffled, label), (f"{label} doubled", [w for w in words for _ in range(2)], label), (f"{label} halved", words[: len(words) // 2], label)]
        rows.append((f"{label} backwards", words[len(words) // 2 :] + words[: len(words) // 2], label))
    rows.append(("twice", list(all_["mit-text"].words) * 2, "mit-text"))
    df = spark.createDataFrame([(i, " ".join(w)) for i, (_, w, _) in enumerate(rows)], "doc_id long, text string")
    assert max(len(t.words) for t in all_.values()) > 200
    found = defaultdict(list)
    for r in licenses.spans(df).where("not exact").collect():
        t, words = all_[r.label], rows[r.doc_id][1]
        found[r.doc_id, r.label].append(r)
        assert r.end - r.start <= 1.25 * len(t.words) and licenses.SHARE <= r.share <= brute_order(words[r.start : r.end], t, t.reach * 2) / len(t.grams()) + 1e-9
    for i, (name, words, label) in enumerate(rows):
        t = all_[label]
        exact = max((sum(tuple(words[d + k : d + k + 2]) == g for k, g in t.grams()) for d in range(len(words))), default=0)
        if exact >= licenses.SHARE * len(t.grams()):  # enough on one diagonal
            assert found[i, label], name
        if brute_order(words, t, t.reach) < licenses.SHARE * len(t.grams()):
            assert not found[i, label], name
    assert all(found[i, label] for i, (name, _, label) in enumerate(rows) if name[-2:] in ("+0", "+1") and label.endswith("text"))
    assert not any(found[i, label] for i, (name, _, label) in enumerate(rows) if name.split(" ")[-1] in ("shuffled", "doubled", "halved"))
    assert len(found[len(rows) - 1, "mit-text"]) == 2


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_pipeline_agrees_with_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, t + ".", lang, rng.choice(["a", "b", "c", None]), len(t)) for i, t, lang in texts(120, 3)]
    rows += [(200 + i, rows[i][1], rows[i][2], "a", 1) for i in range(20)] + [(300, None, "one", "a", 0), (301, "123 456", "one", "b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [r for r in rows if r[1] is not None and any(c.isalpha() for c in r[1])]
    sets = [(shingles(r[1]), r) for r in kept]
    stays, parent = [], {r[0]: r[0] for r in kept}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for k, (p, r) in enumerate(sets):
        for q, s in sets[:k]:
            if len(p & q) >= 0.8 * len(p | q):
                x, y = find(r[0]), find(s[0])
                parent[max(x, y)] = min(x, y)
    stays = [r for r in kept if find(r[0]) == r[0]]
    mixed = {r.doc_id: r.taken // max(r.size, 1) for r in M.mix(spark.createDataFrame(stays, df.schema)).collect()}
    assert Counter(r.doc_id for r in got) == Counter({i: n for i, n in mixed.items() if n})
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert r.n_tokens == len(library.encode(text[r.doc_id], add_special_tokens=False).ids) and r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
