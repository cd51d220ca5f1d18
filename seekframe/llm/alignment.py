"""Cross-tokenizer alignment: a transducer over dangling suffixes cuts two token sequences of one text into groups.

Neither tokenizer's tokens reach across a single space that stands between two visible characters, so a text falls into
parts there, between which the residual is empty; a worker remembers the groups of parts that it has seen, and reads the new
ones side by side: one step of the transducer takes the next token of every part.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import sys
from collections.abc import Iterable, Iterator
from itertools import chain, count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.bpe import byte_alphabet
from seekframe.llm.common import fresh, settle, slices, small

#: Transitions that a Python worker remembers at most; beyond them it starts anew.
CACHE = 2_000_000
#: Parts of texts that a worker remembers at most (in each of two generations), and characters up to which one is remembered.
PARTS, PART_CHARS = 150_000, 64
#: Fixed value: the character that stands for a space inside pieces (U+2581).
SPACE = "▁"
#: In arrays of states: not looked up yet; and that bytes differ.
UNKNOWN, DIFFER = np.iinfo(np.int64).max, np.iinfo(np.int64).min


class Transducer:
    """Reads two token sequences of one byte string, always the next token of the side that lags.

    A state is the side that leads and its bytes that the other side hasn't matched yet. The next token either is
    shorter than they are (the rest dangles on), or longer (then it leads with its own rest), or ends with them: the
    residual is empty and a group closes. A step depends on the state and the token alone, so it is remembered; states
    are numbered, those in which the first side leads from 1 up, the others from -1 down, and 0 is the empty residual.
    """

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.bytes = {1: a_bytes, -1: b_bytes}
        self.clear()

    def clear(self) -> None:
        self.ids: dict[tuple[int, bytes], int] = {}
        self.suffix: dict[int, tuple[int, bytes]] = {}
        self.begin: dict[int, int] = {}  # first token of a group -> state
        self.step: dict[int, int | None] = {}  # state and token -> state; None where bytes differ
        self.numbers = count(1)
        # the same for arrays: states by first token, and by sorted state * width + token
        self.begins = np.full(len(self.bytes[1]), UNKNOWN)
        self.keys, self.next = np.array([UNKNOWN]), np.array([DIFFER])  # a key that no state has, so that neither is empty

    def state(self, side: int, residual: bytes) -> int:
        if not residual:
            return 0
        if (n := self.ids.get((side, residual))) is None:
            n = self.ids[side, residual] = side * next(self.numbers)
            self.suffix[n] = side, residual
        return n

    def follow(self, state: int, token: int) -> int | None:
        side, residual = self.suffix[state]
        new = self.bytes[-side][token]
        if len(new) <= len(residual):
            return self.state(side, residual[len(new) :]) if residual.startswith(new) else None
        return self.state(-side, new[len(residual) :]) if new.startswith(residual) else None

    def align(self, a: list[int], b: list[int], pairs: list[int], width: int) -> list[tuple[int, int]] | None:
        """The ends (tokens of a, tokens of b) of all groups, and a * width + b of all links, appended to pairs.

        A link is a token that leads with one read against it: the two overlap. None if the bytes differ.
        """
        if len(self.step) > CACHE:
            self.clear()
        ends, i, j, n, m = [], 0, 0, len(a), len(b)
        begin, step, link = self.begin, self.step, pairs.append
        while i < n:
            x = a[i]
            i += 1
            if (state := begin.get(x)) is None:
                state = begin[x] = self.state(1, self.bytes[1][x])
            while state:
                if state > 0:
                    if j == m:
                        return None
                    token = y = b[j]
                    j += 1
                else:
                    if i == n:
                        return None
                    token = x = a[i]
                    i += 1
                link(x * width + y)
                key = state * width + token
                if (state := step.get(key, key)) == key:
                    state = step[key] = self.follow(key // width, token)
                if state is None:
                    return None
            ends.append((i, j))
        return ends if j == m else None

    def starts(self, tokens: np.ndarray) -> np.ndarray:
        """The states after each first token of a group."""
        state = self.begins[tokens]
        if (new := state == UNKNOWN).any():
            for x in np.unique(tokens[new]).tolist():
                self.begins[x] = self.state(1, self.bytes[1][x])
            state = self.begins[tokens]
        return state

    def steps(self, keys: np.ndarray, width: int) -> np.ndarray:
        """The states after each state * width + token; DIFFER where bytes differ."""
        at = np.searchsorted(self.keys, keys)
        missing = self.keys[np.minimum(at, len(self.keys) - 1)] != keys
        if missing.any():
            new = np.unique(keys[missing])
            follow = (self.follow(k // width, k % width) for k in new.tolist())
            into = np.searchsorted(self.keys, new)
            self.next = np.insert(self.next, into, [DIFFER if n is None else n for n in follow])
            self.keys = np.insert(self.keys, into, new)
            at = np.searchsorted(self.keys, keys)
        return self.next[at]

    def align_many(self, a: np.ndarray, b: np.ndarray, a_stop: np.ndarray, b_stop: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """align() of many sequences side by side, which follow one another in a and b up to a_stop and b_stop each.

        Which tokens of a and of b end a group, and the links in the order of sequences. None if any bytes differ.
        """
        if len(self.keys) > CACHE:
            self.clear()
        ends_a, ends_b, links = np.zeros(len(a), bool), np.zeros(len(b), bool), np.full(len(a) + len(b), -1)
        if not len(a_stop):
            return ends_a, ends_b, links
        i, j = a_stop - np.diff(a_stop, prepend=0), b_stop - np.diff(b_stop, prepend=0)
        at, x, y, state = i + j, a[:1].repeat(len(i)), b[:1].repeat(len(i)), np.zeros(len(i), np.int64)
        if (i == a_stop).any() or (j == b_stop).any():
            return None
        while len(i):
            if len(first := np.nonzero(state == 0)[0]):
                x[first] = a[i[first]]
                i[first] += 1
                state[first] = self.starts(x[first])
                if not state[first].all():
                    return None
            leads = state > 0
            if (np.where(leads, j, i) == np.where(leads, b_stop, a_stop)).any():
                return None
            behind, ahead = np.nonzero(leads)[0], np.nonzero(~leads)[0]
            token = np.empty(len(i), np.int64)
            token[behind] = y[behind] = b[j[behind]]
            token[ahead] = x[ahead] = a[i[ahead]]
            j[behind] += 1
            i[ahead] += 1
            links[at] = x * width + y
            at += 1
            state = self.steps(state * width + token, width)
            if len(closed := np.nonzero(state == 0)[0]):
                ends_a[i[closed] - 1] = ends_b[j[closed] - 1] = True
                done = (state == 0) & (i == a_stop)
                if (j[done] != b_stop[done]).any():
                    return None
                if done.any():
                    i, j, at, x, y, state, a_stop, b_stop = (v[~done] for v in (i, j, at, x, y, state, a_stop, b_stop))
            if (state == DIFFER).any():
                return None
        return ends_a, ends_b, links[links >= 0]


class Aligned(NamedTuple):
    """Numbers of the first side's tokens and of groups, links (a * width + b, as bytes of 64-bit integers), and the groups as text."""

    n_a: int
    n_groups: int
    links: bytes
    text: str

    def groups(self) -> list[tuple[list[int], list[int]]]:
        return [tuple(list(map(int, side.split(","))) for side in g.split("|")) for g in self.text.split(";")]


#: In place of the groups of a part whose tokens don't spell it.
NOTHING = Aligned(0, 0, b"", "")
#: Texts that have a space beside white space or at an end, or that are empty: not all their spaces divide them.
WHITE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
IRREGULAR = f"[{WHITE}] | [{WHITE}]|^[{WHITE}]|[{WHITE}]$|^$"


class Pair:
    """Two tokenizers of public libraries: byte-level BPE (a .json file), and pieces with byte fallback (a .model file)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            a_bytes[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.width = max(len(a_bytes), len(b_bytes), 1 << 17)
        self.transducer = Transducer(a_bytes, b_bytes)
        self.a_bytes, self.a_sizes, self.b_sizes = a_bytes, *(np.array([len(x) for x in side]) for side in (a_bytes, b_bytes))
        # each id as text, with what may follow it: another of its side, the other side, the next group
        self.each = max(len(a_bytes), len(b_bytes))
        self.shown = [f"{i}{after}" for after in ",|;" for i in range(self.each)]
        self.shown_sizes = np.array([len(x) for x in self.shown])
        if any(SPACE in p[1:] and p.strip(SPACE) for p in pieces):
            raise ValueError(f"{b_path}: a piece has a space inside")
        self.known: dict[str, Aligned] = {}
        self.before: dict[str, Aligned] = {}

    def parts(self, cut: list[str]) -> list[str]:
        """The parts of a text that was split at every space: one that isn't between visible characters divides nothing."""
        out: list[str] = []
        for p in cut:
            if out and (not p or p[0].isspace() or not out[-1] or out[-1][-1].isspace()):
                out[-1] = f"{out[-1]} {p}"
            else:
                out.append(p)
        return out

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of both sides, of all these texts one after another, each with a space in front."""
        a = self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        b = self.b.encode(texts, num_threads=1)
        return np.array(list(chain.from_iterable([x.ids for x in a])), np.int64), np.array(list(chain.from_iterable(b)), np.int64)

    def together(self, parts: list[str], a: np.ndarray, b: np.ndarray, many: bool = False) -> list[Aligned] | None:
        """The groups of each of several parts whose tokens follow one another; None if the bytes of tokens differ from them.

        Residuals are empty between parts, so the transducer reads all of them as one sequence; or, of many short parts, all side by side.
        """
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != "".join([f" {p}" for p in parts]).encode():
            return None
        # where parts end, in bytes and in tokens of both sides
        stop = np.cumsum([len(p) + 1 if p.isascii() else len(p.encode()) + 1 for p in parts])
        a_at, b_at = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_stop, b_stop = np.searchsorted(a_at, stop) + 1, np.searchsorted(b_at, stop) + 1
        if not len(b) or b_at[-1] != stop[-1] or (a_at[a_stop - 1] != stop).any() or (b_at[b_stop - 1] != stop).any():
            return None
        if many:
            read = self.transducer.align_many(a, b, a_stop, b_stop, self.width)
            if read is None:
                return None
            ends_a, ends_b, links = read
        else:
            found: list[int] = []
            ends = self.transducer.align(a.tolist(), b.tolist(), found, self.width)  # both sides' bytes agree, or it is None
            if ends is None:
                return None
            ends_a, ends_b, links = np.zeros(len(a), bool), np.zeros(len(b), bool), np.array(found, np.int64)
            i, j = np.array(ends).T
            ends_a[i - 1] = ends_b[j - 1] = True
        text, chars = self.written(a, b, ends_a, ends_b)
        char = chars[a_stop + b_stop - 1].tolist()
        # a token that ends no group is one link more than its group has tokens of the other side
        group = np.cumsum(ends_a)[a_stop - 1]
        link = (8 * (a_stop + b_stop - group)).tolist()
        held, n_a, n_groups = links.tobytes(), np.diff(a_stop, prepend=0).tolist(), np.diff(group, prepend=0).tolist()
        return [Aligned(n, g, held[k:m], text[c : d - 1]) for n, g, k, m, c, d in zip(n_a, n_groups, [0, *link], link, [0, *char], char)]

    def learn(self, parts: Iterable[str]) -> dict[str, Aligned]:
        """The groups of each part, or NOTHING where its tokens don't spell it; parts that a space divides are encoded together, in texts of some thousand characters."""
        short, long, rest = [], [], []
        for p in parts:
            if not p or p[0].isspace() or p[-1].isspace() or SPACE in p:
                rest.append(p)
            else:
                (short if len(p) <= PART_CHARS else long).append(p)
        out: dict[str, Aligned] = {}
        for clean in (short, long):
            if clean:
                a, b = self.encoded([" ".join(clean[k : k + 1000]) for k in range(0, len(clean), 1000)])
                found = self.together(clean, a, b, clean is short)
                if found is None:
                    rest += clean
                else:
                    out.update(zip(clean, found))
        for p in rest:
            one = self.together([p], *self.encoded([p]))
            out[p] = NOTHING if one is None else one[0]
        return out

    def cut(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different parts of all texts, their numbers in the order of texts, and how many each text has."""
        column = pa.array([t or "" for t in texts], pa.string())
        lists, irregular = pc.split_pattern(column, " "), pc.match_substring_regex(column, IRREGULAR).to_numpy(zero_copy_only=False)
        odd = np.nonzero(irregular)[0]
        if len(odd):
            again = pa.array([self.parts(texts[k].split(" ")) if texts[k] else [] for k in odd.tolist()], lists.type)
            lists = pa.concat_arrays([lists.filter(pa.array(~irregular)), again])
        each = lists.flatten().dictionary_encode()
        codes, sizes = each.indices.to_numpy(), pc.list_value_length(lists).to_numpy()
        if len(odd):
            order = np.concatenate([np.nonzero(~irregular)[0], odd])
            codes, sizes = codes[np.argsort(np.repeat(order, sizes), kind="stable")], sizes[np.argsort(order)]
        return each.dictionary.to_numpy(zero_copy_only=False).tolist(), codes, sizes

    def groups(self, texts: list[str | None]) -> tuple[list[Aligned], np.ndarray, np.ndarray]:
        """The groups of all different parts, the numbers of parts in the order of texts, and how many each text has.

        A text without tokens has no parts, or one that is NOTHING.
        """
        parts, codes, sizes = self.cut(texts)
        if len(self.known) > PARTS:  # what isn't asked for again is forgotten with the generation before
            self.before, self.known = self.known, {}
        each = list(map(self.known.get, parts))
        missing = []
        for k in [k for k, x in enumerate(each) if x is None]:
            each[k] = x = self.before.get(p := parts[k])
            if x is None:
                missing.append(k)
            else:
                self.known[p] = x
        gc.disable()  # no cycles arise here, and looking for them among so many parts takes a tenth of the time
        try:
            new = self.learn([parts[k] for k in missing])
        finally:
            gc.enable()
        for k in missing:
            each[k] = new[parts[k]]
        self.known.update(new if max(map(len, new), default=0) <= PART_CHARS else {p: x for p, x in new.items() if len(p) <= PART_CHARS})
        return each, codes, sizes

    def written(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[str, np.ndarray]:
        """All groups as decimal ids, a1,a2|b1; each with a mark behind it, and where in that text each token ends."""
        i, j = np.nonzero(ends_a)[0] + 1, np.nonzero(ends_b)[0] + 1  # tokens of both sides up to the end of each group
        tokens = np.empty(len(a) + len(b), np.int64)
        tokens[np.arange(len(a)) + np.concatenate([[0], j])[np.cumsum(ends_a) - ends_a]] = a + self.each * ends_a
        tokens[np.arange(len(b)) + i[np.cumsum(ends_b) - ends_b]] = b + 2 * self.each * ends_b
        return "".join(map(self.shown.__getitem__, tokens.tolist())), np.cumsum(self.shown_sizes[tokens])


_loaded: dict[tuple[str, str], Pair] = {}


def pair(a_path: str, b_path: str) -> Pair:
    """One pair of tokenizers for each two paths and Python worker."""
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends): the groups of every row, as ends in both id arrays; empty without tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        kind = pa.list_(pa.int32())
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                out = []
                each, codes, sizes = both.groups(texts)
                for numbers in np.split(codes, np.cumsum(sizes)[:-1]):
                    parts = [each[k] for k in numbers.tolist()]
                    a, b, a_ends, b_ends = [], [], [], []
                    for x, y in (g for p in parts for g in p.groups()) if NOTHING not in parts else ():
                        a += x
                        b += y
                        a_ends.append(len(a))
                        b_ends.append(len(b))
                    out.append((a, b, a_ends, b_ends))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *(pa.array(x, kind) for x in zip(*out))], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])
                at += len(texts)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _rows(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """A row for each document: counts, the groups' digest, and its distinct links with how often they come."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)

        def rows(texts: list[str | None]) -> list[pa.Array]:
            each, codes, sizes = both.groups(texts)
            none = np.array([not p.n_a for p in each], bool)
            n = len(texts)
            if none.any():
                of = np.repeat(np.arange(n), sizes)
                lost = np.bincount(of, none[codes], n) > 0
                codes, sizes = codes[~lost[of]], np.where(lost, 0, sizes)
            n_a, n_groups, links, shown = zip(*each) if each else ((),) * 4
            ends = np.concatenate([[0], np.cumsum(sizes)])
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[codes])])[ends])
            n_links = np.fromiter(map(len, links), np.int64, len(links)) // 8
            n_a, n_groups, of_text = total(np.array(n_a, np.int64)), total(np.array(n_groups, np.int64)), total(n_links)
            # all links of all texts, sorted by text and pair
            times = n_links[codes]
            at = np.repeat((np.cumsum(n_links) - n_links)[codes] - (np.cumsum(times) - times), times)
            at += np.arange(len(at))
            keys = np.frombuffer(b"".join(links), np.int64)[at]
            keys += np.repeat(np.arange(n) * both.width**2, of_text)
            keys.sort()
            first = np.nonzero(np.diff(keys, prepend=-1))[0]
            text, pairs = np.divmod(keys[first], both.width**2)
            offsets = pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32())
            times = np.diff(first, append=len(keys))
            every = pa.array(shown, pa.large_string()).take(pa.array(codes))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), every), pa.scalar(";", pa.large_string())).cast(pa.large_binary())
            digests = [hashlib.sha256(x.as_buffer()).hexdigest() if m else "" for x, m in zip(joined, sizes.tolist())]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((pairs, pa.int64()), (times, pa.int32()))]
            return [*(pa.array(x, pa.int64()) for x in (n_a, of_text + n_groups - n_a, n_groups, of_text)), pa.array(digests, pa.string()), *lists]

        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *rows(texts)], names)
                at += len(texts)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def link_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of docs.

    n_a, n_b: tokens of both tokenizers; n_groups: what is between places where tokens of both end; n_links: pairs of
    tokens whose bytes overlap. The count of an id pair is the number of rows that hold it linked; n_best: links whose
    count is the highest of their first id, ties included; count_sum: the sum of counts over links. Texts that are
    null, empty, or that tokens don't spell exactly have zeros and ''. Repeated rows and null ids stay, and each row
    counts; other columns are ignored. Very long texts are whole. Empty table: no rows.

    Documents are encoded once; their distinct links are written, and counted with partial sums. Counts come back to
    the links by a join, without a shuffle where the counts are few enough to broadcast, and else with exchanges of its own
    on both sides, so that a pair that every document has is split.
    """
    rows, _ = settle(_rows(docs, a_path, b_path, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "align-rows")
    width = pair(a_path, b_path).width
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts, _ = settle(counts, "align-counts")
    first = F.floor(F.col("pair") / width)
    # a row for each id of the first vocabulary, at most
    most = F.broadcast(counts.groupBy(first.alias("a")).agg(F.max("n").alias("most")))
    known = counts.join(most, first == F.col("a")).select(fresh("pair").alias("of"), "n", (F.col("n") == F.col("most")).alias("best"))
    known = small(known, "align-known")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    met = links.join(known, F.col("pair") == F.col("of"))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    own = sums.select(fresh("row").alias("of"), "n_best", "count_sum")
    out = rows.drop("pairs", "times").join(own, F.col("row") == F.col("of"), "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
