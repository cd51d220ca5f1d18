"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import slices

#: Fixed value: the published pattern that splits text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same split for texts of ASCII characters alone, which the plainer engine does faster.
ASCII_PATTERN = PATTERN.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9").replace(" ?a-zA-Z+", " ?[a-zA-Z]+").replace(" ?0-9+", " ?[0-9]+")
#: Pre-tokens whose ids a Python worker remembers at most, and bytes up to which one is remembered.
CACHE, CACHE_BYTES = 100_000, 64
NONE, INT_NONE = np.int64(1) << 62, (1 << 31) - 1


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else 256 and up in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PairTable:
    """(left, right) -> rank and merged id, by a binary search in sorted keys that works on whole arrays."""

    def __init__(self, pairs: Iterable[tuple[int, int, int, int]]):
        rows = np.array(sorted((a << 32 | b, rank, new) for a, b, rank, new in pairs), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.new = (np.ascontiguousarray(rows[:, i]) for i in range(3))
        self.one = {int(k): (int(r), int(n)) for k, r, n in rows}
        self.new_of = np.full(int(self.ranks.max(initial=-1)) + 1, -1, np.int64)
        self.new_of[self.ranks] = self.new

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; NONE where a pair doesn't merge or an end is missing, as -1."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0), self.ranks[at], NONE)


def merge_one(ids: list[int], table: PairTable) -> list[int]:
    """Merge one long sequence. Leaf i of the tree is the pair that begins at i; the root is the lowest (rank, i)."""
    n = len(ids)
    size = 1 << max(0, n - 1).bit_length()
    none = (1 << 62, 0)
    get = table.one.get
    ids, before, after = list(ids), list(range(-1, n - 1)), [*range(1, n), -1]
    tree = [none] * (2 * size)
    for i in range(n - 1):
        if found := get(ids[i] << 32 | ids[i + 1]):
            tree[size + i] = (found[0], i)
    for k in range(size - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        k = size + i
        if tree[k] == value:
            return
        tree[k] = value
        while k > 1:
            k >>= 1
            value = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == value:
                return
            tree[k] = value

    while tree[1] is not none and tree[1] != none:
        i = tree[1][1]
        gone = after[i]
        ids[i] = get(ids[i] << 32 | ids[gone])[1]
        ids[gone] = -1
        nxt = after[i] = after[gone]
        if nxt >= 0:
            before[nxt] = i
        put(gone, none)
        found = get(ids[i] << 32 | ids[nxt]) if nxt >= 0 else None
        put(i, (found[0], i) if found else none)
        if (prev := before[i]) >= 0:
            found = get(ids[prev] << 32 | ids[i])
            put(prev, (found[0], prev) if found else none)
    return [x for x in ids if x >= 0]


def merge_many(rows: np.ndarray, lengths: np.ndarray, table: PairTable, first: np.ndarray | None = None) -> np.ndarray:
    """Merge many short sequences at once, each with a segment tree of its own (one row of ``tree``).

    rows: ids, padded to a power of two with -1; first: the ranks of their pairs, where known. Each step takes every root, merges that pair, and updates the three
    leaves it touches and the nodes above them. Returns rows with -1 for what was merged away.
    """
    count, size = rows.shape
    none = np.int32(INT_NONE)
    spots = np.arange(size, dtype=np.int32)
    ids = rows.astype(np.int32).ravel()
    after = np.tile(np.where(spots + 1 < size, spots + 1, -1).astype(np.int32), count)
    after[np.arange(count) * size + lengths - 1] = -1
    before = np.tile(spots - 1, count)
    levels = np.full((count, 2 * size), none, np.int32)
    ranks = first if first is not None else table.look(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(count, size - 1)
    levels[:, size : 2 * size - 1] = np.where(ranks < INT_NONE // size, ranks * size + spots[:-1], none)
    level = size
    while level > 1:
        half = level // 2
        np.minimum(levels[:, level : 2 * level : 2], levels[:, level + 1 : 2 * level : 2], out=levels[:, half:level])
        level = half
    tree = levels.ravel()  # the node k of a row is at row * 2 * size + k
    live = np.nonzero(levels[:, 1] < none)[0]
    while len(live):
        leaf, top = live * size, live * (2 * size)
        root = tree[top + 1]
        i = root % size
        at = leaf + i
        gone = after[at]
        new = table.new_of[root // size]
        ids[at] = new
        ids[leaf + gone] = -1
        nxt = after[leaf + gone]
        after[at] = nxt
        prev = before[at]
        linked, has = np.nonzero(nxt >= 0)[0], np.nonzero(prev >= 0)[0]
        to_right, to_left = (leaf + nxt)[linked], (leaf + prev)[has]
        before[to_right] = i[linked]
        found = table.look(np.concatenate([new[linked], ids[to_left]]), np.concatenate([ids[to_right], new[has]]))
        tree[top + size + gone] = none
        tree[top + size + i] = none
        hit = found[: len(linked)] < NONE
        tree[(top + size + i)[linked[hit]]] = found[: len(linked)][hit] * size + i[linked[hit]]
        found, left = found[len(linked) :], prev[has]
        tree[(top + size)[has] + left] = np.where(found < NONE, found * size + left, none)
        row = np.concatenate([top, top, top[has]])
        node = np.concatenate([gone, i, left]) + size
        depth = size
        while depth > 1:
            node, depth = node >> 1, depth >> 1
            under = row + 2 * node
            tree[row + node] = np.minimum(tree[under], tree[under + 1])
        live = live[tree[top + 1] < none]
    return ids.reshape(count, size)


class ByteBPE:
    """A byte-level BPE tokenizer read from a tokenizers .json file; encodes and decodes as that library does."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
        vocab = model["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.prefix = bool(pre.get("add_prefix_space"))
        self.byte_ids = np.array([vocab.get(c, -1) for c in alphabet], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.table = PairTable((vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(merges))
        every = np.repeat(self.byte_ids, 256)
        self.first = self.table.look(every, np.tile(self.byte_ids, 256))
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words, self.ascii_words = regex.compile(PATTERN), re.compile(ASCII_PATTERN, re.ASCII)
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        # a token whose every character stands for a byte is those bytes; any other is its own text
        self.bytes_of = [b""] * (max(names) + 1)
        for i, t in names.items():
            self.bytes_of[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        self.cache: dict[str, bytes] = {}

    def _learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """ids of each word, as little-endian unsigned 32-bit integers."""
        out: dict[str, bytes] = {}
        short: list[str] = []
        raws: list[bytes] = []
        for w in words:
            raw = w.encode("utf-8", "surrogatepass")
            if len(raw) > CACHE_BYTES:
                out[w] = np.array(merge_one([x for x in self.byte_ids[np.frombuffer(raw, np.uint8)].tolist() if x >= 0], self.table), "<u4").tobytes()
            else:
                short.append(w)
                raws.append(raw)
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        flat = np.frombuffer(b"".join(raws) + bytes(CACHE_BYTES), np.uint8)
        starts = np.cumsum(lengths) - lengths
        size, above = 2, 0
        while above < CACHE_BYTES:
            group = np.nonzero((lengths > above) & (lengths <= size))[0]
            for at in range(0, len(group), 8_000):  # what is worked on at once stays in the processor's caches
                part = group[at : at + 8_000]
                inside = np.arange(size) < lengths[part][:, None]
                raw = flat[starts[part][:, None] + np.arange(size)].astype(np.int64)
                pairs = np.where(inside[:, 1:], self.first[raw[:, :-1] << 8 | raw[:, 1:]], NONE)
                merged = merge_many(np.where(inside, self.byte_ids[raw], -1), lengths[part], self.table, pairs)
                keep = merged >= 0
                ids, ends = merged[keep].astype("<u4").tobytes(), np.cumsum(keep.sum(axis=1)) * 4
                begins = np.concatenate([[0], ends[:-1]])
                out.update((short[k], ids[i:j]) for k, i, j in zip(part.tolist(), begins.tolist(), ends.tolist()))
            size, above = size * 2, size
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """ids of each whole text; null is empty. Strings of added tokens in a text are those tokens."""
        pieces: list[list] = []
        for text in texts:
            text = text or ""
            parts: list = []
            for k, part in enumerate(self.split_added.split(text) if self.split_added else [text]):
                if k % 2:
                    parts.append(int(self.added[part]).to_bytes(4, "little"))
                elif part:
                    parts.append((self.ascii_words if part.isascii() else self.words).findall(part if not self.prefix or part[0].isspace() else " " + part))
            pieces.append(parts)
        cache = self.cache
        lists = [p for parts in pieces for p in parts if isinstance(p, list)]
        missing = set().union(*lists).difference(cache)
        if len(cache) + len(missing) > CACHE:
            cache.clear()
            missing = set().union(*lists)
        cache.update(self._learn(missing))
        get = cache.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts) for parts in pieces]

    def decode(self, ids: bytes) -> str:
        """The text of ids (little-endian unsigned 32-bit); bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_loaded: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    """One tokenizer for each path and Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row: token ids as an array of ints, and the text they decode to.

    A null text is an empty one: no tokens. Repeated rows and null ids stay; other columns are ignored. Very long texts are
    encoded whole. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            at = 0
            for texts in slices(b.column(1)):
                ids = bpe.encode_batch(texts)
                arrays = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), arrays, pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])
                at += len(texts)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row, computed beside the encoder so that ids stay there.

    A null text is an empty one: no tokens. Repeated rows and null ids stay; other columns are ignored. Very long texts are
    encoded whole. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            at = 0
            for texts in slices(b.column(1)):
                ids = bpe.encode_batch(texts)
                columns = [
                    b.column(0).slice(at, len(texts)),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x).encode("utf-8", "replace")).hexdigest() for x in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
