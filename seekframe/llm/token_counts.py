"""Token counts by rank-synchronous merging of batched pre-tokens in ragged numpy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from seekframe.llm.common import slices

#: Fixed value: the character that stands for a space inside pieces (U+2581).
SPACE = "▁"
#: Piece types of the model format that a merge may make: normal, user defined, unused.
MERGEABLE = (1, 4, 5)
CACHE = 100_000
#: Pre-tokens up to this length are merged in one batch; symbols of a batch.
BATCH_SYMBOLS = 1 << 18
NONE = np.int64(1) << 40


class PieceCounter:
    """Counts the tokens that a BPE model in a sentencepiece .model file gives, with byte fallback.

    Pieces with a space hold it in front or are nothing but spaces, so a text falls into independent pre-tokens
    before each run of spaces. It also falls apart between any two characters that no piece has side by side.
    """

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        trainer, normal = model.trainer_spec, model.normalizer_spec
        if trainer.model_type != trainer.BPE or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix or not normal.escape_whitespaces:
            raise ValueError(f"{path}: only BPE models with identity normalisation and byte fallback are supported")
        self.dummy_prefix = normal.add_dummy_prefix
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type in MERGEABLE}
        if any(p.type == 4 for p in model.pieces):
            raise ValueError(f"{path}: user defined symbols aren't supported")
        if any(SPACE in p[1:] and p.strip(SPACE) for p in pieces):
            raise ValueError(f"{path}: a piece has a space inside")
        scores = {i: model.pieces[i].score for i in pieces.values()}
        rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # symbols: pieces by id; then characters that are parts of pieces without being pieces
        self.symbol = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - set(pieces)):
            self.symbol[c] = len(model.pieces) + len(self.symbol)
        rows = []
        for p, i in pieces.items():
            for cut in range(1, len(p)):
                if (a := self.symbol.get(p[:cut])) is not None and (b := self.symbol.get(p[cut:])) is not None:
                    rows.append((a << 32 | b, rank[scores[i]], i))
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.new = (np.ascontiguousarray(table[:, k]) for k in range(3))
        self.together = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.apart = "".join(c for c in "\n\t\r0123456789" if not any(c in x for x in self.together))
        self.pieces = pieces
        self.runs = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.cache: dict[str, int] = {}

    def _alone(self, c: str) -> int:
        """Tokens of a character that nothing merged: itself if it is a piece, else its bytes."""
        return 1 if c in self.pieces else len(c.encode("utf-8", "replace"))

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], NONE), np.where(hit, self.new[at], -1)

    def merge(self, symbols: np.ndarray, costs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving cost of each sequence. symbols, costs: all sequences one after another; lengths: of each.

        Every step finds the lowest rank in each sequence and merges its leftmost occurrence, in all sequences at
        once. All other occurrences of that rank in the sequence are merged in the same step, if no pair that arises
        has so low a rank: then one at a time would do the same. Finished sequences are counted and leave the arrays.
        """
        total = np.zeros(len(lengths), np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        nxt = np.append(symbols[1:], -1)
        nxt[np.cumsum(lengths) - 1] = -1
        rank, new = self._look(symbols, nxt)  # of each symbol with the one after it in its sequence
        while len(symbols):
            starts = np.cumsum(lengths) - lengths
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == NONE
            if done.any():
                total[owner[starts[done]]] = np.add.reduceat(costs, starts)[done]
                stay = np.repeat(~done, lengths)
                symbols, costs, owner, rank, new = symbols[stay], costs[stay], owner[stay], rank[stay], new[stay]
                lengths, lowest = lengths[~done], lowest[~done]
                if not len(symbols):
                    break
                starts = np.cumsum(lengths) - lengths
            spots = np.nonzero(rank == np.repeat(lowest, lengths))[0]
            first = np.ones(len(spots), bool)
            first[1:] = owner[spots[1:]] != owner[spots[:-1]]
            if not first.all():
                # occurrences that overlap (as in aaa): every second of a run counts, from its left
                each = np.arange(len(spots))
                run_start = np.ones(len(spots), bool)
                run_start[1:] = spots[1:] != spots[:-1] + 1
                whole = (each - np.maximum.accumulate(np.where(run_start, each, 0))) % 2 == 0
                spots, first = spots[whole], first[whole]
                after = self._merged(symbols, costs, owner, rank, new, spots)
                # pairs with the merged symbol, as they end up and as they are until the right neighbour has merged
                m, o, r, at = after[0], after[2], after[3], after[5]
                left = np.where((at > 0) & (o[at - 1] == o[at]), r[at - 1], NONE)
                beyond = np.minimum(spots + 2, len(symbols) - 1)
                early = np.where((spots + 2 < len(symbols)) & (owner[beyond] == owner[spots]), self._look(m[at], symbols[beyond])[0], NONE)
                risky = np.minimum(np.minimum(left, r[at]), early) <= rank[spots]
                if risky.any():
                    bad = np.zeros(len(total), bool)
                    bad[owner[spots[risky]]] = True
                    spots = spots[first | ~bad[owner[spots]]]
                    after = self._merged(symbols, costs, owner, rank, new, spots)
            else:
                after = self._merged(symbols, costs, owner, rank, new, spots)
            gone = np.bincount(owner[spots], minlength=len(total))
            lengths = lengths - gone[owner[starts]]
            symbols, costs, owner, rank, new, _ = after
        return total

    def _merged(self, symbols: np.ndarray, costs: np.ndarray, owner: np.ndarray, rank: np.ndarray, new: np.ndarray, spots: np.ndarray) -> tuple:
        """The arrays once the pairs that begin at spots have merged, and where those symbols are now."""
        keep = np.ones(len(symbols), bool)
        keep[spots + 1] = False
        at = spots - np.arange(len(spots))
        symbols, costs, owner, next_rank, next_new = (x[keep] for x in (symbols, costs, owner, rank, new))
        symbols[at] = new[spots]
        costs[at] = 1
        touched = np.concatenate([at, at[at > 0] - 1])
        right = np.minimum(touched + 1, len(symbols) - 1)
        inside = (touched + 1 < len(symbols)) & (owner[right] == owner[touched])
        next_rank[touched], next_new[touched] = self._look(symbols[touched], np.where(inside, symbols[right], -1))
        return symbols, costs, owner, next_rank, next_new, at

    def _learn(self, words: Iterable[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        part: list[str] = []
        held = 0
        ended = [w for w in words if 1 < len(w) <= 64 and w[-2:] not in self.together]
        if ended:  # a last character that merges with nothing, as most punctuation marks
            bare = {w: w[:-1] for w in ended}
            words = set(words).difference(bare)
            each = {w: n for w in set(bare.values()) if (n := self.cache.get(w)) is not None}
            each |= self._learn(set(bare.values()).difference(each))
            out = each | {w: each[b] + self._alone(w[-1]) for w, b in bare.items()}
        for w in words:
            if w in out:
                continue
            if len(w) > 64:  # falls apart where no piece reaches across
                cuts = [0, *(i for i in range(1, len(w)) if w[i - 1 : i + 1] not in self.together), len(w)]
                inner = [w[a:b] for a, b in zip(cuts, cuts[1:])]
                if len(inner) > 1:
                    each = self._learn(set(inner))
                    out[w] = sum(map(each.__getitem__, inner))
                    continue
            part.append(w)
            held += len(w)
            if held >= BATCH_SYMBOLS:
                out.update(self._count(part))
                part, held = [], 0
        out.update(self._count(part))
        return out

    def _count(self, words: list[str]) -> Iterator[tuple[str, int]]:
        if not words:
            return iter(())
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)
        chars, inverse = np.unique(codes, return_inverse=True)
        text = [chr(c) for c in chars.tolist()]
        symbols = np.array([self.symbol.get(c, -1) for c in text], np.int64)[inverse]
        costs = np.array([self._alone(c) for c in text], np.int64)[inverse]
        return zip(words, self.merge(symbols, costs, lengths).tolist())

    def _split(self, text: str) -> list[str]:
        """Independent pre-tokens of the normalised text."""
        if not text:
            return []
        text = (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)
        if SPACE * 2 in text:
            return self.runs.findall(text)
        first, *rest = text.split(SPACE)
        return [first, *[SPACE + w for w in rest]] if first else [SPACE + w for w in rest]

    def count_batch(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text, without begin or end symbols; null is empty."""
        lines: list[list[str]] = []
        added: list[int] = []
        for text in texts:
            words = self._split(text or "")
            if "\n" in self.apart and "\n" in (text or ""):
                # a line break merges with nothing: it counts as its byte (or piece), and words end there
                words = [x for w in words for x in (w.split("\n") if "\n" in w else (w,))]
                added.append(text.count("\n") * self._alone("\n"))
            else:
                added.append(0)
            lines.append(words)
        cache = self.cache
        missing = set().union(*lists).difference(cache) if (lists := lines) else set()
        if len(cache) + len(missing) > CACHE:
            cache.clear()
            missing = set().union(*lines)
        missing.discard("")
        cache.update(self._learn(missing))
        cache[""] = 0
        get = cache.__getitem__
        return [sum(map(get, words)) + more for words, more in zip(lines, added)]


_loaded: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One counter for each path and Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs, row by row and without a shuffle.

    A null text is an empty one: 0 bytes and tokens. Repeated rows and null ids stay; other columns are ignored. Very long
    texts are counted whole. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(path)
        for b in batches:
            n = [x for texts in slices(b.column(2)) for x in pieces.count_batch(texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
