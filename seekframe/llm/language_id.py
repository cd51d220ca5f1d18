"""Language identification as inference of a mixture: which languages, in which shares, made this text?"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import fresh, small

#: Documents of each language that the model is fitted on, about; the only bound, and it holds for fitting alone.
SAMPLE_PER_LANGUAGE = 1500
BUCKETS = 1 << 16
#: Trigrams of the overall distribution that each language's counts are smoothed with.
SMOOTHING = 20.0
#: Nats by which the likelihood of a mixture may fall short of its maximum.
TOLERANCE = 0.01
#: Share of random trigrams above which a text is in no language.
MOST_RANDOM = 0.5
UNDETERMINED = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(text: str | None) -> np.ndarray | None:
    """Buckets of all character trigrams of the whole text, lower-cased, with runs of non-letters as one space.

    None if text is null or has no letter.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letter_table()[codes] if len(codes) else np.zeros(0, bool)
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    codes = codes[letter | np.concatenate([[True], letter[:-1]])]
    codes = np.concatenate([[32], codes, [32, 32]]).astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (codes[2:] * np.uint64(0x165667B19E3779F9))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.int64)


class Evidence:
    """The likelihoods of one text's features in every language, held sparsely.

    A language's likelihood of a bucket is (its count + base of the bucket) / (its total + SMOOTHING); only counts above
    zero are stored, so memory is bounded by the text's features and the model, not by languages times features.
    """

    def __init__(self, model: Model, buckets: np.ndarray, n: np.ndarray):
        self.model, self.n = model, n
        self.total = float(n.sum())
        begin, end = model.offsets[buckets], model.offsets[buckets + 1]
        length = end - begin
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        self.row, self.lang, self.count = np.repeat(np.arange(len(buckets)), length), model.lang[at], model.count[at]
        self.base = model.base[buckets]

    def alone(self) -> np.ndarray:
        """Log-likelihood of the text in each language by itself."""
        base = np.log(self.base)
        more = np.bincount(self.lang, self.n[self.row] * (np.log(self.base[self.row] + self.count) - base[self.row]), len(self.model.totals))
        return self.n @ base + more - self.total * np.log(self.model.totals)

    def columns(self, chosen: list[int]) -> np.ndarray:
        """(features, languages): likelihoods in a few languages."""
        out = np.repeat(self.base[:, None], len(chosen), axis=1)
        for k, language in enumerate(chosen):
            mine = self.lang == language
            out[self.row[mine], k] += self.count[mine]
        return out / self.model.totals[chosen]

    def slopes(self, mixed: np.ndarray) -> np.ndarray:
        """For each language, how fast the log-likelihood rises, in nats by its share, where features have likelihood ``mixed``."""
        weight = self.n / mixed
        return (weight @ self.base + np.bincount(self.lang, weight[self.row] * self.count, len(self.model.totals))) / self.model.totals - self.total


def em(p: np.ndarray, n: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, float]:
    """(shares, log-likelihood): expectation-maximisation of the shares of likelihoods p, given counts n of features.

    Ends when the likelihood is within TOLERANCE of its maximum: it is concave, so it can't rise by more than its
    steepest slope.
    """
    shares, total = np.full(p.shape[1], 1 / p.shape[1]), n.sum()
    for _ in range(rounds):
        mixed = p @ shares
        slope = (n / mixed) @ p
        if slope.max() - total <= TOLERANCE:
            break
        shares = shares * slope / total
        shares /= shares.sum()
    return shares, float(n @ np.log(p @ shares))


@dataclass(frozen=True)
class Model:
    """Trigram counts by language: for each bucket a slice of (language, count), and what all languages share."""

    languages: tuple[str, ...]
    offsets: np.ndarray
    lang: np.ndarray
    count: np.ndarray
    base: np.ndarray
    totals: np.ndarray

    @staticmethod
    def of(languages: tuple[str, ...], lang: np.ndarray, bucket: np.ndarray, count: np.ndarray) -> Model:
        """From one row for each language and bucket with a count."""
        order = np.lexsort((lang, bucket))
        lang, bucket, count = lang[order].astype(np.int32), bucket[order], count[order].astype(np.float64)
        # a little of the overall distribution, and of the even one, keeps every likelihood above zero
        pooled = np.bincount(bucket, count, BUCKETS) + 0.01
        offsets = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=BUCKETS))]).astype(np.int64)
        return Model(languages, offsets, lang, count, SMOOTHING * pooled / pooled.sum(), np.bincount(lang, count, len(languages)) + SMOOTHING)

    def evidence(self, text: str | None) -> Evidence | None:
        found = features(text)
        if found is None or not self.languages:
            return None
        ordered = np.sort(found.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
        first = np.concatenate([[0], np.nonzero(ordered[1:] != ordered[:-1])[0] + 1])
        return Evidence(self, ordered[first].astype(np.int64), np.diff(np.append(first, len(ordered))).astype(np.float64))

    def shares(self, text: str | None) -> dict[str, float]:
        """The selected set of languages with their shares, the largest first; empty without a letter, or a language."""
        evidence = self.evidence(text)
        if evidence is None:
            return {}
        chosen, shares = self.select(evidence)
        order = sorted(range(len(chosen)), key=lambda k: (-shares[k], chosen[k]))
        return {self.languages[chosen[k]]: float(min(1.0, max(0.0, shares[k]))) for k in order}

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share): the strongest member of the selected set, and its share of the mixture."""
        return next(iter(self.shares(text).items()), (UNDETERMINED, 0.0))

    def accepts(self, text: str | None, languages: frozenset[str] | None = None, least: float = 0.0) -> bool:
        """Whether a text is in one of the languages: see ``keep_identified``."""
        evidence = self.evidence(text)
        if evidence is None:
            return not self.languages and features(text) is not None
        chosen, shares = self.select(evidence)
        columns = evidence.columns(chosen)
        random = np.full((len(columns), 1), 1 / BUCKETS)
        if (evidence.n / (columns @ shares)).sum() / BUCKETS > evidence.total:  # else its best share is none
            if em(np.hstack([columns, random]), evidence.n)[0][-1] > MOST_RANDOM:
                return False
        return sum(x for k, x in zip(chosen, shares.tolist()) if languages is None or self.languages[k] in languages) > least

    def select(self, evidence: Evidence) -> tuple[list[int], np.ndarray]:
        """The set of languages with the best penalised likelihood, and their shares.

        Overlapping trigrams count as a third each; each language after the first costs half the logarithm of the
        evidence. From the best single language on, that language joins which gains most, until none gains more than
        it costs; then members leave that don't pay for themselves any more, and it starts again until nothing changes.
        Only the penalty decides: every language is looked at, and one is passed over only if the likelihood, which
        is concave, can't rise enough along it.
        """
        alone, n = evidence.alone(), evidence.n
        cost = 1.5 * np.log(max(np.e, evidence.total / 3))  # in nats of the likelihood that counts each trigram once
        chosen = [int(np.argmax(alone))]
        shares, likelihood = np.ones(1), float(alone[chosen[0]])
        while True:
            slope = evidence.slopes(evidence.columns(chosen) @ shares)
            best = None
            for i in np.nonzero(slope > cost)[0].tolist():
                if i not in chosen and (best is None or slope[i] > best[0] - likelihood):
                    found, value = em(evidence.columns([*chosen, i]), n)
                    if value - likelihood > cost and (best is None or value > best[0]):
                        best = (value, [*chosen, i], found)
            if best is None:
                return chosen, shares
            likelihood, chosen, shares = best
            while len(chosen) > 2:
                fewer = [(*em(evidence.columns(chosen[:k] + chosen[k + 1 :]), n)[::-1], k) for k in range(len(chosen))]
                value, found, k = max(fewer, key=lambda x: (x[0], -x[2]))
                if likelihood - value >= cost:
                    break
                likelihood, chosen, shares = value, chosen[:k] + chosen[k + 1 :], found


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn trigram likelihoods from about ``sample`` labelled documents of each language that aren't held out.

    Every language is learned. The sample is drawn by a hash of the id and text, in proportion to counts over all rows;
    whole texts are counted, on the executors. What comes to the driver is one count for each bucket that a language
    has, so the model grows with the languages, not with the documents. Null labels and texts are left out, and so
    are languages without a letter; without any labelled row the model has no language.
    """
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = usable.where(~held_out("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    each = small(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"))
    drawn = usable.join(each.select(fresh("lang", "string").alias("_lang"), "n"), F.col("lang") == F.col("_lang"))
    drawn = drawn.where(F.pmod(F.xxhash64("id", "text", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, n in sums.items():
                used = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(n[used])], ["lang", "bucket", "n"])

        for b in batches:
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                if (found := features(text.as_py())) is not None:
                    sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    sums[lang] += np.bincount(found, minlength=BUCKETS)
                    if len(sums) > 64:  # a task holds the counts of a bounded number of languages at once
                        yield from emit()
                        sums = {}
        yield from emit()

    counted = drawn.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(pc.unique(counted["lang"]).to_pylist()))
    number = pc.index_in(counted["lang"], pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    return Model.of(languages, number, counted["bucket"].to_numpy().astype(np.int64), counted["n"].to_numpy())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row; only the text decides, other columns are ignored.

    lang_pred is ``und`` with score 0 if the text is null or has no letter (or nothing was learned). Equal texts have
    equal results; repeated rows and null ids stay. Very long texts are counted whole; what is held of one is its
    characters and its counts. Ties of shares go to the first language by name. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shared.value.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", languages: frozenset[str] | None = None, least: float = 0.0) -> DataFrame:
    """docs without the rows that identification rejects, with all columns.

    A row goes if its text is null or has no letter, or if the languages asked for (all learned ones, if None) make up
    no more than ``least`` of its inferred mixture, or if random trigrams, each as likely as any other, make up more than
    MOST_RANDOM of it when they join it: then it is in none of the languages. A model that learned nothing can't tell
    languages, so then only texts without a letter go. Repeated rows, null ids and columns of any name stay. Empty table:
    no rows.
    """
    # by its exact name, or else in any case of letters
    where = docs.columns.index(text_col) if text_col in docs.columns else [c.lower() for c in docs.columns].index(text_col.lower())
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([shared.value.accepts(t.as_py(), languages, least) for t in b.column(where)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
