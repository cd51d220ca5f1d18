"""Embeddings from a provider: protocol, deterministic stub, retries, circuit breaker, cache and batching."""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.functions import prepare as P
from seekframe.operators.indexing import read_table, replace_table
from seekframe.operators.ordered import greedy
from seekframe.operators.segments import store
from seekframe.plans.query import Query, VectorQuery
from seekframe.sources.tables import settled

# Dimensions of published embedding models, and limits of one call to an embedding service.
MODEL_DIMENSIONS = {"text-embedding-ada-002": 1536, "text-embedding-3-small": 1536, "text-embedding-3-large": 3072}
CALL_INPUTS, CALL_TOKENS = 2048, 8192
RETRY_CODES = frozenset({429, 500, 502, 503, 504})
MAX_ENTRIES = 100_000


class ProviderError(Exception):
    def __init__(self, message: str, code: int | None = None):
        super().__init__(message)
        self.code = code


class Provider(Protocol):
    """What an embedding service must offer; objects are pickled to executors."""

    dimensions: int

    def embed(self, texts: Sequence[str]) -> list[list[float]]: ...

    def available(self) -> bool: ...


@dataclass(frozen=True)
class HashProvider:
    """A stand-in without a network: tokens are hashed to signed dimensions, the result has length one."""

    dimensions: int = 64

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = [0.0] * self.dimensions
            for token in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "big")
                v[h % self.dimensions] += 1.0 if h >> 63 else -1.0
            length = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / length for x in v])
        return out

    def available(self) -> bool:
        return True


@dataclass
class CircuitBreaker:
    """closed, open after so many failures in a row, half-open after a while, closed again after so many successes."""

    failures_to_open: int = 5
    reset_seconds: float = 60
    successes_to_close: int = 3
    clock: Callable[[], float] = time.monotonic
    state: str = "closed"
    _failures: int = 0
    _successes: int = 0
    _opened: float = field(default=0.0, repr=False)

    def allows(self) -> bool:
        if self.state == "open" and self.clock() - self._opened >= self.reset_seconds:
            self.state, self._successes = "half_open", 0
        return self.state != "open"

    def record(self, success: bool) -> None:
        if success:
            self._failures = 0
            if self.state == "half_open":
                self._successes += 1
                if self._successes >= self.successes_to_close:
                    self.state = "closed"
            return
        self._failures += 1
        if self.state == "half_open" or self._failures >= self.failures_to_open:
            self.state, self._opened, self._failures = "open", self.clock(), 0


@dataclass
class Resilient:
    """A provider with retries (doubling waits and jitter), a breaker, and one-by-one calls if a batch fails."""

    inner: Provider
    retries: int = 3
    wait_ms: float = 1000
    breaker: CircuitBreaker = field(default_factory=CircuitBreaker)
    sleep: Callable[[float], None] = time.sleep

    @property
    def dimensions(self) -> int:
        return self.inner.dimensions

    def available(self) -> bool:
        return self.breaker.allows() and self.inner.available()

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        if not self.breaker.allows():
            raise ProviderError("the service is resting after failures", 503)
        for attempt in range(self.retries + 1):
            try:
                out = self.inner.embed(texts)
                if len(out) != len(texts):
                    raise ProviderError(f"{len(texts)} texts, {len(out)} embeddings")
                self.breaker.record(True)
                return out
            except ProviderError as e:
                if e.code not in RETRY_CODES or attempt == self.retries:
                    self.breaker.record(False)
                    raise
                self.sleep(self.wait_ms * 2**attempt * (1 + random.random() / 10) / 1000)
        raise AssertionError

    def embed_partly(self, texts: Sequence[str]) -> list[tuple[list[float] | None, str | None]]:
        """(embedding, error) for each text; if the batch fails each text is tried by itself."""
        try:
            return [(v, None) for v in self.embed(texts)]
        except ProviderError as e:
            if len(texts) == 1:
                return [(None, str(e))]
            return [self.embed_partly([t])[0] for t in texts]


def batches(tokens: Sequence[int], most_inputs: int = CALL_INPUTS, most_tokens: int = CALL_TOKENS) -> list[int]:
    """The batch number of each input: filled in order until inputs or tokens run out; a larger input stands alone."""
    out, batch, held, total = [], 0, 0, 0
    for t in tokens:
        if held and (held >= most_inputs or total + t > most_tokens):
            batch, held, total = batch + 1, 0, 0
        out.append(batch)
        held, total = held + 1, total + t
    return out


def embed(rows: DataFrame, provider: Provider, key: str, text: str) -> DataFrame:
    """(key, embedding, error) for each row: calls of bounded size from each task; a failed text has an error."""
    kind = rows.schema[key].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrapped = provider if isinstance(provider, Resilient) else Resilient(provider, retries=0)
        for b in parts:
            texts = [t or "" for t in b.column(1).to_pylist()]
            numbers = batches([-(-len(t.encode()) // 4) for t in texts])
            got: list[tuple[list[float] | None, str | None]] = []
            at = 0
            while at < len(texts):
                end = at + numbers[at:].count(numbers[at])
                got += wrapped.embed_partly(texts[at:end])
                at = end
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v for v, _ in got], pa.list_(pa.float32())), pa.array([e for _, e in got], pa.string())], ["key", "embedding", "error"])

    out = rows.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, embedding array<float>, error string")
    return out.withColumnRenamed("key", key)


def valid_entries(cache: DataFrame, now: int) -> DataFrame:
    return cache.where((F.col("expires") > now) & F.col("text_hash").rlike("^[0-9a-f]{64}$"))


def lookup(wanted: DataFrame, cache: DataFrame, now: int) -> DataFrame:
    """wanted(text_hash, ...) with embedding and hit; every asked position stays, equal texts included."""
    held = valid_entries(cache, now).select("text_hash", "embedding", F.lit(True).alias("_hit"))
    return wanted.join(held, "text_hash", "left").withColumn("hit", F.coalesce("_hit", F.lit(False))).drop("_hit")


def evict(cache: DataFrame, now: int, most: int = MAX_ENTRIES) -> DataFrame:
    """Unexpired entries, of these the most recently (then most often) used ones; a top-k, so nothing is ranked whole."""
    alive = valid_entries(cache, now)
    return alive.orderBy(F.desc("last_accessed"), F.desc("hit_count"), "text_hash").limit(most)


def put(cache: DataFrame, entries: DataFrame) -> DataFrame:
    """cache with entries set; of several for one hash the last created stays."""
    columns = [c for c in cache.columns if c != "text_hash"]
    newest = entries.groupBy("text_hash").agg(F.max_by(F.struct(*columns), "created").alias("r")).select("text_hash", *(F.col(f"r.{c}").alias(c) for c in columns))
    return cache.join(newest.select("text_hash"), "text_hash", "left_anti").select(*cache.columns).unionByName(newest.select(*cache.columns))


def fill(items: DataFrame, cache: DataFrame, provider: Provider, now: int, ttl: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(items with content_embedding and error, new cache entries): only texts that the cache lacks are embedded, once each."""
    hashed = items.withColumn("text_hash", P.cache_key(F.col(text)))
    found = lookup(hashed, cache, now)
    missing = found.where("not hit").groupBy("text_hash").agg(F.min(text).alias(text))
    made = embed(missing, provider, "text_hash", text)
    joined = found.join(made.select("text_hash", F.col("embedding").alias("_made"), "error"), "text_hash", "left")
    out = joined.withColumn("content_embedding", F.coalesce("embedding", "_made")).drop("embedding", "_made", "hit", "text_hash")
    entries = made.where("error is null").select("text_hash", "embedding", F.size("embedding").alias("dimensions"), F.lit(now).cast("long").alias("created"), F.lit(now).cast("long").alias("last_accessed"), F.lit(now + ttl).cast("long").alias("expires"), F.lit(0).alias("hit_count"))
    return out, entries


def call_numbers(rows: DataFrame, order: str, tokens: str, most_inputs: int = CALL_INPUTS, most_tokens: int = CALL_TOKENS) -> DataFrame:
    """(order, tokens, call): the call that takes each row's text, filled one after another in that order, as ``batches``."""
    return greedy(rows, order, tokens, most_inputs, most_tokens)


def touch(asked: DataFrame, cache: DataFrame, now: int, log: str) -> DataFrame:
    """``lookup``, with each hash that is found noted in a log: one hit for a hash and look-up, appended and never rewritten."""
    found = settled(lookup(asked, cache, now), "cache-found")
    found.where("hit").select("text_hash", F.lit(now).cast("long").alias("at")).distinct().write.parquet(f"{log}/hits-{uuid.uuid4().hex}")
    return found


def _hits(spark: SparkSession, log: str) -> tuple[DataFrame, list[str]]:
    """All hits that are noted now, and their folders."""
    fs, where = store(spark, log)
    found = sorted(x.getPath().toString() for x in fs.listStatus(where) if x.getPath().getName().startswith("hits-")) if fs.exists(where) else []
    kind = "text_hash string, at long"
    return (spark.read.schema(kind).parquet(*found) if found else spark.createDataFrame([], kind)), found


def folded(cache: DataFrame, hits: DataFrame) -> DataFrame:
    """cache with hits(text_hash, at) counted in hit_count and last_accessed."""
    sums = hits.groupBy("text_hash").agg(F.count(F.lit(1)).alias("_n"), F.max("at").alias("_at"))
    kinds = {f.name: f.dataType for f in cache.schema}
    met = cache.join(sums, "text_hash", "left")
    return met.withColumns({"hit_count": (F.col("hit_count") + F.coalesce("_n", F.lit(0))).cast(kinds["hit_count"]), "last_accessed": F.greatest("last_accessed", "_at").cast(kinds["last_accessed"])}).select(*cache.columns)


def with_hits(cache: DataFrame, log: str) -> DataFrame:
    """The cache as its log leaves it."""
    return folded(cache, _hits(cache.sparkSession, log)[0])


def compact(spark: SparkSession, path: str, log: str, now: int, most: int = MAX_ENTRIES) -> None:
    """Write the cache at path (a table of ``indexing.replace_table``) anew, with its log folded in and what is over evicted.

    Hits that come meanwhile stay in the log for the next time.
    """
    hits, read = _hits(spark, log)
    replace_table(evict(folded(read_table(spark, path), hits), now, most), path)
    for folder in read:
        fs, where = store(spark, folder)
        fs.delete(where, True)


def invalidate(cache: DataFrame, hashes: DataFrame | None = None, model: str | None = None, index: str | None = None) -> DataFrame:
    """cache without the entries that are void: of these hashes(text_hash), or of a model, an index, or one in the other.

    Without any of the three nothing is void. Entries without a model or index are of none.
    """
    conditions = [F.col(c).eqNullSafe(F.lit(v)) for c, v in (("model", model), ("index_id", index)) if v is not None]
    if conditions:
        cache = cache.where(~reduce(lambda a, b: a & b, conditions))
    return cache if hashes is None else cache.join(hashes.select("text_hash"), "text_hash", "left_anti")


def forget(cache: DataFrame, used: DataFrame, gone: DataFrame) -> DataFrame:
    """cache without the entries whose texts only items gone(item_id) use; used(item_id, text_hash) is what items use."""
    of_gone = used.join(gone.select("item_id"), "item_id", "left_semi").select("text_hash").distinct()
    kept = used.join(gone.select("item_id"), "item_id", "left_anti").select("text_hash").distinct()
    return invalidate(cache, of_gone.join(kept, "text_hash", "left_anti"))


def _post(url: str, headers: dict[str, str], body: bytes, timeout: float) -> tuple[int, bytes]:
    request = urllib.request.Request(url, body, headers, method="POST")
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()
    except OSError as e:
        raise ProviderError(f"no answer from {url}: {e}", 503) from e


@dataclass(frozen=True)
class HttpProvider:
    """An embedding service over HTTP. ``transport`` sends (url, headers, body, timeout) and gives (status, body)."""

    url: str
    headers: dict[str, str] = field(repr=False)
    model: str | None
    dimensions: int
    most_inputs: int = CALL_INPUTS
    timeout: float = 30
    transport: Callable[[str, dict[str, str], bytes, float], tuple[int, bytes]] = field(default=_post, repr=False)

    @staticmethod
    def openai(key: str, model: str = "text-embedding-3-small", base: str = "https://api.openai.com/v1", **more) -> HttpProvider:
        return HttpProvider(f"{base}/embeddings", {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}, model, more.pop("dimensions", MODEL_DIMENSIONS.get(model, 1536)), **more)

    @staticmethod
    def azure(key: str, endpoint: str, deployment: str, version: str = "2024-02-01", dimensions: int = 1536, **more) -> HttpProvider:
        """A deployment names its model, and takes fewer inputs at once."""
        return HttpProvider(f"{endpoint.rstrip('/')}/openai/deployments/{deployment}/embeddings?api-version={version}", {"api-key": key, "Content-Type": "application/json"}, None, dimensions, more.pop("most_inputs", 16), **more)

    def embed(self, texts: Sequence[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for at in range(0, len(texts), self.most_inputs):
            part = list(texts[at : at + self.most_inputs])
            body = {"input": part} | ({"model": self.model} if self.model else {})
            status, raw = self.transport(self.url, self.headers, json.dumps(body).encode(), self.timeout)
            if status != 200:
                raise ProviderError(f"status {status}", status)
            try:
                found = {x["index"]: x["embedding"] for x in json.loads(raw)["data"]}
                made = [found[i] for i in range(len(part))]
            except (ValueError, KeyError, TypeError) as e:
                raise ProviderError(f"an answer that can't be read: {e}") from e
            if any(len(v) != self.dimensions for v in made):
                raise ProviderError(f"embeddings that don't have {self.dimensions} dimensions")
            out += made
        return out

    def available(self) -> bool:
        return bool(self.url)


def vector_for(query: Query, provider: Provider, text: str, **how) -> tuple[Query, dict | None]:
    """(query with the vector of a text, None); if the provider can't embed it, (a text query, why)."""
    reason = None
    try:
        made = provider.embed([text]) if text.strip() and provider.available() else []
        if not made or not made[0]:
            reason = "no embedding"
    except ProviderError as e:
        reason = str(e)
    if reason is None:
        return replace(query, vector=VectorQuery(tuple(made[0]), **how)), None
    return replace(query, vector=None, mode="text_only"), {"degraded": True, "reason": reason, "strategy": "text_only", "message": "searched by text alone"}


def breaker_states(calls: DataFrame, server: str, call: str, at: str, good: str, failures_to_open: int = 5, reset_seconds: float = 60, successes_to_close: int = 3) -> DataFrame:
    """(server, call, state): the breaker's state after each call of a server, in order of time, then of call.

    Calls are sorted within their server and read as a stream; a server's breaker is all that is held.
    """
    kinds = [calls.schema[c].dataType.simpleString() for c in (server, call)]

    def replay(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, breaker = [0.0], object(), None
        for b in parts:
            states = []
            for who, when, well in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if breaker is None or who != held:
                    held, breaker = who, CircuitBreaker(failures_to_open, reset_seconds, successes_to_close, clock=lambda: now[0])
                now[0] = float(when)
                if breaker.allows():
                    breaker.record(bool(well))
                states.append(breaker.state)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(states, pa.string())], ["server", "call", "state"])

    rows = calls.select(F.col(server).alias("server"), F.col(call).alias("call"), F.col(at).alias("at"), F.col(good).alias("good"))
    out = rows.repartition("server").sortWithinPartitions("server", "at", "call").mapInArrow(replay, f"server {kinds[0]}, call {kinds[1]}, state string")
    return out.withColumnsRenamed({"server": server, "call": call})
