"""URL filters: rule lists held in Bloom filter cascades, which are exact over the corpus's own keys."""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm.common import new_folder, open_store, settle

#: False positive rates of the first level and of all others.
FIRST_RATE, NEXT_RATE = 0.02, 0.5
#: Bytes of one shard of a level, about. Keys are dealt to shards by a hash, so a list of any size has the same method.
SHARD_BYTES = 4 << 20
#: Bytes of shards that a worker process holds at once, read from the shared folder when they are first asked for.
HELD_BYTES = 64 << 20
MOST_LEVELS = 64

# The rules of the registered query, as (host and path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Hosts that the registered query blocks, with their subdomains, where no rule fits.
BLOCKED_HOSTS = ("spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_held: OrderedDict[str, np.ndarray] = OrderedDict()


def _shard(path: str) -> np.ndarray:
    """The words of one shard; the last ones used stay in memory, up to HELD_BYTES."""
    if path in _held:
        _held.move_to_end(path)
        return _held[path]
    store, where = open_store(path)
    with store.open_input_stream(where, compression=None) as stream:
        words = np.frombuffer(stream.read(), np.uint64)
    _held[path] = words
    while len(_held) > 1 and sum(w.nbytes for w in _held.values()) > HELD_BYTES:
        _held.popitem(last=False)
    return words


@dataclass(frozen=True)
class Bloom:
    """One level: bit arrays, one for each shard of the keys, in which a key, given as two 64-bit hashes, has ``probes`` places."""

    level: int
    bits: int
    probes: int
    paths: tuple[str | None, ...]

    @staticmethod
    def shape(keys: int, rate: float) -> tuple[int, int]:
        """(bits, probes) for so many keys."""
        bits = max(64, math.ceil(-max(keys, 1) * math.log(rate) / math.log(2) ** 2))
        return -(-bits // 64) * 64, max(1, round(bits / max(keys, 1) * math.log(2)))

    @staticmethod
    def shards(number: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (_mix(a ^ (b * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(number)).astype(np.int64)

    @staticmethod
    def places(level: int, bits: int, probes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(keys, probes) bit numbers; each level hashes anew, so its errors don't depend on those of others."""
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        a, b = _mix(a ^ salt), _mix(b + salt) | np.uint64(1)
        return (a[:, None] + b[:, None] * np.arange(probes, dtype=np.uint64)) % np.uint64(bits)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        shards = self.shards(len(self.paths), a, b)
        for shard in np.unique(shards):
            if self.paths[shard] is not None:  # a shard without keys was never written
                mine = np.nonzero(shards == shard)[0]
                at = self.places(self.level, self.bits, self.probes, a[mine], b[mine])
                out[mine] = (_shard(self.paths[shard])[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).all(axis=1)
        return out


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


class Cascade:
    """Exact membership of a key list over a universe of keys, as alternating Bloom filters.

    Level 0 holds the listed keys, level 1 the universe's other keys that pass level 0, level 2 the listed keys that
    pass level 1, and so on, until nothing passes. The first level that a key fails tells: an odd one, it is listed;
    an even one, it isn't. A key that fails none is listed if the number of levels is odd. This is exact for all keys
    of the universe (and says nothing about others), so lookups need neither the list nor a join. The bits grow with
    the list, not with the corpus; they are files of bounded size in the shared folder, of which a worker holds a few.
    """

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        listed = np.full(len(a), len(self.levels) % 2 == 1)
        open_ = np.arange(len(a))
        for n, level in enumerate(self.levels):
            passed = level.has(a[open_], b[open_])
            listed[open_[~passed]] = n % 2 == 1
            open_ = open_[passed]
            if not len(open_):
                break
        return listed

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, first_rate: float = FIRST_RATE, next_rate: float = NEXT_RATE, shard_bytes: int = SHARD_BYTES) -> Cascade:
        """From listed(key) and universe(key), which may hold repeated keys; null keys are left out."""
        pairs = lambda df: df.where("key is not null").select(_hashes(F.col("key"))[0].alias("a"), _hashes(F.col("key"))[1].alias("b"))
        inside, _ = settle(pairs(listed).distinct(), "cascade-listed")
        levels: list[Bloom] = []
        due, other = inside, None
        for n in range(MOST_LEVELS):
            keys = due.count()
            if not keys:
                return Cascade(levels)
            rate = first_rate if n == 0 else next_rate
            shards = -(-Bloom.shape(keys, rate)[0] // (8 * shard_bytes))
            levels.append(_enter(due, n, *Bloom.shape(-(-keys // shards), rate), shards))
            if n == 0:  # from here on only those keys of the universe matter that pass level 0 and aren't listed
                passed = _passing(pairs(universe), levels[0]).distinct()
                other, _ = settle(passed.join(inside, ["a", "b"], "left_anti"), "cascade-passed")
                due, other = other, inside
            else:
                due, other = settle(_passing(other, levels[-1]), "cascade-level")[0], due
        raise ValueError("the cascade doesn't end: a listed key and another one have the same two hashes")


def _enter(keys: DataFrame, level: int, bits: int, probes: int, shards: int) -> Bloom:
    """A level's bits, set on the executors, combined by word and written there; the driver gets the files' names alone."""
    spark = keys.sparkSession
    folder = new_folder(spark, f"cascade-bits-{level}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            at = Bloom.places(level, bits, probes, a, b) + (Bloom.shards(shards, a, b).astype(np.uint64) * np.uint64(bits))[:, None]
            at = np.unique(at)
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            set_bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array((word // np.uint64(bits // 64)).astype(np.int32)), pa.array((word % np.uint64(bits // 64)).astype(np.int64)), pa.array(set_bits.view(np.int64))], ["shard", "word", "bits"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; a shard's file is closed when the next begins. A repeated task writes other names."""
        name = f"{folder}/{TaskContext.get().taskAttemptId()}"
        held, words = None, np.zeros(bits // 64, np.uint64)

        def close() -> pa.RecordBatch:
            store, where = open_store(f"{name}-{held}")
            with store.open_output_stream(where, compression=None) as out:
                out.write(words.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([f"{name}-{held}"])], ["shard", "path"])

        for batch in batches:
            shard, word, found = (batch.column(i).to_numpy() for i in range(3))
            for s in np.unique(shard).tolist():
                if s != held:
                    if held is not None:
                        yield close()
                    held, words = s, np.zeros(bits // 64, np.uint64)
                mine = shard == s
                words[word[mine]] |= found[mine].view(np.uint64)
        if held is not None:
            yield close()

    rows = keys.select("a", "b").mapInArrow(run, "shard int, word long, bits long").groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
    rows = rows.repartition("shard").sortWithinPartitions("shard").select("shard", "word", "bits").mapInArrow(write, "shard int, path string")
    paths = {r.shard: r.path for r in settle(rows, "cascade-files")[0].collect()}
    return Bloom(level, bits, probes, tuple(paths.get(s) for s in range(shards)))


def _passing(keys: DataFrame, level: Bloom) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
            yield batch.filter(pa.array(level.has(a, b)))

    return keys.select("a", "b").mapInArrow(run, "a long, b long")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys a rule could have to fit: for each (labels, characters), the host's last labels + the path's first characters."""
    labels = F.split(host, r"\.")
    keys = []
    for n, m in shapes:
        tail = F.array_join(F.slice(labels, -n, n), ".")
        keys.append(F.when((F.size(labels) >= n) & (host != "") & (F.char_length(path) >= m), F.concat(tail, F.substring(path, 1, m))))
    return F.array_compact(F.array(*keys))


def judge(pages: DataFrame, rules: list[tuple[str, str]], blocked_hosts: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    rules: (host followed by path, allow or block). A rule fits its host and all subdomains of it, if the url's path
    starts with the rule's; the longest fitting rule decides. Where none fits, urls of blocked_hosts(key) and their
    subdomains are blocked and all others allowed. A null url, or one without ``://``, has an empty host and path,
    which no rule fits. Repeated rows, ties of ids and null ids stay, other columns are ignored. Very long urls are
    looked up whole, by as many of their last labels as the longest listed host has. Empty table: no rows.

    Urls are split once and written. One cascade holds the allowing, one the blocking rules, one the hosts, however
    many they are; each is built against all keys that the pages' urls can look up.
    """
    spark: SparkSession = pages.sparkSession
    shapes = sorted({(r.split("/", 1)[0].count(".") + 1, len(r) - len(r.split("/", 1)[0])) for r, _ in rules})
    url = F.col(url_col).cast("string")
    rows, _ = settle(pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path")), "urls")
    keyed = rows.withColumn("keys", _candidates(F.col("host"), F.col("path"), shapes))
    universe = keyed.select(F.explode("keys").alias("key"))
    held = []
    for verdict in ("allow", "block"):
        mine = sorted({r for r, v in rules if v == verdict})
        held.append(Cascade.build(spark.createDataFrame([(r,) for r in mine], "key string"), universe, shard_bytes=shard_bytes))
    # a host has as many suffixes as labels; none longer than the longest listed host can be listed
    labels = 0 if blocked_hosts is None else blocked_hosts.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first().n or 0
    suffixes = F.expr(rf"CASE WHEN {labels} > 0 THEN transform(sequence(1, least({labels}, size(split(host, '\\.')))), n -> substring_index(host, '.', -n)) ELSE array() END").cast("array<string>")
    hosts = Cascade([])
    if labels:
        hosts = Cascade.build(blocked_hosts.select("key"), rows.select("host").distinct().select(F.explode(suffixes).alias("key")), shard_bytes=shard_bytes)
    pair = lambda arr: (F.transform(arr, lambda k: _hashes(k)[0]), F.transform(arr, lambda k: _hashes(k)[1]))
    allowed, blocked = held
    asked = keyed.withColumns({"ka": pair("keys")[0], "kb": pair("keys")[1], "ha": pair(suffixes)[0], "hb": pair(suffixes)[1]})

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.append(0, np.cumsum(np.diff(column.offsets.to_numpy())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, at = flat(batch.column(4))
            b, _ = flat(batch.column(5))
            yes, no = allowed.has(a, b), blocked.has(a, b)
            keys = batch.column(3).flatten()
            a, host_at = flat(batch.column(6))
            listed = np.append(0, np.cumsum(hosts.has(a, flat(batch.column(7))[0])))
            fallback = listed[host_at[1:]] > listed[host_at[:-1]]
            rule: list[str | None] = [None] * batch.num_rows
            verdict = np.where(fallback, "block", "allow").tolist()
            hit = np.nonzero(yes | no)[0]
            for row, k in zip((np.searchsorted(at, hit, side="right") - 1).tolist(), hit.tolist()):
                key = keys[k].as_py()
                if rule[row] is None or (len(key), key) > (len(rule[row]), rule[row]):
                    rule[row], verdict[row] = key, "block" if no[k] else "allow"
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    return asked.select("page_id", "host", "path", "keys", "ka", "kb", "ha", "hb").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def oracle() -> str:
    """The registered query in DuckDB's SQL."""
    values = ", ".join(f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in RULES)
    hosts = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {values}), blocked(bad) AS (VALUES {hosts}),
split AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fits AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY r),
bad AS (SELECT DISTINCT r FROM split JOIN blocked ON host = bad OR ends_with(host, '.' || bad))
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN bad.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM split LEFT JOIN fits ON split.r = fits.r LEFT JOIN bad ON split.r = bad.r"""
