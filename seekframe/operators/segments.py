"""Stored tables in segments: small changes are small writes, and readers see one state of all tables or the next.

A store is a folder. Each change writes one segment, a folder of tables with the ids that it replaces or deletes
("gone"), and then a manifest that lists all segments; a pointer, moved into place in one step, names the manifest.
Rows of older segments whose ids are gone in a newer one don't count. Segments are merged by size: when the newest have
grown to a fraction of the one before them, so that each row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.plans.model import SpecError

POINTER = "current"
#: A segment is merged with those after it once together they are at least 1 / RATIO of its rows.
RATIO = 4
#: Ids up to which the gone of all segments are broadcast.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Segment:
    name: str
    seq: int
    rows: int
    gone: int = 0
    about: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Manifest:
    """What a store holds: its segments, oldest first; source: the version of what it was made from; about: settings."""

    segments: tuple[Segment, ...] = ()
    source: str = ""
    about: dict = field(default_factory=dict)

    @property
    def newest(self) -> int:
        return max((s.seq for s in self.segments), default=0)


def store(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def version(spark: SparkSession, path: str) -> str:
    """A digest of a table's files (names, lengths, times), which changes when the table does; '' if there is none."""
    fs, where = store(spark, path)
    if not fs.exists(where):
        return ""
    files, found = fs.listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return uuid.uuid5(uuid.NAMESPACE_URL, "\n".join(sorted(found))).hex


def point(spark: SparkSession, path: str, name: str) -> None:
    """Let the pointer of a folder name something, in one step: there is no moment without a pointer."""
    jvm = spark._jvm
    fs, fresh = store(spark, f"{path}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(f"{name}\n".encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), overwrite)


def pointed(spark: SparkSession, path: str) -> str | None:
    """The name that a folder's pointer holds."""
    fs, pointer = store(spark, f"{path}/{POINTER}")
    return spark.read.text(pointer.toString(), wholetext=True).first().value.strip() if fs.exists(pointer) else None


def current(spark: SparkSession, path: str) -> Manifest | None:
    name = pointed(spark, path)
    if name is None:
        return None
    read = json.loads(spark.read.text(f"{path}/{name}", wholetext=True).first().value)
    return Manifest(tuple(Segment(**s) for s in read["segments"]), read["source"], read["about"])


def publish(spark: SparkSession, path: str, manifest: Manifest) -> Manifest:
    """Make a manifest the current one. Segments of the one before stay for its readers; older ones go."""
    before = current(spark, path)
    name = f"m-{uuid.uuid4().hex}.json"
    fs, where = store(spark, f"{path}/{name}")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    old = pointed(spark, path)
    point(spark, path, name)
    keep = {name, old} | {s.name for m in (manifest, before) if m for s in m.segments}
    for x in fs.listStatus(store(spark, path)[1]):
        this = x.getPath().getName()
        if this.startswith(("s-", "m-")) and this not in keep:
            fs.delete(x.getPath(), True)
    return manifest


def gone(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame | None:
    """(gone_id, gone_seq): for each id that a segment replaces or deletes, the newest that does; None if none does."""
    with_gone = [s for s in manifest.segments if s.gone]
    if not with_gone:
        return None
    each = [spark.read.parquet(f"{path}/{s.name}/gone").select(F.col("id").alias("gone_id"), F.lit(s.seq).alias("gone_seq")) for s in with_gone]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    out = out.groupBy("gone_id").agg(F.max("gone_seq").alias("gone_seq"))
    return F.broadcast(out) if sum(s.gone for s in with_gone) <= BROADCAST_IDS else out


def live(spark: SparkSession, path: str, manifest: Manifest, read: Callable[[str], DataFrame], id_col: str = "id", segments: tuple[Segment, ...] | None = None) -> DataFrame:
    """The rows of one table in all segments (or some of them) that no newer segment replaces or deletes.

    read gives the table in a segment's folder. Filters on its columns reach the scans, as a union and an anti join let
    them through. Rows with null ids are never gone.
    """
    segments = manifest.segments if segments is None else segments
    if not segments:
        raise SpecError(f"nothing is stored at {path}")
    parts = [read(f"{path}/{s.name}").withColumn("_seq", F.lit(s.seq)) for s in segments]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    dead = gone(spark, path, manifest)
    if dead is not None:
        out = out.join(dead, (F.col(id_col) == F.col("gone_id")) & (F.col("_seq") < F.col("gone_seq")), "left_anti")
    return out.drop("_seq")


def due(manifest: Manifest) -> tuple[Segment, ...]:
    """The newest segments that should become one, if any."""
    sizes = [s.rows + s.gone for s in manifest.segments]
    first = len(sizes)
    total = 0
    for k in range(len(sizes) - 1, -1, -1):
        if first < len(sizes) and total * RATIO < sizes[k]:
            break
        total += sizes[k]
        first = k
    return manifest.segments[first:] if len(sizes) - first > 1 else ()


def merged(spark: SparkSession, path: str, manifest: Manifest, chosen: tuple[Segment, ...], write: Callable[[str, Manifest], tuple[int, dict]]) -> Manifest:
    """The manifest after chosen segments, the newest ones, became one. write(folder, manifest of them) writes its tables.

    What they hold as gone is kept as long as there are older segments.
    """
    name = f"s-{uuid.uuid4().hex}"
    inner = replace(manifest, segments=chosen)
    rows, about = write(f"{path}/{name}", inner)
    older = manifest.segments[: len(manifest.segments) - len(chosen)]
    dead, n = gone(spark, path, inner), 0
    if older and dead is not None:
        dead.select(F.col("gone_id").alias("id")).write.parquet(f"{path}/{name}/gone")
        n = spark.read.parquet(f"{path}/{name}/gone").count()
    return replace(manifest, segments=(*older, Segment(name, chosen[-1].seq, rows, n, about)))
