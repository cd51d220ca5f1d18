"""A store of items with their indexes: one state of all of them, changed by segments.

Each segment holds items and what was made from them: text postings for each configuration, trigram postings, and vectors in
lists. A reader opens the state that the pointer names, so no index can differ from its items. A store may also index a
table that lies elsewhere; then it holds the version of that table, and is made anew when that has changed.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.operators import bitmaps as BM
from seekframe.operators import gramindex as G
from seekframe.operators import segments as S
from seekframe.operators import textindex as X
from seekframe.operators import vectorindex as VI
from seekframe.operators.indexing import newest
from seekframe.operators.search import Items
from seekframe.plans.model import IndexSpec, SpecError


@dataclass(frozen=True)
class Layout:
    """What a store keeps. texts: text configurations; grams: fields with trigram postings; vectors: vector fields; bitmaps:
    facet fields, in a store that is made anew when its items change; items: whether the items themselves are kept."""

    index: IndexSpec
    texts: tuple[str, ...] = ("simple",)
    grams: tuple[str, ...] = ()
    vectors: tuple[str, ...] = ()
    bitmaps: tuple[str, ...] = ()
    items: bool = True
    files: int = 8


def _tables(spark: SparkSession, folder: str, layout: Layout, items: DataFrame, fitted: dict, files: int) -> tuple[int, dict]:
    """Write the tables of one segment; (its items, what is known of its vector lists)."""
    index = layout.index
    if layout.items:
        items.write.parquet(f"{folder}/items")
        items = spark.read.parquet(f"{folder}/items")
    about: dict = {}
    for config in layout.texts:
        X.write(X.build(items, index, config), f"{folder}/text-{config}", files)
    for name in layout.grams:
        if index.field(name).multi_value:
            raise SpecError(f"{name}: trigrams are of fields with one value")
        G.write(G.build(items, index.id_col, name), f"{folder}/grams-{name}", files)
    for name in layout.bitmaps:
        BM.write(BM.build(items, index, name), f"{folder}/bitmaps-{name}", files)
    for name in layout.vectors:
        rows = items.select(F.col(index.id_col).alias("id"), F.col(name).cast("array<double>").alias("vector"))
        about[name] = list(VI.write_items(VI.assigned(rows, np.array(fitted[name]["centroids"])), f"{folder}/vectors-{name}").items())
    return items.count(), about


def create(spark: SparkSession, path: str, layout: Layout, items: DataFrame, source: str = "") -> S.Manifest:
    """Make a store of these items, in place of what it holds; readers of what it held may go on."""
    fitted = {}
    for name in layout.vectors:
        rows = items.select(F.col(layout.index.id_col).alias("id"), F.col(name).cast("array<double>").alias("vector"))
        centroids, probes = VI._fitted(rows, layout.index.field(name).dimensions, None, 10, 42)
        fitted[name] = {"centroids": centroids.tolist(), "probes": probes}
    folder = f"s-{uuid.uuid4().hex}"
    rows, about = _tables(spark, f"{path}/{folder}", layout, items, fitted, layout.files)
    kind = items.schema[layout.index.id_col].dataType.simpleString()
    return S.publish(spark, path, S.Manifest((S.Segment(folder, 1, rows, 0, about),), source, {"vectors": fitted, "kind": kind}))


def _loaded(spark: SparkSession, path: str, layout: Layout, manifest: S.Manifest, segments: tuple[S.Segment, ...] | None = None) -> tuple[DataFrame | None, dict, dict, dict]:
    """(items, text indexes, trigram indexes, vector indexes) of a state, or of some of its segments."""
    def of(table: str, id_col: str = "id") -> DataFrame:
        return S.live(spark, path, manifest, lambda folder: spark.read.parquet(f"{folder}/{table}"), id_col, segments)

    chosen = manifest.segments if segments is None else segments
    items = of("items", layout.index.id_col) if layout.items else None
    texts = {c: X._of(of(f"text-{c}/postings"), c) for c in layout.texts}
    counts = lambda n: [spark.read.parquet(f"{path}/{s.name}/grams-{n}/counts") for s in chosen]
    grams = {}
    for n in layout.grams:
        every, *more = counts(n)
        for x in more:
            every = every.unionByName(x)
        grams[n] = G.GramIndex(of(f"grams-{n}/postings"), every)
    vectors = {}
    for n in layout.vectors:
        fitted, spans = manifest.about["vectors"][n], {}
        for s in chosen:
            for k, (least, most, rows) in s.about[n]:
                a, b, c = spans.get(k, (least, most, 0))
                spans[k] = (min(a, least), max(b, most), c + rows)
        rows = S.live(spark, path, manifest, lambda folder, n=n: VI.read_items(spark, f"{folder}/vectors-{n}", manifest.about["kind"]), "id", segments)
        vectors[n] = VI.VectorIndex(rows, np.array(fitted["centroids"]), fitted["probes"], spans)
    return items, texts, grams, vectors


def open_(spark: SparkSession, path: str, layout: Layout, base: DataFrame | None = None, sides: tuple[DataFrame, ...] = (), source: str | None = None) -> Items:
    """The store's current items and indexes, for search. base: the items, where the store doesn't keep them; source: their
    version, which must be the one that the store was made from."""
    manifest = S.current(spark, path)
    if manifest is None:
        raise SpecError(f"no store at {path}")
    if source is not None and manifest.source != source:
        raise SpecError(f"the store at {path} was made from another state of its table")
    items, texts, grams, vectors = _loaded(spark, path, layout, manifest)
    if items is None and base is None:
        raise SpecError("this store keeps no items: give the table that they are in")
    bitmaps = {n: BM.read(spark, f"{path}/{manifest.segments[0].name}/bitmaps-{n}") for n in layout.bitmaps}
    return Items(items if base is None else base, sides, texts, vectors, grams, bitmaps)


def apply(spark: SparkSession, path: str, layout: Layout, changes: DataFrame | None = None, gone: DataFrame | None = None, source: str | None = None) -> S.Manifest:
    """Upsert whole items (the last of each id, in no order of their own, wins), and delete ids; null ids are only added.

    Only the changes are indexed and written, with their ids. New vectors go to the lists there are. Segments are merged when
    they are due; lists that have outgrown the others are split then, and recall is measured again.
    """
    manifest = S.current(spark, path)
    if manifest is None:
        raise SpecError(f"no store at {path}")
    if layout.bitmaps:
        raise SpecError("a store with bitmaps is made anew: a bit can't be taken back from an older segment")
    index, folder = layout.index, f"s-{uuid.uuid4().hex}"
    template = S.live(spark, path, manifest, lambda f: spark.read.parquet(f"{f}/items"), index.id_col) if layout.items else None
    if changes is None:
        if template is None:
            raise SpecError("a store without items is changed by whole items")
        changes = template.where(F.lit(False))
    new = newest(changes, index.id_col)
    if template is not None:
        new = new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in template.schema))
    dead = new.select(F.col(index.id_col).alias("id"))
    if gone is not None:
        dead = dead.union(gone.select(F.col(index.id_col).cast(manifest.about["kind"]).alias("id")))
    dead.where("id is not null").distinct().write.parquet(f"{path}/{folder}/gone")
    n = spark.read.parquet(f"{path}/{folder}/gone").count()
    fitted = manifest.about["vectors"]
    rows, about = _tables(spark, f"{path}/{folder}", layout, new, fitted, 1)
    after = replace(manifest, segments=(*manifest.segments, S.Segment(folder, manifest.newest + 1, rows, n, about)), source=manifest.source if source is None else source)
    return S.publish(spark, path, _merge(spark, path, layout, after))


def _merge(spark: SparkSession, path: str, layout: Layout, manifest: S.Manifest) -> S.Manifest:
    _, _, _, vectors = _loaded(spark, path, layout, manifest)
    grown = {n: lists for n, v in vectors.items() if (lists := VI.outgrown(v.spans))}
    chosen = manifest.segments if grown else S.due(manifest)
    if not chosen or not layout.items and not grown:
        return manifest
    if not layout.items:
        raise SpecError("a store without items can't be merged: make it anew")
    fitted = dict(manifest.about["vectors"])

    def write(folder: str, inner: S.Manifest) -> tuple[int, dict]:
        items, texts, grams, vectors = _loaded(spark, path, layout, inner)
        items.write.parquet(f"{folder}/items")
        files, about = layout.files if len(chosen) == len(manifest.segments) else 1, {}
        for c, built in texts.items():
            X.write(built, f"{folder}/text-{c}", files)
        for n, built in grams.items():
            G.write(built.postings, f"{folder}/grams-{n}", files)
        for n, built in vectors.items():
            if n in grown:
                built = VI.split(built, grown[n])
                spans = VI.write_items(built.items, f"{folder}/vectors-{n}")
                again = replace(built, items=VI.read_items(spark, f"{folder}/vectors-{n}", manifest.about["kind"]), spans=spans)
                fitted[n] = {"centroids": built.centroids.tolist(), "probes": VI.enough_probes(again)}
            else:
                spans = VI.write_items(built.items, f"{folder}/vectors-{n}")
            about[n] = list(spans.items())
        return spark.read.parquet(f"{folder}/items").count(), about

    after = S.merged(spark, path, manifest, chosen, write)
    return replace(after, about={**manifest.about, "vectors": fitted})


def upsert(spark: SparkSession, path: str, layout: Layout, changes: DataFrame) -> S.Manifest:
    return apply(spark, path, layout, changes)


def delete(spark: SparkSession, path: str, layout: Layout, ids: DataFrame) -> S.Manifest:
    return apply(spark, path, layout, None, ids)
