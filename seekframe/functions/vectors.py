"""Vector arithmetic as Columns over arrays, accumulated in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.plans.model import MAX_DIMENSIONS


def literal(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in values))


def _double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(_double(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def normalise(a: Column) -> Column:
    """Scaled to length one; null for a zero vector."""
    length = norm(a)
    return F.when(length > 0, F.transform(_double(a), lambda x: x / length))


def is_valid(a: Column, dimensions: int | None = None) -> Column:
    """Not empty, at most the largest size, all components present and finite."""
    size = (F.size(a) > 0) & (F.size(a) <= MAX_DIMENSIONS)
    if dimensions is not None:
        size = size & (F.size(a) == dimensions)
    finite = F.forall(_double(a), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(a.isNotNull() & size & finite, F.lit(False))


def parse(text: Column) -> Column:
    """``[a,b,...]`` as an array of doubles; null if any component isn't a number."""
    inner = F.regexp_extract(F.trim(text), r"^\[(.*)\]$", 1)
    parts = F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when(F.forall(parts, lambda x: x.isNotNull()), parts)
