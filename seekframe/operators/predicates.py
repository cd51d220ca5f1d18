"""The one compiler of conditions: a tree of conditions to a boolean Column, for scalar and array fields."""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.functions import vectors as V
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError
from seekframe.plans.query import Cond, Group

_COMPARE: dict[str, Callable[[Column, object], Column]] = {"<": Column.__lt__, "<=": Column.__le__, ">": Column.__gt__, ">=": Column.__ge__}


def _scalar(c: Column, cond: Cond, spec: FieldSpec) -> Column:
    op, v = cond.op, cond.value
    if spec.kind == "boolean" and op in ("=", "<>", "!=") and not isinstance(v, bool) and v is not None:
        v = str(v).strip().lower() in ("true", "1", "yes", "on")
    match op:
        case "=":
            return c == v
        case "<>" | "!=":
            return c != v
        case "IN":
            return c.isin(*v) if v else F.lit(False)
        case "NOT IN":
            return ~c.isin(*v) if v else F.lit(True)
        case "BETWEEN":
            return c.between(*v)
        case "NOT BETWEEN":
            return ~c.between(*v)
        case "CONTAINS":
            return c.contains(v)
        case "STARTS_WITH":
            return c.startswith(v)
        case "ENDS_WITH":
            return c.endswith(v)
        case "LIKE":
            return c.like(v)
        case "NOT LIKE":
            return ~c.like(v)
        case "IS NULL":
            return c.isNull()
        case "IS NOT NULL":
            return c.isNotNull()
    return _COMPARE[op](c, v)


def _array(c: Column, cond: Cond, spec: FieldSpec) -> Column:
    """Tests of array fields. An undecided test (a null among the values) counts as false, also under negation."""
    op, v = cond.op, cond.value
    decided = lambda x: F.coalesce(x, F.lit(False))
    element = spec.data_type.elementType.simpleString()
    listed = lambda: F.array(*(F.lit(x) for x in v)).cast(f"array<{element}>")
    match op:
        case "=":
            return decided(F.array_contains(c, F.lit(v).cast(element)))
        case "<>" | "!=":
            return c.isNotNull() & ~decided(F.array_contains(c, F.lit(v).cast(element)))
        case "IN":
            return decided(F.arrays_overlap(c, listed())) if v else F.lit(False)
        case "NOT IN":
            return c.isNotNull() & ~decided(F.arrays_overlap(c, listed())) if v else F.lit(True)
        case "BETWEEN":
            return decided(F.exists(c, lambda x: x.between(*v)))
        case "NOT BETWEEN":
            return c.isNotNull() & ~decided(F.exists(c, lambda x: x.between(*v)))
        case "IS NULL":
            return c.isNull() | (F.size(c) == 0)
        case "IS NOT NULL":
            return c.isNotNull() & (F.size(c) > 0)
        case "CONTAINS":
            return decided(F.exists(c, lambda x: x.contains(v)))
        case "STARTS_WITH":
            return decided(F.exists(c, lambda x: x.startswith(v)))
        case "ENDS_WITH":
            return decided(F.exists(c, lambda x: x.endswith(v)))
        case "LIKE":
            return decided(F.exists(c, lambda x: x.like(v)))
        case "NOT LIKE":
            return c.isNotNull() & ~decided(F.exists(c, lambda x: x.like(v)))
    return decided(F.exists(c, lambda x: _COMPARE[op](x, v)))


def condition(index: IndexSpec, cond: Cond) -> Column:
    if cond.field in index.system:
        spec = FieldSpec("system", "string")
    else:
        spec = index.field(cond.field)
    if cond.op == "SIMILAR":
        if spec.kind != "vector":
            raise SpecError(f"{cond.field}: only vectors are similar")
        vector, threshold = cond.value
        return F.coalesce(V.cosine(F.col(cond.field), V.literal(vector)) >= float(threshold), F.lit(False))
    if spec.kind == "vector" and cond.op not in ("IS NULL", "IS NOT NULL"):
        raise SpecError(f"{cond.field}: vectors only support null tests and SIMILAR")
    value = cond.value
    if cond.field == "node_grants" and value == "node_access_all:0":
        cond = Cond(cond.field, "node_access__all", cond.op)
    c = F.col(cond.field)
    return _array(c, cond, spec) if spec.multi_value else _scalar(c, cond, spec)


def compile_group(index: IndexSpec, group: Group, without: Collection[str] = ()) -> Column | None:
    """A group as a Column, or None if nothing is left of it; conditions on fields in ``without`` are left out."""
    parts = []
    for m in group.members:
        part = compile_group(index, m, without) if isinstance(m, Group) else None if m.field in without else condition(index, m)
        if part is not None:
            parts.append(part)
    if not parts:
        return None
    return reduce((lambda a, b: a | b) if group.conjunction.upper() == "OR" else (lambda a, b: a & b), parts)


def fields_of(group: Group) -> set[str]:
    """The fields that a group's conditions are about."""
    return {n for m in group.members for n in (fields_of(m) if isinstance(m, Group) else {m.field})}
