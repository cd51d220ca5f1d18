"""Index and field specifications: what a field holds, and what may be done with it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

FIELD_ID = re.compile(r"[a-z][a-z0-9_]{0,62}")
IDENTIFIER = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")
MAX_DIMENSIONS = 16_000

_SCALARS: dict[str, T.DataType] = {
    "text": T.StringType(),
    "string": T.StringType(),
    "fulltext": T.StringType(),
    "integer": T.LongType(),
    "entity_reference": T.LongType(),
    "decimal": T.DecimalType(10, 2),
    "date": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "vector": T.ArrayType(T.FloatType()),
}
SEARCHABLE = frozenset({"text", "fulltext", "string"})
FACETABLE = frozenset({"string", "integer", "boolean", "date", "entity_reference"})
SORTABLE = FACETABLE | {"decimal"}
EMBEDDABLE = frozenset({"text", "fulltext"})
MULTI_VALUE = frozenset({"text", "string", "integer", "entity_reference"})


class SpecError(ValueError):
    """A query or specification that can't be compiled; raised before any job starts."""


def check_identifier(name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise SpecError(f"not an identifier: {name!r}")
    return name


@dataclass(frozen=True)
class FieldSpec:
    """One field. cardinality: 1, or -1 or more than 1 for several values in an array column."""

    name: str
    kind: str
    cardinality: int = 1
    boost: float = 1.0
    weight: str = "D"
    dimensions: int = 1536

    def __post_init__(self) -> None:
        if not FIELD_ID.fullmatch(self.name):
            raise SpecError(f"field names are a-z, 0-9 and _, begin with a letter and have at most 63 characters: {self.name!r}")
        if self.kind not in _SCALARS:
            raise SpecError(f"{self.name}: unknown type {self.kind!r}")
        if self.multi_value and self.kind not in MULTI_VALUE:
            raise SpecError(f"{self.name}: {self.kind} fields hold one value")
        if self.kind == "vector" and not 1 <= self.dimensions <= MAX_DIMENSIONS:
            raise SpecError(f"{self.name}: 1 to {MAX_DIMENSIONS} dimensions")

    @property
    def multi_value(self) -> bool:
        return self.cardinality == -1 or self.cardinality > 1

    @property
    def data_type(self) -> T.DataType:
        scalar = _SCALARS[self.kind]
        return T.ArrayType(scalar) if self.multi_value else scalar


@dataclass(frozen=True)
class IndexSpec:
    """An index: one wide table of items with the system columns id, datasource and language."""

    name: str
    fields: tuple[FieldSpec, ...]
    id_col: str = "item_id"
    datasource_col: str = "datasource"
    language_col: str = "language"
    _by_name: dict[str, FieldSpec] = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        if not FIELD_ID.fullmatch(self.name):
            raise SpecError(f"bad index name {self.name!r}")
        self._by_name.update({f.name: f for f in self.fields})
        if len(self._by_name) != len(self.fields):
            raise SpecError("two fields have the same name")

    def field(self, name: str) -> FieldSpec:
        if name not in self._by_name:
            raise SpecError(f"{self.name} has no field {name!r}")
        return self._by_name[name]

    def having(self, kinds: frozenset[str]) -> list[str]:
        return [f.name for f in self.fields if f.kind in kinds]

    @property
    def searchable(self) -> list[str]:
        return self.having(SEARCHABLE)

    @property
    def facetable(self) -> list[str]:
        return self.having(FACETABLE)

    @property
    def sortable(self) -> list[str]:
        return [f.name for f in self.fields if f.kind in SORTABLE and not f.multi_value]

    @property
    def system(self) -> tuple[str, str, str]:
        return self.id_col, self.datasource_col, self.language_col

    def schema(self) -> T.StructType:
        out = T.StructType().add(self.id_col, T.StringType(), False).add(self.datasource_col, T.StringType(), False).add(self.language_col, T.StringType(), False)
        for f in self.fields:
            out.add(T.StructField(f.name, f.data_type, True, {"kind": f.kind, "multi_value": f.multi_value, "boost": f.boost}))
        return out
