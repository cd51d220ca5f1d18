"""The query object: keywords, condition tree, sorts, paging, facets and search mode, as frozen dataclasses."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass
from typing import Any

from seekframe.plans.model import SpecError

OPERATORS = frozenset({"=", "<>", "!=", "<", "<=", ">", ">=", "IN", "NOT IN", "BETWEEN", "NOT BETWEEN", "CONTAINS", "STARTS_WITH", "ENDS_WITH", "LIKE", "NOT LIKE", "IS NULL", "IS NOT NULL", "SIMILAR"})
#: Text configurations: tokens as they are, their stems in one language, or in that of each item.
CONFIGS = ("simple", "english", "german", "spanish", "french", "language")


@dataclass(frozen=True)
class Cond:
    field: str
    value: Any = None
    op: str = "="

    def __post_init__(self) -> None:
        if self.op not in OPERATORS:
            raise SpecError(f"unknown operator {self.op!r}")
        if self.op in ("BETWEEN", "NOT BETWEEN") and (not isinstance(self.value, (list, tuple)) or len(self.value) != 2):
            raise SpecError(f"{self.op} needs two values")
        if self.op == "SIMILAR" and (not isinstance(self.value, (list, tuple)) or len(self.value) != 2 or not isinstance(self.value[0], (list, tuple))):
            raise SpecError("SIMILAR needs a vector and a threshold")
        if self.op in ("IN", "NOT IN") and not isinstance(self.value, (list, tuple, set, frozenset)):
            raise SpecError(f"{self.op} needs a list of values")


@dataclass(frozen=True)
class Group:
    """Conditions and groups, joined by AND unless the conjunction is OR. An empty group holds for every row."""

    members: tuple[Cond | Group, ...] = ()
    conjunction: str = "AND"


@dataclass(frozen=True)
class Sort:
    """By a field, ``relevance`` or ``id``; anything but DESC is ASC. Nulls: last if ascending, first if descending."""

    field: str
    direction: str = "ASC"

    @property
    def descending(self) -> bool:
        return self.direction.upper() == "DESC"


@dataclass(frozen=True)
class Facet:
    """Counts of a field's values. limit 0: all. missing: count rows without a value under ``!``. related: conditions on
    other forms of the field (as tags_id for tags_name) don't narrow it either."""

    field: str
    limit: int = 50
    min_count: int = 1
    missing: bool = False
    related: bool = True

    def __post_init__(self) -> None:
        if self.limit < 0 or self.min_count < 0:
            raise SpecError("limit and min_count of a facet can't be negative")


@dataclass(frozen=True)
class VectorQuery:
    """The vector side of a query; the weights and threshold are the documented defaults. guarded: in a hybrid score each
    side that an item has counts at least a little; else it is the plain weighted sum, null without a vector."""

    vector: tuple[float, ...]
    column: str = "content_embedding"
    threshold: float = 0.15
    text_weight: float = 0.6
    vector_weight: float = 0.4
    max_results: int | None = None
    guarded: bool = True


@dataclass(frozen=True)
class Query:
    keys: Any = None
    where: Group = Group()
    sorts: tuple[Sort, ...] = ()
    limit: int | None = None
    offset: int = 0
    languages: tuple[str, ...] | None = None
    fields: tuple[str, ...] = ()
    facets: tuple[Facet, ...] = ()
    facet_filters: tuple[tuple[str, tuple[str, ...]], ...] = ()
    mode: str = "hybrid"
    vector: VectorQuery | None = None
    skip_count: bool = False
    rank: str = "tf"
    config: str = "simple"

    def __post_init__(self) -> None:
        if self.mode not in ("text_only", "vector_only", "hybrid"):
            raise SpecError(f"unknown search mode {self.mode!r}")
        if self.config not in CONFIGS:
            raise SpecError(f"unknown text configuration {self.config!r}")
        if self.limit is not None and self.limit < 0 or self.offset < 0:
            raise SpecError("limit and offset can't be negative")

    def digest(self, table: str) -> str:
        """A hash that names the query on a table: equal for equal questions, in whatever order mappings came."""
        return hashlib.md5(json.dumps([table, asdict(self)], sort_keys=True, default=str).encode()).hexdigest()
