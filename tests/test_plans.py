"""Specifications, key parsing and condition trees, without Spark jobs."""

import pytest

from seekframe.operators.facets import parse_filter, related
from seekframe.operators.predicates import fields_of
from seekframe.plans import keys as K
from seekframe.plans.model import FieldSpec, IndexSpec, SpecError, check_identifier
from seekframe.plans.query import Cond, Facet, Group, Query


@pytest.mark.parametrize("name", ["Title", "1a", "", "a-b", "a" * 64])
def test_bad_field_names(name):
    with pytest.raises(SpecError):
        FieldSpec(name, "string")


def test_field_types_and_capabilities():
    index = IndexSpec("articles", (FieldSpec("title", "text", boost=5), FieldSpec("tags", "string", -1), FieldSpec("created", "date"), FieldSpec("v", "vector", dimensions=3)))
    assert index.searchable == ["title", "tags"] and index.sortable == ["created"] and index.facetable == ["tags", "created"]
    assert index.schema()["tags"].dataType.simpleString() == "array<string>" and index.schema()["created"].dataType.simpleString() == "timestamp_ntz"
    with pytest.raises(SpecError):
        index.field("body")
    with pytest.raises(SpecError):
        FieldSpec("v", "vector", dimensions=16001)
    with pytest.raises(SpecError):
        FieldSpec("a", "boolean", -1)


def test_identifiers():
    assert check_identifier("a_1") == "a_1"
    for bad in ("1a", "a b", "a;drop", ""):
        with pytest.raises(SpecError):
            check_identifier(bad)


def test_conditions_are_checked():
    for bad in (lambda: Cond("a", 1, "~"), lambda: Cond("a", [1], "BETWEEN"), lambda: Cond("a", 1, "IN"), lambda: Facet("a", limit=-1), lambda: Query(offset=-1), lambda: Query(mode="magic")):
        with pytest.raises(SpecError):
            bad()


def test_keys():
    assert not K.is_valid("  ") and not K.is_valid({"#conjunction": "OR"}) and not K.is_valid([]) and K.is_valid({"0": "a"})
    assert K.flatten({"#conjunction": "OR", "0": "a", "1": ["b", {"0": "c"}]}) == "a b c"
    assert K.parse("Red  widget!") == K.And((K.Term("red"), K.Term("widget")))
    assert K.parse({"#conjunction": "OR", "0": "a", "1": "b"}) == K.Or((K.Term("a"), K.Term("b")))
    assert K.parse('"big red" "small" box') == K.And((K.Or((K.Phrase(("big", "red")), K.Term("small"))), K.Term("box")))
    assert K.parse("box", prefixes=True) == K.Prefix("box")
    assert K.parse("@#$%^&*()") is None and K.parse("'; DROP TABLE x; --") == K.And((K.Term("drop"), K.Term("table"), K.Term("x")))
    assert [type(x).__name__ for x in K.leaves(K.parse('"a b" c'))] == ["Phrase", "Term"]


def test_facet_filters():
    assert parse_filter("f", "!") == Cond("f", op="IS NULL")
    assert parse_filter("f", "[1 5)") == Group((Cond("f", 1, ">="), Cond("f", 5, "<")))
    assert parse_filter("f", "(* 2.5]") == Group((Cond("f", 2.5, "<="),))
    assert parse_filter("f", r'"a\"b\\"') == Cond("f", 'a"b\\')
    assert related("tags_id", "tags_name") and related("tags", "tags_target_id") and not related("tags", "kind")


def test_fields_of():
    tree = Group((Cond("a", 1), Group((Cond("b", 2),), "OR")))
    assert "b" in fields_of(tree) and "c" not in fields_of(tree)
