"""Typed values from loose input: what can't be converted becomes null, never an error in the middle of a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekframe.functions import text as X

STRING_CHARS = 255

# Words that count as true and false.
TRUE, FALSE = ("true", "1", "yes", "on"), ("false", "0", "no", "off", "")


def text(value: Column) -> Column:
    """Index text, cut at a million characters."""
    return F.substring(X.collapse(X.strip_tags(value.cast("string"))), 1, X.MAX_TEXT)


def string(value: Column) -> Column:
    """Cut at 255 characters (not bytes, so no character is split)."""
    return F.substring(value.cast("string"), 1, STRING_CHARS)


def date(value: Column) -> Column:
    """From epoch seconds or a date string."""
    number = value.cast("string").try_cast("bigint")
    return F.when(number.isNotNull(), F.timestamp_seconds(number)).otherwise(F.try_to_timestamp(value.cast("string")))


def boolean(value: Column) -> Column:
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False)


def integer(value: Column) -> Column:
    number = F.trim(value.cast("string")).try_cast("double")
    return F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 2.0**63), number.try_cast("bigint"))


def decimal(value: Column) -> Column:
    return F.trim(value.cast("string")).try_cast("decimal(10,2)")


def integers(values: Column) -> Column:
    """The numeric members of an array of strings; a zero stays."""
    return F.filter(F.transform(values, lambda v: F.trim(v).try_cast("bigint")), lambda v: v.isNotNull())


def strings(values: Column) -> Column:
    """The non-empty members of an array; ``0`` stays."""
    return F.filter(values, lambda v: v.isNotNull() & (v != ""))


def entity_id(value: Column) -> Column:
    """The id in a scalar, or in the ``target_id`` of a JSON text."""
    return F.coalesce(value.try_cast("bigint"), F.get_json_object(value, "$.target_id").try_cast("bigint"))


def embedding_text(value: Column, most: int = 8000) -> Column:
    """Text for an embedding service: single spaces, no controls, at most ``most`` characters.

    A cut goes back to the last space if that keeps over four fifths.
    """
    clean = X.collapse(X.drop_controls(value))
    cut = F.substring(clean, 1, most)
    last = F.char_length(cut) - F.coalesce(F.locate(" ", F.reverse(cut)), F.lit(0))
    back = (last < F.char_length(cut)) & (last > most * 0.8)
    return F.when(F.char_length(clean) <= most, clean).when(back, cut.substr(F.lit(1), last)).otherwise(cut)


def token_estimate(value: Column) -> Column:
    """A quarter of the bytes, rounded up."""
    return F.ceil(F.octet_length(F.coalesce(value, F.lit(""))) / 4)


def cache_key(value: Column, *metadata: Column) -> Column:
    """SHA-256 of the normalised text and metadata, in this library's own canonical form."""
    parts = [X.collapse(X.drop_controls(F.coalesce(value, F.lit("")))), *(F.coalesce(m.cast("string"), F.lit("")) for m in metadata)]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)
