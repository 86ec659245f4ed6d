"""Expressions on tab-separated lines and numbers kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAB = "\t"


def fields(line: Column) -> Column:
    """Fields of a batch line; empty fields at the end do not count."""
    return F.split(F.rtrim(line, F.lit(TAB)), TAB)


def all_fields(line: Column) -> Column:
    """Fields of an event line, empty ones included."""
    return F.split(line, TAB, -1)


def field(parts: Column, position: int) -> Column:
    """One field, null beyond the end."""
    return F.get(parts, position)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def whole_number(text: Column) -> Column:
    """Text as int; null when it is not an optional sign followed by digits, or too large."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def has_text(text: Column) -> Column:
    return F.length(text) > 0
