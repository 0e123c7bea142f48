"""Update lists, patches and their JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def update_if(condition: Column, field: str, value: Column) -> Column:
    """One (field, value) update where the condition holds, else null."""
    return F.when(condition, F.struct(F.lit(field).alias("field"), value.alias("value")))


def update_list(updates: Sequence[Column]) -> Column:
    """The updates that apply, in rule order."""
    return F.array_compact(F.array(*updates))


def to_patch(updates: Column) -> Column:
    """Update list to JSON object text, fields in list order."""
    return F.to_json(F.map_from_entries(updates))


def from_patch(payload: Column) -> Column:
    """JSON object text to a map; null or blank text gives the empty map, unreadable text null."""
    return _read(payload, "map<string,string>")


def from_typed_patch(payload: Column) -> Column:
    """As ``from_patch``, with values of any JSON type."""
    return _read(payload, "map<string,variant>")


def is_unreadable(payload: Column) -> Column:
    return from_patch(payload).isNull()


def _read(payload: Column, map_type: str) -> Column:
    blank = payload.isNull() | (F.trim(payload) == "")
    return F.when(blank, F.expr(f"cast(map() as {map_type})")).otherwise(F.from_json(payload, map_type))
