"""Slowly changing history (type 2) of unified records.

History rows carry ``valid_from``, ``valid_to``, ``is_current`` and a checksum.  At most one row per id
is open.  Closed rows never change again, so they pass by every join: an id with any number of old
versions costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.functions.keys import row_checksum
from twinsync.functions.times import at
from twinsync.rules import CONTACTS, UNIFIED_ID


def with_checksum(current: DataFrame, fields: Sequence[str] = CONTACTS.fields, length_prefixed: bool = False) -> DataFrame:
    """The current records, reduced to id, fields and checksum."""
    return current.select(UNIFIED_ID, *fields, row_checksum(fields, length_prefixed).alias("checksum"))


def _history_columns(fields: Sequence[str]) -> list[str]:
    return [UNIFIED_ID, *fields, "valid_from", "valid_to", "is_current", "checksum"]


def scd2_changes(current: DataFrame, history: DataFrame, as_of: datetime, fields: Sequence[str] = CONTACTS.fields) -> DataFrame:
    """New versions to open: records unknown to the history, or with another checksum."""
    opened = history.where(F.col("is_current")).select(UNIFIED_ID, F.col("checksum").alias("old_checksum"))
    joined = with_checksum(current, fields).join(opened, [UNIFIED_ID], "left")
    changed = joined.where(F.col("old_checksum").isNull() | (F.col("old_checksum") != F.col("checksum")))
    return changed.withColumns({
        "valid_from": at(as_of), "valid_to": at(None), "is_current": F.lit(True)
    }).select(*_history_columns(fields))


def scd2_close(history: DataFrame, changed: DataFrame, as_of: datetime) -> DataFrame:
    """The open versions of the changed ids, closed at ``as_of``."""
    affected = history.where(F.col("is_current")).join(changed.select(UNIFIED_ID), [UNIFIED_ID], "left_semi")
    return affected.withColumns({"valid_to": at(as_of), "is_current": F.lit(False)}).select(*history.columns)


def scd2_untouched(history: DataFrame, changed: DataFrame) -> DataFrame:
    """All versions of the ids that did not change.

    An id may own a third of the history; Spark splits such a partition, as an anti join allows it.
    """
    return history.join(changed.select(UNIFIED_ID), [UNIFIED_ID], "left_anti").select(*history.columns)


def scd2_step(
    current: DataFrame,
    opened: DataFrame,
    as_of: datetime,
    fields: Sequence[str] = CONTACTS.fields,
    close_missing: bool = False,
) -> DataFrame:
    """Open versions before and current records now, to open and just-closed versions after.

    One full outer join, with one row per id on both sides.  Each pair gives the old version as it
    was, the old version closed, the new version, or the latter two.  ``close_missing`` closes the
    versions of ids that are gone from the current records; else they stay open.
    """
    old_columns = {c: f"_old_{c}" for c in opened.columns if c != UNIFIED_ID}
    joined = with_checksum(current, fields).join(opened.withColumnsRenamed(old_columns), [UNIFIED_ID], "full")

    known, present = F.col("_old_checksum").isNotNull(), F.col("checksum").isNotNull()
    differs = known & present & (F.col("_old_checksum") != F.col("checksum"))
    closes = differs | (known & ~present) if close_missing else differs

    def version(source: str, valid_from: Column, valid_to: Column, is_current: Column) -> Column:
        values = [F.col(source + c).alias(c) for c in fields]
        return F.struct(
            *values, valid_from.alias("valid_from"), valid_to.alias("valid_to"),
            is_current.alias("is_current"), F.col(source + "checksum").alias("checksum"),
        )

    before = F.col("_old_valid_from")
    old = F.when(closes, version("_old_", before, at(as_of), F.lit(False))).when(
        known, version("_old_", before, F.col("_old_valid_to"), F.lit(True))
    )
    new = F.when(differs | ~known, version("", at(as_of), at(None), F.lit(True)))
    versions = F.array_compact(F.array(old, new))
    return joined.select(UNIFIED_ID, F.inline(versions)).select(*_history_columns(fields))


def scd2_apply(
    current: DataFrame,
    history: DataFrame,
    as_of: datetime,
    fields: Sequence[str] = CONTACTS.fields,
    close_missing: bool = False,
) -> DataFrame:
    """The whole history after taking in the current records; every older version stays."""
    closed = history.where(~F.col("is_current")).select(*_history_columns(fields))
    opened = history.where(F.col("is_current")).select(*_history_columns(fields))
    return closed.unionByName(scd2_step(current, opened, as_of, fields, close_missing))
