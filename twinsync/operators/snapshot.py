"""Latest row per key.

Each operator keeps rank one of a ``row_number`` window.  Spark turns that into a group limit that
runs before the shuffle as well, so a key with a third of all rows sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsync.rules import System


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order, which should be total."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def latest_by_ts(df: DataFrame, keys: Sequence[str], ts: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest row per key, null times last; equal times go to the greatest tie-break columns."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (ts, *tie_break)])


def snapshot(changes: DataFrame, system: System, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The current record of every id of a system; rows without an id are left out.

    Equal modified times go to the given tie-break columns or, without any, to the greatest attributes.
    """
    known = changes.where(F.col(system.id).isNotNull())
    ties = system.attributes if tie_break is None else tie_break
    return latest_by_ts(known, [system.id], system.modified, ties).select(*system.snapshot_columns)


def one_per_email(keyed: DataFrame, system: System, keys: Sequence[str]) -> DataFrame:
    """One record per match key: the newest, then the smallest id."""
    return first_per_key(keyed, keys, [F.col(system.modified).desc_nulls_last(), F.col(system.id).asc()])
