"""Changes on their way from a batch of records to the states that depend on them.

A changed record touches two match keys: the one it had and the one it has now.  Only the records of touched keys can
match otherwise than before, and all that follows from a match lies under its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsync.operators.match import key_of
from twinsync.operators.snapshot import first_per_key, snapshot
from twinsync.rules import UNIFIED_ID, System


def changed_records(news: DataFrame, previous: DataFrame, system: System, keep_unkeyed: bool = False) -> DataFrame:
    """Records that are new or newer than before, with the key they had (``old_uid``) and the key they have.

    ``previous`` is the snapshot, or those of its buckets that the news can lie in.  Of two records of an id the greater
    by time, then attributes, stands, null lowest: the order of a snapshot.  The snapshot meets the ids of the news in
    a semi join first, so it is not shuffled where they are few.
    """
    columns = system.snapshot_columns
    newest = snapshot(news, system)
    met = previous.join(newest.select(system.id), [system.id], "left_semi")
    had = key_of(met, system, keep_unkeyed).select(F.col(UNIFIED_ID).alias("old_uid"), system.id, F.struct(*columns[1:]).alias("_old"))
    joined = newest.join(had, [system.id], "left")
    changed = joined.where(F.col("_old").isNull() | (F.struct(*columns[1:]) > F.col("_old")))
    return key_of(changed, system, keep_unkeyed, "old_uid")


def last_changes(changes: DataFrame, system: System) -> DataFrame:
    """Of several changes of an id the last, which is the greatest: what stands after all of them."""
    order = [F.col(c).desc_nulls_last() for c in system.snapshot_columns[1:]]
    return first_per_key(changes, [system.id], order)


def apply_to_snapshot(previous: DataFrame, changes: DataFrame, system: System) -> DataFrame:
    """The snapshot (or some buckets of it) after changes."""
    columns = system.snapshot_columns
    return _without(previous, changes, system).unionByName(last_changes(changes, system).select(*columns))


def apply_to_keyed(previous: DataFrame, changes: DataFrame, system: System) -> DataFrame:
    """Records by key (``key_of``) after changes: each stands under the key it has now, if it has one."""
    now = last_changes(changes, system).where(F.col(UNIFIED_ID).isNotNull())
    return _without(previous, changes, system).unionByName(now.select(*previous.columns))


def _without(previous: DataFrame, changes: DataFrame, system: System) -> DataFrame:
    return previous.join(changes.select(system.id), [system.id], "left_anti").select(*previous.columns)
