"""Matching the two systems and building unified records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.functions.keys import normalize_email, unified_id
from twinsync.operators.snapshot import one_per_email
from twinsync.rules import CONTACTS, UNIFIED_ID, Entity, FieldRule, System


def email_keys(snap: DataFrame, system: System) -> DataFrame:
    """The snapshot with its normalised email as ``match_email``, one record per email."""
    keyed = snap.withColumn("match_email", normalize_email(F.col(system.email)))
    return one_per_email(keyed.where(F.col("match_email").isNotNull()), system, ["match_email"])


def _match_side(snap: DataFrame, system: System, keep_unkeyed: bool) -> DataFrame:
    if keep_unkeyed:
        # A record without an email is keyed by its own id, so it spreads out and meets nothing.
        email = normalize_email(F.col(system.email))
        keyed = snap.withColumns({
            "match_key": F.coalesce(email, F.col(system.id)),
            "keyed_by": F.when(email.isNotNull(), "email").otherwise(system.name),
        })
        side = one_per_email(keyed, system, ["match_key", "keyed_by"])
        keys = [F.col("match_key"), F.col("keyed_by")]
    else:
        side, keys = email_keys(snap, system), [F.col("match_email")]
    return side.select(*keys, *(F.col(c).alias(system.matched(c)) for c in system.snapshot_columns))


def match_records(
    snap_a: DataFrame, snap_b: DataFrame, keep_unkeyed: bool = False, entity: Entity = CONTACTS
) -> DataFrame:
    """Both systems side by side: one row per match key, one-sided ones included.

    The attributes travel through the one full outer join, so crosswalk, unified records and field
    differences are projections of this frame and need no join back by id.  Both sides hold one row
    per key, so no join partition can run hot.

    Records without a valid email are left out.  ``keep_unkeyed`` keeps them as one-sided records,
    their unified id taken from the system's name and their own id.
    """
    keys = ["match_key", "keyed_by"] if keep_unkeyed else ["match_email"]
    side_a, side_b = (_match_side(snap, s, keep_unkeyed) for snap, s in zip((snap_a, snap_b), entity.systems))
    joined = side_a.join(side_b, keys, "full")
    if keep_unkeyed:
        by_email = F.col("keyed_by") == "email"
        own = F.concat(F.col("keyed_by"), F.lit("|"), F.col("match_key"))
        uid = unified_id(F.when(by_email, F.col("match_key")).otherwise(own))
        email = F.when(by_email, F.col("match_key"))
    else:
        uid, email = unified_id(F.col("match_email")), F.col("match_email")
    return joined.select(uid.alias(UNIFIED_ID), email.alias("match_email"), *entity.matched_columns)


def key_of(snap: DataFrame, system: System, keep_unkeyed: bool = False, *more: str) -> DataFrame:
    """The records, and ``more`` columns, with the unified id they match under (null: none) and their normalised email."""
    email = normalize_email(F.col(system.email))
    uid = unified_id(email)
    if keep_unkeyed:
        uid = F.coalesce(uid, unified_id(F.concat(F.lit(f"{system.name}|"), F.col(system.id))))
    return snap.select(*more, uid.alias(UNIFIED_ID), email.alias("match_email"), *system.snapshot_columns)


def match_keyed(keyed_a: DataFrame, keyed_b: DataFrame, entity: Entity = CONTACTS) -> DataFrame:
    """As ``match_records``, for records that have their key (``key_of``)."""

    def side(keyed: DataFrame, system: System) -> DataFrame:
        one = one_per_email(keyed, system, [UNIFIED_ID])
        return one.select(
            UNIFIED_ID, F.col("match_email").alias(f"{system.name}_match"),
            *(F.col(c).alias(system.matched(c)) for c in system.snapshot_columns),
        )

    joined = side(keyed_a, entity.a).join(side(keyed_b, entity.b), [UNIFIED_ID], "full")
    email = F.coalesce(*(f"{s.name}_match" for s in entity.systems))
    return joined.select(UNIFIED_ID, email.alias("match_email"), *entity.matched_columns)


def crosswalk(matched: DataFrame, entity: Entity = CONTACTS) -> DataFrame:
    """Unified id, normalised email and the id on either side."""
    return matched.select(UNIFIED_ID, F.col("match_email").alias("email"), entity.a.id, entity.b.id)


def attach_snapshots(
    xwalk: DataFrame, snap_a: DataFrame, snap_b: DataFrame, entity: Entity = CONTACTS
) -> DataFrame:
    """The matched layout from a stored crosswalk: two left joins by id.

    One-sided rows have a null id on the other side, perhaps a third of all rows.  They join under
    their unified id instead, which spreads them over all partitions; the null test keeps them unmatched.
    """
    x = xwalk.withColumnRenamed("email", "match_email")
    for system, snap in zip(entity.systems, (snap_a, snap_b)):
        key = F.coalesce(F.col(system.id), F.col(UNIFIED_ID)) == F.col("_id")
        named = snap.select(
            F.col(system.id).alias("_id"),
            *(F.col(c).alias(system.matched(c)) for c in system.snapshot_columns if c != system.id),
        )
        x = x.join(named, key & F.col(system.id).isNotNull(), "left").drop("_id")
    return x.select(UNIFIED_ID, "match_email", *entity.matched_columns)


def survivors(entity: Entity = CONTACTS) -> list[Column]:
    """Per unified field, A's value of a matched record, or B's where A has none."""

    def survivor(rule: FieldRule) -> Column:
        sides = [F.col(s.matched(rule.column(s))) for s in entity.systems if rule.column(s)]
        return F.coalesce(*sides).alias(rule.unified)

    return [survivor(rule) for rule in entity.rules]


def unify(matched: DataFrame, entity: Entity = CONTACTS) -> DataFrame:
    """One unified record per match."""
    return matched.select(UNIFIED_ID, *survivors(entity))
