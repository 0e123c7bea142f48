"""Field-level differences and the outboxes they go to."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.functions.payloads import to_patch, update_if, update_list
from twinsync.functions.times import at
from twinsync.rules import CONTACTS, UNIFIED_ID, Entity, FieldRule, System


def _needs_update(rule: FieldRule, source: System, target: System, conflict: str, empty_is_null: bool) -> Column:
    have = F.col(target.matched(rule.column(target)))
    offer = F.col(source.matched(rule.column(source)))
    if rule.strategy == "fill_if_missing":
        if empty_is_null:
            have, offer = F.nullif(have, F.lit("")), F.nullif(offer, F.lit(""))
        return have.isNull() & offer.isNotNull()
    differs = have != offer  # null on either side: no update
    if conflict == "newest" and rule.direction == "bi":
        ours, theirs = F.col(source.modified), F.col(target.modified)
        newer = (ours >= theirs) if source.name == "a" else (ours > theirs)
        return differs & (theirs.isNull() | newer)
    return differs


def _updates(
    target: System, conflict: str, empty_is_null: bool, entity: Entity
) -> list[tuple[Column, str, Column]]:
    """Condition, target field and new value per rule that can send something to the target."""
    if conflict not in ("both", "newest"):
        raise ValueError(f"unknown conflict mode {conflict!r}")
    source = entity.partner(target)
    updates = [
        (
            _needs_update(rule, source, target, conflict, empty_is_null),
            rule.column(target),
            F.col(source.matched(rule.column(source))),
        )
        for rule in entity.rules
        if rule.a and rule.b and rule.direction in ("bi", f"to_{target.name}")
    ]
    if not updates:
        raise ValueError(f"no rule sends anything to system {target.name}")
    return updates


def updates_for(
    target: System, conflict: str = "both", empty_is_null: bool = False, entity: Entity = CONTACTS
) -> Column:
    """The list of updates that a matched record has for the target; null when there is none.

    ``overwrite`` fires when both values are known and differ, ``fill_if_missing`` when only the source
    has one.  With ``conflict="both"`` a two-way overwrite sends each side the other's value;
    ``"newest"`` sends only the newer record's, A's on equal times.  ``empty_is_null`` lets fill treat
    the empty string as missing.
    """
    updates = _updates(target, conflict, empty_is_null, entity)
    return F.when(_any(updates), update_list([update_if(*update) for update in updates]))


def _any(updates: list[tuple[Column, str, Column]]) -> Column:
    return reduce(or_, (condition for condition, _, _ in updates))


def field_deltas(
    matched: DataFrame,
    target: System,
    conflict: str = "both",
    empty_is_null: bool = False,
    entity: Entity = CONTACTS,
) -> DataFrame:
    """Unified id, target id and updates of every record the target should change.

    A filter and a projection of the matched frame, without a shuffle.  The filter tests the rules'
    conditions alone, so lists are built only for the rows that stay.
    """
    updates = _updates(target, conflict, empty_is_null, entity)
    listed = update_list([update_if(*update) for update in updates])
    return matched.where(_any(updates)).select(UNIFIED_ID, target.id, listed.alias("updates"))


def deltas_long(deltas: DataFrame, target: System) -> DataFrame:
    """One row per update."""
    return deltas.select(UNIFIED_ID, target.id, F.inline("updates"))


def build_outbox(deltas: DataFrame, target: System) -> DataFrame:
    """One pending JSON patch per record; replaces the outbox of the run before."""
    return deltas.select(
        UNIFIED_ID,
        target.id,
        to_patch(F.col("updates")).alias("payload"),
        F.lit("PENDING").alias("status"),
        F.lit(0).alias("attempt"),
        at(None).alias("last_attempt_ts"),
    )
