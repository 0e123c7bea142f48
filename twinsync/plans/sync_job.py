"""The sync job: ingest, unify, history, differences; then results back in.

A run works in proportion to its news.  New records meet the snapshot's buckets that they lie in; what changes goes to
the records by match key, in the buckets of the old and the new keys; and only these buckets are matched again and pass
on to unified records, history and differences.  All other buckets of all states stay as they are.

A run commits once, at its end, so a run that fails leaves nothing, and one that is repeated after it has
committed does nothing.  Run ids must grow.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import Any, NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsync.functions.keys import row_checksum
from twinsync.functions.payloads import to_patch
from twinsync.functions.times import at
from twinsync.operators import changes, deltas, history, match, outbox, state
from twinsync.operators.translate import translate_payload
from twinsync.rules import CONTACTS, UNIFIED_ID, Entity, System
from twinsync.sources import landing
from twinsync.sources.tables import Tables, Work, bucket_marks, bucket_of, marked_buckets

_BY_SYSTEM = ("system", "entity")
RUNS = "runs"  # the writer whose numbers are run ids


def sync_view(matched: DataFrame, entity: Entity = CONTACTS) -> DataFrame:
    """What a run would do, in one projection: unified record, checksum, and the patch for either side."""

    def patch(target: System) -> Column:
        return to_patch(deltas.updates_for(target, entity=entity)).alias(f"{target.name}_payload")

    unified = match.survivors(entity)
    return matched.select(
        UNIFIED_ID, entity.a.id, entity.b.id, *unified, row_checksum(unified).alias("checksum"),
        patch(entity.a), patch(entity.b),
    )


class Ingested(NamedTuple):
    rows: DataFrame  # bronze rows
    records: int
    rejected: int
    newest: datetime | None
    buckets: set[int]  # of the snapshot, that the rows lie in
    letters: DataFrame | None
    audit: DataFrame


def ingest(
    work: Work, landed: DataFrame, system: System, as_of: datetime, since: datetime | None, pages: bool = False
) -> Ingested:
    """Landed text to bronze rows.  The text is read once: the write itself counts what position and audit need."""
    tables, entity = work.tables, work.tables.entity.name
    parse = landing.parse_pages if pages else landing.parse_records
    batch = landing.sort_out(parse(landed, system, as_of), system, since)
    bucket = F.when(~F.col("rejected"), bucket_of([system.id], tables.buckets))
    metrics = {**landing.landing_metrics(system), "buckets": bucket_marks(bucket)}
    written = work.append(f"bronze/{system.name}_raw", batch, ("rejected", "load_date"), metrics=metrics)
    found = written.metrics
    newest = datetime.fromisoformat(found["high_water"]) if found["high_water"] else None
    counted = state.one_row(work.spark, records=F.lit(found["accepted"]), high_water=at(newest))
    letters = landing.rejected_letters(written.rows, system, as_of, entity) if found["rejected"] else None
    return Ingested(
        landing.kept(written.rows, system), found["accepted"], found["rejected"], newest, marked_buckets(found["buckets"]), letters,
        state.audit_ingest(counted, system, as_of, since, entity),
    )


def take_in(work: Work, news: DataFrame, buckets: set[int], system: System) -> None:
    """New bronze rows into the snapshot, whose buckets they lie in; what changes is added to the system's changes."""
    if not buckets:
        return
    tables, name = work.tables, f"silver/{system.name}_snapshot"
    previous = work.state(name, only=buckets)
    found = changes.changed_records(news, previous, system, tables.keep_unkeyed)
    keys = {
        key: bucket_marks(F.when(F.col(key).isNotNull(), bucket_of([key], tables.buckets))) for key in ("old_uid", UNIFIED_ID)
    }
    changed = work.append(
        f"silver/{system.name}_changes", found, metrics={**keys, "ids": bucket_marks(bucket_of([system.id], tables.buckets))},
        kept=lambda m: {"keys": sorted(marked_buckets(m["old_uid"]) | marked_buckets(m[UNIFIED_ID]))},
    )
    touched = marked_buckets(changed.metrics["ids"])
    work.replace(name, changes.apply_to_snapshot(work.state(name, only=touched), changed.rows, system), only=touched)


def _key_changes(work: Work, system: System) -> set[int]:
    """Changes since the last run into the records by key; returns the buckets of the keys they touch.

    Streams that keep the snapshot add to the changes as well; a run takes in all that came since the one before.
    """
    name, done = f"silver/{system.name}_changes", work.base.writers.get(f"changes of {system.name}", 0)
    touched = {bucket for part in work.parts(name, done) for bucket in part["kept"]["keys"]}
    if touched:
        keyed = f"silver/{system.name}_keyed"
        rows = changes.apply_to_keyed(work.state(keyed, only=touched), work.log(name, done), system)
        work.replace(keyed, rows, only=touched)
    return touched


def propagate(work: Work, as_of: datetime, close_missing: bool = False) -> set[int]:
    """All changes since the last run into matches, unified records, history and outboxes; returns the buckets rewritten.

    The results of earlier pushes are forgotten: a run stages every difference anew.
    """
    entity = work.tables.entity
    touched = set().union(*_together(work.spark, *(lambda s=s: _key_changes(work, s) for s in entity.systems)))
    for system in entity.systems:
        work.done(f"changes of {system.name}")
        work.clear(f"gold/{system.name}_pushes")
    if not touched:
        return touched
    sides = [work.state(f"silver/{s.name}_keyed", only=touched) for s in entity.systems]
    matched = work.replace("silver/matched", match.match_keyed(*sides, entity), only=touched).rows

    def keep_history() -> None:
        unified = work.replace("silver/unified", match.unify(matched, entity), only=touched).rows
        opened = work.state("silver/history_open", only=touched)
        step = history.scd2_step(unified, opened, as_of, entity.fields, close_missing)
        work.replace_open("silver/history_open", "silver/history_closed", step, "is_current", only=touched)

    def stage(target: System) -> None:
        patches = deltas.build_outbox(deltas.field_deltas(matched, target, entity=entity), target)
        work.replace(f"gold/{target.name}_outbox", patches, only=touched)

    _together(
        work.spark,
        lambda: work.replace("silver/crosswalk", match.crosswalk(matched, entity), only=touched),
        keep_history,
        lambda: stage(entity.a),
        lambda: stage(entity.b),
    )
    return touched


def sync_run(
    tables: Tables,
    landed_a: DataFrame,
    landed_b: DataFrame,
    run_id: int,
    as_of: datetime,
    default_start: datetime | None = None,
    pages: bool = False,
    close_missing: bool = False,
) -> bool:
    """One run, from landed records (or ``pages``) of both systems to fresh outboxes; False if it was done before."""
    entity = tables.entity
    _in_order(tables, run_id)

    def steps(work: Work) -> bool:
        positions = work.state("meta/watermarks")

        def load(system: System, landed: DataFrame) -> Ingested:
            since = state.watermark_of(positions, entity.name, system.name, default_start)
            found = ingest(work, landed, system, as_of, since, pages)
            take_in(work, found.rows, found.buckets, system)
            return found

        both = dict(zip(entity.systems, _together(
            work.spark, lambda: load(entity.a, landed_a), lambda: load(entity.b, landed_b)
        )))
        moves = {s.name: found.newest for s, found in both.items() if found.newest is not None}
        if moves:
            work.replace("meta/watermarks", state.watermark_advance(positions, entity.name, moves, as_of))
        one, other = both.values()
        work.append("meta/audit_log", one.audit.unionByName(other.audit), _BY_SYSTEM)
        for found in both.values():
            if found.letters is not None:
                work.append("meta/dead_letter", found.letters, _BY_SYSTEM)
        propagate(work, as_of, close_missing)
        return True

    return bool(tables.run(steps, RUNS, run_id))


def _in_order(tables: Tables, run_id: int) -> None:
    last = tables.commits.latest().writers.get(RUNS)
    if last is not None and run_id < last:
        raise ValueError(f"run {run_id} comes after run {last} has written; run ids must grow")


def _together(spark: SparkSession, *steps: Callable[[], Any]) -> list[Any]:
    """Independent steps at the same time, so that one's last tasks do not idle the cluster."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [running.result() for running in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def full_history(tables: Tables) -> DataFrame:
    """Closed and open versions."""
    return tables.log("silver/history_closed").unionByName(tables.state("silver/history_open"))


def _outbox(patches: DataFrame, pushes: DataFrame) -> DataFrame:
    after = pushes.select(UNIFIED_ID, *(F.col(c).alias(f"_{c}") for c in pushes.columns if c != UNIFIED_ID))
    pushed = F.col("_status").isNotNull()
    return patches.join(after, [UNIFIED_ID], "left").select(*(
        F.when(pushed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if f"_{c}" in after.columns else F.col(c)
        for c in patches.columns
    ))


def current_outbox(at_work: Tables | Work, target: System) -> DataFrame:
    """The patches of the last run, with what became of them since."""
    return _outbox(at_work.state(f"gold/{target.name}_outbox"), at_work.state(f"gold/{target.name}_pushes"))


class Translation(NamedTuple):
    """How display values become those that a system stores: see ``translate_payload``."""

    option_dim: DataFrame | None = None
    option_sets: dict[str, str] | None = None
    lookups: dict[str, str] | None = None


def _to_push(tables: Tables | Work, target: System, translation: Translation | None) -> DataFrame:
    rows = current_outbox(tables, target)
    return translate_payload(rows, *translation) if translation else rows


def next_push(
    tables: Tables, target: System, size: int | None = None, translation: Translation | None = None
) -> outbox.Batch:
    """What to send next, record by record: all pending rows, or the next ``size``; translated if the target asks for it."""
    return outbox.next_batch(_to_push(tables, target, translation), target, size)


def next_batches(
    tables: Tables, target: System, size: int = outbox.BATCH_ROWS, translation: Translation | None = None
) -> DataFrame:
    """All pending rows that can be sent, numbered into batches of ``size``; kept, so that results can name a batch.

    ``outbox.batch_requests`` makes them requests.
    """
    name = f"gold/{target.name}_batches"

    def steps(work: Work) -> None:
        rows = outbox.deliverable(outbox.pending(_to_push(work, target, translation)), target)
        numbered = outbox.number_batches(rows, size, lambda placed: work.scratch(name, placed))
        work.replace(name, numbered.select("batch", UNIFIED_ID, target.id, "payload"))

    tables.run(steps)
    return tables.state(name)


def take_results(tables: Tables, results: DataFrame, target: System, run_id: int, as_of: datetime) -> DataFrame:
    """Results of a push, one per record (target id, http_code, message), into outbox, audit log and dead letters."""

    def steps(work: Work, rows: DataFrame) -> None:
        pushed = work.scratch(f"gold/{target.name}_results", outbox.outcomes(rows, results, target))
        audit = state.audit_pushed_records(pushed, target, as_of, tables.entity.name)
        _settle(work, rows, pushed, audit, target, as_of)

    return _take(tables, steps, target, run_id)


def take_batch_results(tables: Tables, results: DataFrame, target: System, run_id: int, as_of: datetime) -> DataFrame:
    """Results of a push, one per batch of ``next_batches`` (batch, http_code, message): each holds for all rows of its batch."""

    def steps(work: Work, rows: DataFrame) -> None:
        sent = work.state(f"gold/{target.name}_batches")
        pushed = work.scratch(f"gold/{target.name}_results", outbox.batch_outcomes(sent, results))
        audit = state.audit_pushed_batches(pushed, target, as_of, tables.entity.name)
        _settle(work, rows, pushed, audit, target, as_of)

    return _take(tables, steps, target, run_id)


def _take(tables: Tables, steps: Callable[[Work, DataFrame], None], target: System, run_id: int) -> DataFrame:
    _in_order(tables, run_id)
    tables.run(lambda work: steps(work, current_outbox(work, target)), RUNS, run_id)
    return current_outbox(tables, target)


def _settle(work: Work, rows: DataFrame, pushed: DataFrame, audit: DataFrame, target: System, as_of: datetime) -> None:
    """What was pushed, and what cannot be, into the states and logs.  The patches themselves stay as they are."""
    entity = work.tables.entity.name
    letters = state.undeliverable_letters(outbox.undeliverable(outbox.pending(rows), target), target, as_of, entity)
    work.append("meta/dead_letter", letters.unionByName(state.failed_letters(pushed, target, as_of, entity)), _BY_SYSTEM)
    work.append("meta/audit_log", audit, _BY_SYSTEM)
    settled = outbox.settle(rows, pushed, target, as_of)
    tried = (F.col("status") != "PENDING") | (F.col("attempt") > 0)
    work.replace(f"gold/{target.name}_pushes", settled.where(tried).select(UNIFIED_ID, "status", "attempt", "last_attempt_ts"))
