"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.functions import keys, text, times
from twinsync.operators import deltas, history, match, outbox, snapshot, state, translate, upsert
from twinsync.plans.inputs import (
    AS_OF_1, AS_OF_2, DEFAULT_START, FIRST_CUT, LOAD_TS, LOOKUPS, OPTION_SETS, PAGED_A, PAGED_B, SINCE, landed_text, table,
    view,
)
from twinsync.plans import sync_job
from twinsync.rules import SYSTEM_A, SYSTEM_B, UNIFIED_ID, System
from twinsync.session import work_folder
from twinsync.sources import landing
from twinsync.sources.tables import Tables
from twinsync.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Shared inputs.


def _changes(spark, sf_dir, system: System) -> DataFrame:
    return view(spark, sf_dir, f"src_{system.name}")


def _snapshot(spark, sf_dir, system: System, before=None) -> DataFrame:
    changes = _changes(spark, sf_dir, system)
    if before is not None:
        changes = changes.where(F.col(system.modified) < times.at(before))
    return snapshot.snapshot(changes, system, [f"{system.name}_version"])


def _matched(spark, sf_dir, before=None, keep_unkeyed=False) -> DataFrame:
    sides = (_snapshot(spark, sf_dir, s, before) for s in (SYSTEM_A, SYSTEM_B))
    return match.match_records(*sides, keep_unkeyed=keep_unkeyed)


def _unified(spark, sf_dir, before=None) -> DataFrame:
    return match.unify(_matched(spark, sf_dir, before))


def _history(spark, sf_dir, before=FIRST_CUT) -> DataFrame:
    """History after its first run, stored as a table as any history is."""
    first = history.scd2_apply(_unified(spark, sf_dir, before), schemas.empty(spark, schemas.HISTORY), AS_OF_1)
    return Tables(spark, work_folder(spark, "history")).append("silver/any_history", first, ["is_current"])


def _outbox(spark, sf_dir, target: System) -> DataFrame:
    return deltas.build_outbox(deltas.field_deltas(_matched(spark, sf_dir), target), target)


def _parsed(spark, sf_dir, system: System) -> DataFrame:
    return landing.parse_records(view(spark, sf_dir, f"raw_{system.name}"), system, LOAD_TS)


# Sources.


@query
def bronze_nested_json(spark, sf_dir):
    return landing.accepted_records(_parsed(spark, sf_dir, SYSTEM_A), SYSTEM_A)


@query
def bronze_flat_json(spark, sf_dir):
    return landing.accepted_records(_parsed(spark, sf_dir, SYSTEM_B), SYSTEM_B)


@query
def ingest_a(spark, sf_dir):
    return landing.accepted_records(_parsed(spark, sf_dir, SYSTEM_A), SYSTEM_A, SINCE)


@query
def ingest_b(spark, sf_dir):
    return landing.accepted_records(_parsed(spark, sf_dir, SYSTEM_B), SYSTEM_B, SINCE)


@query
def ingest_dead_letter(spark, sf_dir):
    batch = landing.sort_out(_parsed(spark, sf_dir, SYSTEM_A), SYSTEM_A, SINCE)
    return landing.rejected_letters(batch, SYSTEM_A, LOAD_TS)


@query
def bronze_pages_a(spark, sf_dir):
    return landing.accepted_records(landing.parse_pages(view(spark, sf_dir, "pages_a"), PAGED_A, LOAD_TS), PAGED_A)


@query
def bronze_pages_b(spark, sf_dir):
    return landing.accepted_records(landing.parse_pages(view(spark, sf_dir, "pages_b"), PAGED_B, LOAD_TS), PAGED_B)


@query
def ingest_counts(spark, sf_dir):
    """Counted by the writes of an ingest themselves."""

    def steps(work):
        systems = (SYSTEM_A, SYSTEM_B)
        found = [sync_job.ingest(work, view(spark, sf_dir, f"raw_{s.name}"), s, LOAD_TS, None) for s in systems]
        return [
            state.one_row(
                spark, system=F.lit(s.name), landed=F.lit(f.records + f.rejected).cast("bigint"),
                accepted=F.lit(f.records).cast("bigint"), rejected=F.lit(f.rejected).cast("bigint"), high_water=times.at(f.newest),
            )
            for s, f in zip(systems, found)
        ]

    one, other = Tables(spark, work_folder(spark, "counts")).run(steps)
    return one.unionByName(other)


@query
def incremental_filter(spark, sf_dir):
    return landing.modified_since(table(spark, sf_dir, "events"), "ts", SINCE)


@query
def ordered_changes(spark, sf_dir):
    """With the place of each row within its day, as it comes out of the sort."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ordered = landing.in_source_order(events, "ts", "event_id").withColumn("came", F.monotonically_increasing_id())
    day = Window.partitionBy(F.to_date("ts")).orderBy("came")
    return ordered.withColumn("place", F.row_number().over(day)).drop("came")


@query
def batch_high_water(spark, sf_dir):
    return landing.high_water(table(spark, sf_dir, "events"), "ts")


@query
def option_set_dim(spark, sf_dir):
    return landing.option_set_dimension(view(spark, sf_dir, "option_sets_raw"))


# Tables.


@query
def upsert_by_key(spark, sf_dir):
    return upsert.upsert_by_key(view(spark, sf_dir, "upsert_target"), view(spark, sf_dir, "upsert_source"), ["c_custkey"])


@query
def partitioned_write_read(spark, sf_dir):
    tables = Tables(spark, work_folder(spark, "partitioned"))
    events = table(spark, sf_dir, "events").withColumn("load_date", F.to_date("ts"))
    written = tables.append("bronze/events", events, ["load_date"], many_values=True)
    return written.where(F.col("load_date") >= F.lit(date(2024, 1, 10)))


# Snapshots.


@query
def latest_snapshot_a(spark, sf_dir):
    return _snapshot(spark, sf_dir, SYSTEM_A)


@query
def latest_snapshot_b(spark, sf_dir):
    return _snapshot(spark, sf_dir, SYSTEM_B)


@query
def latest_by_composite_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return snapshot.latest_by_ts(lines, ["l_partkey", "l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber"])


@query
def email_dedup(spark, sf_dir):
    return match.email_keys(_snapshot(spark, sf_dir, SYSTEM_A), SYSTEM_A).select("match_email", "a_id", "a_modified")


# Matching.


@query
def normalize_email(spark, sf_dir):
    return _changes(spark, sf_dir, SYSTEM_A).select("a_id", "a_version", keys.normalize_email(F.col("email")).alias("email"))


@query
def crosswalk(spark, sf_dir):
    return match.crosswalk(_matched(spark, sf_dir))


@query
def crosswalk_keep_unkeyed(spark, sf_dir):
    return match.crosswalk(_matched(spark, sf_dir, keep_unkeyed=True))


@query
def unified(spark, sf_dir):
    return _unified(spark, sf_dir)


@query
def unified_from_crosswalk(spark, sf_dir):
    sides = [_snapshot(spark, sf_dir, s) for s in (SYSTEM_A, SYSTEM_B)]
    return match.unify(match.attach_snapshots(match.crosswalk(match.match_records(*sides)), *sides))


@query
def row_checksum(spark, sf_dir):
    return history.with_checksum(_unified(spark, sf_dir)).select(UNIFIED_ID, "checksum")


@query
def row_checksum_prefixed(spark, sf_dir):
    return history.with_checksum(_unified(spark, sf_dir), length_prefixed=True).select(UNIFIED_ID, "checksum")


# History.


@query
def scd2_changes(spark, sf_dir):
    return history.scd2_changes(_unified(spark, sf_dir), _history(spark, sf_dir), AS_OF_2)


@query
def scd2_close(spark, sf_dir):
    past = _history(spark, sf_dir)
    return history.scd2_close(past, history.scd2_changes(_unified(spark, sf_dir), past, AS_OF_2), AS_OF_2)


@query
def scd2_untouched(spark, sf_dir):
    past = _history(spark, sf_dir)
    return history.scd2_untouched(past, history.scd2_changes(_unified(spark, sf_dir), past, AS_OF_2))


@query
def scd2_apply(spark, sf_dir):
    return history.scd2_apply(_unified(spark, sf_dir), _history(spark, sf_dir), AS_OF_2)


@query
def scd2_close_missing(spark, sf_dir):
    """History of all records, then only those of the first cut: the others close."""
    past = _history(spark, sf_dir, None)
    return history.scd2_apply(_unified(spark, sf_dir, FIRST_CUT), past, AS_OF_2, close_missing=True)


# Differences and outboxes.


@query
def field_deltas_long_a(spark, sf_dir):
    return deltas.deltas_long(deltas.field_deltas(_matched(spark, sf_dir), SYSTEM_A), SYSTEM_A)


@query
def field_deltas_long_b(spark, sf_dir):
    return deltas.deltas_long(deltas.field_deltas(_matched(spark, sf_dir), SYSTEM_B), SYSTEM_B)


@query
def field_deltas_newest(spark, sf_dir):
    return deltas.deltas_long(deltas.field_deltas(_matched(spark, sf_dir), SYSTEM_A, conflict="newest"), SYSTEM_A)


@query
def field_deltas_empty_is_null(spark, sf_dir):
    return deltas.deltas_long(deltas.field_deltas(_matched(spark, sf_dir), SYSTEM_B, empty_is_null=True), SYSTEM_B)


@query
def outbox_a(spark, sf_dir):
    return _outbox(spark, sf_dir, SYSTEM_A)


@query
def outbox_b(spark, sf_dir):
    return _outbox(spark, sf_dir, SYSTEM_B)


@query
def payload_explode(spark, sf_dir):
    return outbox.payload_long(_outbox(spark, sf_dir, SYSTEM_A), SYSTEM_A)


@query
def pending_outbox(spark, sf_dir):
    """After some results: rows tried before stand behind those that were not."""
    rows = outbox.take_pending(outbox_apply_results(spark, sf_dir), outbox.BATCH_ROWS)
    return rows.select(UNIFIED_ID, "a_id", "payload", "attempt", (~keys.is_missing(F.col("a_id"))).alias("deliverable"))


@query
def outbox_dead_letter(spark, sf_dir):
    lost = outbox.undeliverable(outbox.pending(_outbox(spark, sf_dir, SYSTEM_A)), SYSTEM_A)
    return state.undeliverable_letters(lost, SYSTEM_A, AS_OF_2)


@query
def payload_dead_letter(spark, sf_dir):
    """Some patches are cut off by a character."""
    cut = F.when(F.length("payload") % 5 == 0, F.left("payload", F.length("payload") - 1)).otherwise(F.col("payload"))
    rows = _outbox(spark, sf_dir, SYSTEM_A).withColumn("payload", cut)
    return state.undeliverable_letters(outbox.undeliverable(outbox.pending(rows), SYSTEM_A), SYSTEM_A, AS_OF_2)


def _batches(spark, rows: DataFrame) -> DataFrame:
    def store(placed: DataFrame) -> DataFrame:
        folder = work_folder(spark, "placed")
        placed.write.parquet(folder)
        return spark.read.parquet(folder)

    return outbox.number_batches(outbox.deliverable(outbox.pending(rows), SYSTEM_A), outbox.BATCH_ROWS, store)


@query
def push_batches(spark, sf_dir):
    """All rows to push after some results, in batches."""
    return _batches(spark, outbox_apply_results(spark, sf_dir)).select("batch", UNIFIED_ID, "a_id", "payload", "attempt")


@query
def outbox_apply_results(spark, sf_dir):
    results = view(spark, sf_dir, "push_results_a")
    return outbox.apply_results(_outbox(spark, sf_dir, SYSTEM_A), results, SYSTEM_A, AS_OF_2)


def _pushed_b(spark, sf_dir) -> DataFrame:
    return outbox.outcomes(_outbox(spark, sf_dir, SYSTEM_B), view(spark, sf_dir, "push_results_b"), SYSTEM_B)


@query
def audit_rows(spark, sf_dir):
    """Pushes record by record (B), pushes of batches (A), and an ingest."""
    records = state.audit_pushed_records(_pushed_b(spark, sf_dir), SYSTEM_B, AS_OF_2)
    batches = _batches(spark, _outbox(spark, sf_dir, SYSTEM_A))
    outcomes = outbox.batch_outcomes(batches, view(spark, sf_dir, "batch_results_a"))
    pushed = state.audit_pushed_batches(outcomes, SYSTEM_A, AS_OF_2)
    counted = landing.high_water(bronze_nested_json(spark, sf_dir), "a_modified")
    return records.unionByName(pushed).unionByName(state.audit_ingest(counted, SYSTEM_A, LOAD_TS, DEFAULT_START))


@query
def push_dead_letter(spark, sf_dir):
    return state.failed_letters(_pushed_b(spark, sf_dir), SYSTEM_B, AS_OF_2)


@query
def watermark_current(spark, sf_dir):
    rows = view(spark, sf_dir, "watermark_rows")
    return state.watermark_current(rows.withColumn("watermark_ts", F.col("watermark_ts").cast("timestamp_ntz")))


@query
def iso_timestamps(spark, sf_dir):
    iso = table(spark, sf_dir, "events").select("event_id", times.format_iso(F.col("ts")).alias("iso"), "event_type")
    return iso.select(
        "event_id", "iso", times.parse_iso(F.col("iso")).alias("parsed"),
        times.parse_iso(F.col("event_type")).alias("unreadable"),
    )


@query
def time_texts(spark, sf_dir):
    return view(spark, sf_dir, "time_texts").withColumn("parsed", times.parse_iso(F.col("text")))


# Translation of payloads.


@query
def translate_options(spark, sf_dir):
    dim = view(spark, sf_dir, "option_dim")
    rows = translate.translate_options(_outbox(spark, sf_dir, SYSTEM_B), dim, OPTION_SETS)
    return rows.select(UNIFIED_ID, "b_id", "payload")


@query
def bind_lookups(spark, sf_dir):
    return translate.bind_lookups(_outbox(spark, sf_dir, SYSTEM_B), LOOKUPS).select(UNIFIED_ID, "b_id", "payload")


@query
def translate_payload(spark, sf_dir):
    dim = view(spark, sf_dir, "option_dim")
    return translate.translate_payload(_outbox(spark, sf_dir, SYSTEM_B), dim, OPTION_SETS, LOOKUPS)


# Text.


@query
def digit_words(spark, sf_dir):
    return view(spark, sf_dir, "text_rows").select("doc_id", text.digit_words(F.col("text")).alias("text"))


@query
def redact_cards(spark, sf_dir):
    return view(spark, sf_dir, "text_rows").select("doc_id", text.redact_cards(F.col("text")).alias("text"))


@query
def redact_text(spark, sf_dir):
    return view(spark, sf_dir, "text_rows").select("doc_id", text.redact_text(F.col("text")).alias("text"))


@query
def redact_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.redact_text(F.col("text")).alias("text"))


# End to end.


@query
def sync_flagship(spark, sf_dir):
    return sync_job.sync_view(_matched(spark, sf_dir))


DROPS = 3
SMALL = 4  # buckets of a state: the given tables are far below a gigabyte


def _land_in_drops(rows: DataFrame, folder: str, drop) -> None:
    """Lands the rows in three drops of two files each: a stream that takes two files takes a drop at a time."""
    for number in range(DROPS):
        incremental.land_text(rows.where(F.pmod(drop, F.lit(DROPS)) == number).repartition(2), folder)


@query
def stream_ingest(spark, sf_dir):
    folder = work_folder(spark, "stream-ingest")
    _land_in_drops(view(spark, sf_dir, "raw_a"), f"{folder}/landing", F.crc32(F.col("raw").cast("binary")))
    return incremental.stream_ingest(
        Tables(spark, f"{folder}/tables", buckets=SMALL), f"{folder}/landing", f"{folder}/checkpoint", SYSTEM_A, LOAD_TS, files_per_batch=2
    )


@query
def stream_snapshot(spark, sf_dir):
    """The versions of a record come in several drops, in no order: older ones come late."""
    folder = work_folder(spark, "stream-snapshot")
    changes = _changes(spark, sf_dir, SYSTEM_A)
    for number in range(DROPS):
        drop = changes.where(F.col("a_version") % DROPS == number)
        incremental.land_text(landed_text(drop, SYSTEM_A).repartition(2), f"{folder}/landing")
    return incremental.stream_snapshot(
        Tables(spark, f"{folder}/tables", buckets=SMALL), f"{folder}/landing", f"{folder}/checkpoint", SYSTEM_A, LOAD_TS, files_per_batch=2
    )


def _two_runs(spark, sf_dir) -> Tables:
    """Two runs of the whole job over landed text of both systems, then results.

    The first run takes in what was modified before the first cut, the second all of it.
    """
    tables = Tables(spark, work_folder(spark, "two-runs"), buckets=SMALL)
    sides = [_changes(spark, sf_dir, s) for s in (SYSTEM_A, SYSTEM_B)]
    first = [side.where(F.col(s.modified) < times.at(FIRST_CUT)) for side, s in zip(sides, (SYSTEM_A, SYSTEM_B))]
    for run_id, changes, as_of in ((1, first, AS_OF_1), (2, sides, AS_OF_2)):
        landed = [landed_text(side, s) for side, s in zip(changes, (SYSTEM_A, SYSTEM_B))]
        sync_job.sync_run(tables, *landed, run_id=run_id, as_of=as_of)
    for run_id, system in ((3, SYSTEM_A), (4, SYSTEM_B)):
        results = view(spark, sf_dir, f"push_results_{system.name}")
        sync_job.take_results(tables, results, system, run_id, AS_OF_2)
    return tables


@query
def sync_two_runs(spark, sf_dir):
    """The history that two runs of the whole job leave."""
    return sync_job.full_history(_two_runs(spark, sf_dir))


@query
def sync_outboxes(spark, sf_dir):
    """The outboxes that they leave, after the results of a push."""
    tables = _two_runs(spark, sf_dir)
    sides = [
        sync_job.current_outbox(tables, s).withColumnRenamed(s.id, "target_id").withColumn("system", F.lit(s.name))
        for s in (SYSTEM_A, SYSTEM_B)
    ]
    return sides[0].unionByName(sides[1])


@query
def sync_letters(spark, sf_dir):
    """The dead letters that they leave."""
    return _two_runs(spark, sf_dir).log("meta/dead_letter")


@query
def sync_audit(spark, sf_dir):
    """What they say about themselves: how many rows of each kind, and the positions of the sources."""
    tables = _two_runs(spark, sf_dir)
    said = tables.log("meta/audit_log").groupBy("ts", "system", "operation", "status", "http_code").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("operation") == "ingest", F.col("message"))).alias("message")
    )
    moved = tables.state("meta/watermarks").select("source", "watermark_ts")
    return said.join(moved, F.col("system") == F.col("source")).drop("source")
