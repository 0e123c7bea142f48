"""Taking pending patches, and taking back what came of them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsync.functions.keys import is_missing
from twinsync.functions.payloads import from_patch, is_unreadable
from twinsync.functions.times import at
from twinsync.operators.upsert import reject_duplicates
from twinsync.rules import UNIFIED_ID, System

# Rows that a bounded push of system A takes, and the response codes worth another attempt.
BATCH_ROWS = 90
RETRYABLE_CODES = (429, 500, 502, 503, 504)
_PLACE_BITS = 33  # of a generated id, that tell the place within a partition


class Batch(NamedTuple):
    requests: DataFrame  # unified id, target id, properties (map)
    undeliverable: DataFrame  # pending rows without a target id or a readable patch
    rows: DataFrame  # all rows taken


def pending(outbox: DataFrame) -> DataFrame:
    return outbox.where(F.col("status") == "PENDING")


def deliverable(rows: DataFrame, target: System) -> DataFrame:
    return rows.where(~_unsendable(target))


def undeliverable(rows: DataFrame, target: System) -> DataFrame:
    """Rows that name no record of the target, by a null or an empty id, or whose patch cannot be read."""
    return rows.where(_unsendable(target))


def _unsendable(target: System) -> Column:
    return is_missing(F.col(target.id)) | is_unreadable(F.col("payload"))


def _push_order() -> list[Column]:
    """Rows tried least often come first, then those tried longest ago, so that rows to try again block no others."""
    return [F.col("attempt").asc_nulls_first(), F.col("last_attempt_ts").asc_nulls_first(), F.col(UNIFIED_ID)]


def take_pending(outbox: DataFrame, size: int | None = None) -> DataFrame:
    """The rows to push: all pending ones, or the next ``size``, in the order of pushes."""
    rows = pending(outbox)
    return rows if size is None else rows.orderBy(*_push_order()).limit(size)


def number_batches(rows: DataFrame, size: int, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows with ``batch`` (from 0): ``size`` rows each, but for the last, in the order of pushes.

    Rows are sorted over all partitions and stored (``store`` writes them and reads them back), each with its partition
    and its place there.  The counts per partition, added up, give where a partition begins.  No task sees more
    than its own rows, and the driver none.
    """
    if size < 1:
        raise ValueError("a batch takes at least one row")
    placed = store(rows.orderBy(*_push_order()).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition of the sort: its number bounds this window and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.select(F.floor(place / size).alias("batch"), *rows.columns)


def batch_requests(batches: DataFrame, target: System) -> DataFrame:
    """One request per batch: its number of records, and its body as JSON text.

    A batch has a bounded number of rows, so a body is bounded too.  A list of records in the order of their ids.
    """
    record = F.struct(
        F.col(target.id).alias("id"), from_patch(F.col("payload")).alias("properties"), F.col(UNIFIED_ID).alias("order")
    )
    listed = F.array_sort(F.collect_list(record), lambda x, y: F.when(x["order"] < y["order"], -1).otherwise(1))
    inputs = F.transform(listed, lambda r: F.struct(r["id"].alias("id"), r["properties"].alias("properties")))
    return batches.groupBy("batch").agg(
        F.count(F.lit(1)).alias("records"), F.to_json(F.struct(inputs.alias("inputs"))).alias("body")
    )


def next_batch(outbox: DataFrame, target: System, size: int | None = None) -> Batch:
    """The next push, split into requests and rows that cannot be sent."""
    rows = take_pending(outbox, size)
    requests = deliverable(rows, target).select(UNIFIED_ID, target.id, from_patch(F.col("payload")).alias("properties"))
    return Batch(requests, undeliverable(rows, target), rows)


def payload_long(outbox: DataFrame, target: System) -> DataFrame:
    """One row per field of every patch."""
    return outbox.select(UNIFIED_ID, target.id, F.explode(from_patch(F.col("payload"))).alias("field", "value"))


def outcome_status(http_code: Column) -> Column:
    """Success for 2xx, pending for codes worth another attempt, else failed."""
    return (
        F.when(http_code.between(200, 299), "SUCCESS")
        .when(http_code.isin(*RETRYABLE_CODES), "PENDING")
        .otherwise("FAILED")
    )


def batch_outcomes(batches: DataFrame, results: DataFrame) -> DataFrame:
    """What came of each batch (batch, http_code, message), for each of its rows.

    Batches without a result are left out; two results for a batch are an error.
    """
    unique = reject_duplicates(results.where(F.col("batch").isNotNull()), ["batch"], "the results")
    return batches.join(unique.select("batch", "http_code", "message"), ["batch"])


def apply_results(outbox: DataFrame, results: DataFrame, target: System, as_of: datetime) -> DataFrame:
    """The outbox after a push.

    Pending rows with a result take its status, one more attempt and the time.  Pending rows without a
    target id or a readable patch fail, once and without an attempt.  All others stay.  Rows without an id join under their
    unified id, which spreads them; the test on the id keeps them unmatched.
    """
    unique = reject_duplicates(results.where(F.col(target.id).isNotNull()), [target.id], "the results")
    side = unique.select(F.col(target.id).alias("_result_id"), F.col("http_code").alias("_code"))
    key = F.coalesce(F.col(target.id), F.col(UNIFIED_ID)) == F.col("_result_id")
    sent = (F.col("status") == "PENDING") & ~_unsendable(target)
    return _after(outbox.join(side, key & sent, "left"), outbox.columns, target, as_of)


def settle(outbox: DataFrame, pushed: DataFrame, target: System, as_of: datetime) -> DataFrame:
    """As ``apply_results``, for outcomes that are known per row (unified id, http_code)."""
    side = pushed.select(UNIFIED_ID, F.col("http_code").alias("_code"))
    return _after(outbox.join(side, [UNIFIED_ID], "left"), outbox.columns, target, as_of)


def _after(joined: DataFrame, columns: list[str], target: System, as_of: datetime) -> DataFrame:
    attempted = F.col("_code").isNotNull()
    new = {
        "status": F.when(attempted, outcome_status(F.col("_code"))).when(
            (F.col("status") == "PENDING") & _unsendable(target), "FAILED"
        ),
        "attempt": F.when(attempted, F.col("attempt") + 1),
        "last_attempt_ts": F.when(attempted, at(as_of)),
    }
    return joined.select(*(F.coalesce(new[c], F.col(c)).alias(c) if c in new else F.col(c) for c in columns))


def outcomes(outbox: DataFrame, results: DataFrame, target: System) -> DataFrame:
    """The pending rows that were pushed, with their results."""
    unique = reject_duplicates(results.where(F.col(target.id).isNotNull()), [target.id], "the results")
    rows = deliverable(pending(outbox), target).select(UNIFIED_ID, target.id, "payload")
    return rows.join(unique.select(target.id, "http_code", "message"), [target.id]).select(
        UNIFIED_ID, target.id, "payload", "http_code", "message"
    )
