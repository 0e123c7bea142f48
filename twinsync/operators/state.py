"""Incremental positions, audit rows and dead letters.

All are rows to append, but for positions, a small state of one row per entity and source.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.functions.keys import is_missing
from twinsync.functions.times import at, format_iso, request_id
from twinsync.operators.outbox import outcome_status
from twinsync.rules import CONTACTS, UNIFIED_ID, System


def watermark_current(watermarks: DataFrame) -> DataFrame:
    """The position written last, per entity and source; of several written at one time, the greatest.

    It may lie before an older one.  Two hash aggregates: the first leaves one position per time of writing.
    """
    at_once = watermarks.groupBy("entity", "source", "updated_at").agg(F.max("watermark_ts").alias("watermark_ts"))
    return at_once.groupBy("entity", "source").agg(F.max_by("watermark_ts", "updated_at").alias("watermark_ts"))


def watermark_of(positions: DataFrame, entity: str, source: str, default: datetime | None) -> datetime | None:
    """One position as a driver value, to go into a scan filter; the default when none was written."""
    row = watermark_current(positions.where((F.col("entity") == entity) & (F.col("source") == source))).first()
    return row["watermark_ts"] if row else default


def watermark_advance(positions: DataFrame, entity: str, moves: Mapping[str, datetime], as_of: datetime) -> DataFrame:
    """The positions after some sources of an entity have moved: still one row per entity and source."""
    spark = positions.sparkSession
    moved = [
        one_row(spark, **dict(zip(schemas.WATERMARKS.names, (F.lit(entity), F.lit(source), at(time), at(as_of)))))
        for source, time in moves.items()
    ]
    return reduce(DataFrame.unionByName, moved, positions.where(
        ~((F.col("entity") == entity) & F.col("source").isin(*moves))
    ))


def one_row(spark: SparkSession, **columns: Column) -> DataFrame:
    """A single row of driver values."""
    return spark.range(0, 1, 1, 1).select(*(column.alias(name) for name, column in columns.items()))


def audit_rows(
    rows: DataFrame,
    system: str,
    operation: str,
    as_of: datetime,
    status: Column,
    http_code: Column,
    message: Column,
    payload: Column | None = None,
    entity: str = CONTACTS.name,
    request_kind: str = "push",
) -> DataFrame:
    """One audit row per input row."""
    return rows.select(
        at(as_of).alias("ts"),
        F.lit(system).alias("system"),
        F.lit(entity).alias("entity"),
        F.lit(operation).alias("operation"),
        request_id(request_kind, at(as_of)).alias("request_id"),
        status.alias("status"),
        http_code.cast("int").alias("http_code"),
        message.alias("message"),
        (F.lit(None) if payload is None else payload).cast("string").alias("payload"),
    )


# Fixed values, here and below: the message texts of audit rows and dead letters.


def _audit_status(http_code: Column) -> Column:
    return F.when(outcome_status(http_code) == "SUCCESS", "SUCCESS").otherwise("FAILED")


def audit_pushed_records(
    outcomes: DataFrame, target: System, as_of: datetime, entity: str = CONTACTS.name
) -> DataFrame:
    """One row per pushed record; a failure keeps its message and patch."""
    code = F.col("http_code")
    success = _audit_status(code) == "SUCCESS"
    return audit_rows(
        outcomes, target.name, "push", as_of, _audit_status(code), code,
        F.when(success, F.concat(F.lit("Patched "), F.col(target.id))).otherwise(F.col("message")),
        F.when(~success, F.col("payload")),
        entity,
    )


def audit_pushed_batches(
    outcomes: DataFrame, target: System, as_of: datetime, entity: str = CONTACTS.name
) -> DataFrame:
    """One row per batch with its number of requests, or the message of its failure.

    ``outcomes`` has a row per request (batch, http_code, message); a batch has one code and message.
    """
    counted = outcomes.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.max("http_code").alias("http_code"), F.max("message").alias("message")
    )
    code = F.col("http_code")
    text = F.when(
        _audit_status(code) == "SUCCESS", F.concat(F.lit("Pushed "), F.col("n").cast("string"), F.lit(" records"))
    ).otherwise(F.col("message"))
    return audit_rows(counted, target.name, "push", as_of, _audit_status(code), code, text, entity=entity)


def audit_ingest(
    counted: DataFrame, source: System, as_of: datetime, since: datetime | None, entity: str = CONTACTS.name
) -> DataFrame:
    """One row for an ingest, from its row count and newest time (``records``, ``high_water``)."""
    payload = F.to_json(F.struct(
        format_iso(at(since)).alias("since"), format_iso(F.col("high_water")).alias("max")
    ), {"ignoreNullFields": "false"})
    message = F.concat(F.lit("Ingested "), F.col("records").cast("string"), F.lit(" records"))
    return audit_rows(
        counted, source.name, "ingest", as_of, F.lit("SUCCESS"), F.lit(200), message, payload, entity, "load"
    )


def dead_letters(
    rows: DataFrame,
    system: str,
    as_of: datetime,
    key: Column,
    reason: Column,
    payload: Column,
    entity: str = CONTACTS.name,
) -> DataFrame:
    """One dead-letter row per input row."""
    return rows.select(
        at(as_of).alias("ts"), F.lit(system).alias("system"), F.lit(entity).alias("entity"),
        key.alias("key"), reason.alias("reason"), payload.alias("payload"),
    )


def undeliverable_letters(
    rows: DataFrame, target: System, as_of: datetime, entity: str = CONTACTS.name
) -> DataFrame:
    """Dead letters for outbox rows without a target id, or else without a readable patch."""
    reason = F.when(is_missing(F.col(target.id)), f"Missing {target.id}").otherwise("Unreadable payload")
    return dead_letters(rows, target.name, as_of, F.col(UNIFIED_ID), reason, F.col("payload"), entity)


def failed_letters(
    outcomes: DataFrame, target: System, as_of: datetime, entity: str = CONTACTS.name
) -> DataFrame:
    """Dead letters for pushes that no retry will save."""
    final = outcomes.where(outcome_status(F.col("http_code")) == "FAILED")
    return dead_letters(final, target.name, as_of, F.col(UNIFIED_ID), F.col("message"), F.col("payload"), entity)
