"""Landed JSON text to typed bronze rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinsync import schemas
from twinsync.functions.times import at, parse_iso
from twinsync.operators.snapshot import first_per_key
from twinsync.operators.state import dead_letters
from twinsync.rules import CONTACTS, System

NO_DOCUMENT, MORE_TEXT, NO_LIST = "No document", "Text after the document", "No list of records"
_END = "_end"


def _record_type(system: System) -> T.StructType:
    names = dict.fromkeys(map(system.json_name, (system.modified, *system.attributes, *system.bronze_only)))
    fields = [T.StructField(name, T.StringType()) for name in names]
    identity = T.StructField(system.json_name(system.id), T.StringType())
    if system.nested:
        return T.StructType([identity, T.StructField(system.nested, T.StructType(fields))])
    return T.StructType([identity, *(f for f in fields if f.name != identity.name)])


def _page_type(system: System) -> T.StructType:
    """A page down to its list; records stay text, and everything beside the list is skipped."""
    kind: T.DataType = T.ArrayType(T.StringType())
    for name in reversed(system.records_at):
        kind = T.StructType([T.StructField(name, kind)])
    return kind


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds a costly column that later filters read but do not repeat.

    Spark moves a filter below a projection and writes the projection's expressions out in it; for JSON
    that is one parse per mention.  It does not do so below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _documents(rows: DataFrame, kind: T.StructType, name: str) -> DataFrame:
    """Column ``raw`` read as one JSON document each, in one parse, with ``fault`` where it is not one.

    A parser stops after the first document and takes what follows for none of its business.  So the text is read as a
    list, with a mark of the text behind it: a text that is one document gives a list of that and the mark.
    """
    marked = T.StructType([*kind.fields, T.StructField(_END, T.StringType())])
    mark = F.xxhash64("raw").cast("string")
    text = F.concat(F.lit("["), F.col("raw"), F.lit(f',{{"{_END}":"'), mark, F.lit('"}]'))
    found = _once(rows, F.from_json(text, T.ArrayType(marked)), "_list")
    ended = F.coalesce(F.try_element_at("_list", F.lit(-1))[_END] == mark, F.lit(False))
    # Only a text that is not one document is looked at again: does it begin with one?
    begun = F.coalesce(F.col("raw").rlike(r"^\s*\{"), F.lit(False)) & F.try_parse_json("raw").isNotNull()
    whole = ended & (F.size("_list") == 2)
    fault = F.when(whole, F.lit(None)).otherwise(F.when(begun, MORE_TEXT).otherwise(NO_DOCUMENT))
    found = _once(found, fault, "fault")
    first = F.when(F.col("fault").isNull(), F.try_element_at("_list", F.lit(1)))
    return found.withColumn(name, first).drop("_list")


def page_records(landed: DataFrame, system: System) -> DataFrame:
    """Landed pages in column ``raw`` to the text of each of their records.

    A page holds a list of records at ``records_at``; its links to other pages play no part.  A text that is no page is
    kept whole, with its ``page_fault``.  A page whose list is empty gives no rows.
    """
    pages = _documents(landed.select("raw"), _page_type(system), "page")
    records = F.col("page")
    for name in system.records_at:
        records = records.getField(name)
    fault = F.coalesce("fault", F.when(records.isNull(), NO_LIST))
    lost = F.array(F.struct(F.col("raw"), fault.alias("page_fault")))
    texts = F.transform(records, lambda text: F.struct(text.alias("raw"), F.lit(None).cast("string").alias("page_fault")))
    return pages.select(F.inline(F.when(fault.isNull(), texts).otherwise(lost)))


def parse_records(landed: DataFrame, system: System, load_ts: datetime) -> DataFrame:
    """One bronze row per JSON text in column ``raw``; ``modified_text`` keeps the time as written.

    Each text is parsed once, in the scan's own stage.  ``fault`` tells why a text is not one record's document; it then
    gives null columns.  Rows of ``page_records`` keep the fault of their page.
    """
    paged = ["page_fault"] if "page_fault" in landed.columns else []
    record = _documents(landed.select("raw", *paged), _record_type(system), "record")
    body = F.col("record").getField(system.nested) if system.nested else F.col("record")
    modified = body.getField(system.json_name(system.modified))
    record = _once(record, parse_iso(modified), "modified_ts")
    texts = [body.getField(system.json_name(c)).alias(c) for c in (*system.attributes, *system.bronze_only)]
    return record.select(
        at(load_ts).alias("load_ts"),
        F.col("record").getField(system.json_name(system.id)).alias(system.id),
        F.col("modified_ts").alias(system.modified),
        *texts,
        "raw",
        modified.alias("modified_text"),
        F.coalesce(*paged, "fault").alias("fault"),
    )


def parse_pages(landed: DataFrame, system: System, load_ts: datetime) -> DataFrame:
    """As ``parse_records``, for landed pages."""
    return parse_records(page_records(landed, system), system, load_ts)


def reject_reason(system: System, timed: bool = False) -> Column:
    """Why a parsed row cannot be kept; null when it can.  Only where rows must be ``timed`` is a time required."""
    reason = (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(F.col(system.id).isNull(), "Missing record id")
        .when(F.col("modified_text").isNotNull() & F.col(system.modified).isNull(), "Unreadable modified time")
    )
    return reason.when(F.col("modified_text").isNull(), "Missing modified time") if timed else reason


def modified_since(rows: DataFrame, modified: str, since: datetime | None) -> DataFrame:
    """Rows at or after the position; all rows when there is none.  Reaches the scan as a pushed filter."""
    return rows if since is None else rows.where(F.col(modified) >= at(since))


def in_source_order(rows: DataFrame, modified: str, *tie_break: str) -> DataFrame:
    """Oldest change first: a range-partitioned sort, for ordered export."""
    return rows.orderBy(F.col(modified).asc(), *tie_break)


def high_water(rows: DataFrame, modified: str) -> DataFrame:
    """Row count and newest modified time in one pass; null times do not count as newest."""
    return rows.agg(F.count(F.lit(1)).alias("records"), F.max(modified).alias("high_water"))


def sort_out(parsed: DataFrame, system: System, since: datetime | None = None) -> DataFrame:
    """The rows of a landed batch as stored (``schemas.landed``): those to keep, and those rejected.

    With a position, a record without a modified time stands neither before nor after it, and is rejected.
    """
    reason = reject_reason(system, timed=since is not None)
    marked = parsed.withColumns({
        "reject_reason": reason,
        "rejected": reason.isNotNull(),
        "load_date": F.to_date("load_ts"),
    })
    if since is not None:
        marked = marked.where(F.col("rejected") | (F.col(system.modified) >= at(since)))
    return marked.select(*schemas.landed(system).names)


def kept(stored: DataFrame, system: System) -> DataFrame:
    """The bronze rows among stored ones; reads no folder of rejected rows."""
    return stored.where(~F.col("rejected")).select(*schemas.bronze(system).names)


def rejected_letters(
    stored: DataFrame, system: System, as_of: datetime, entity: str = CONTACTS.name
) -> DataFrame:
    """Dead letters for the rejected ones among stored rows, with the text as landed."""
    lost = stored.where(F.col("rejected"))
    return dead_letters(lost, system.name, as_of, F.col(system.id), F.col("reject_reason"), F.col("raw"), entity)


def accepted_records(parsed: DataFrame, system: System, since: datetime | None = None) -> DataFrame:
    """The bronze rows of a landed batch, without a table between."""
    return kept(sort_out(parsed, system, since), system)


def landing_metrics(system: System) -> dict[str, Column]:
    """Aggregates of stored rows (``schemas.landed``) that an ingest needs, for the write itself to count."""
    kept_row = ~F.col("rejected")
    return {
        "accepted": F.count_if(kept_row),
        "rejected": F.count_if(F.col("rejected")),
        "high_water": F.max(F.when(kept_row, F.col(system.modified))).cast("string"),
    }


_OPTION_SET = """
    Name string,
    Options array<struct<Value: bigint, Label: struct<LocalizedLabels: array<struct<Label: string>>>>>
"""


def option_set_dimension(metadata: DataFrame) -> DataFrame:
    """Option-set documents in column ``raw`` to one row per (option_set, label) with its code.

    An option's label is its first localised one.  Where a set gives a label twice, the later option
    wins.  The window sees one row per label and map task: earlier ones are dropped before the shuffle.
    """
    document = metadata.select(F.from_json("raw", _OPTION_SET).alias("d"))
    options = document.select(F.col("d.Name").alias("option_set"), F.posexplode("d.Options").alias("position", "o"))
    labels = options.select(
        "option_set",
        F.try_element_at("o.Label.LocalizedLabels", F.lit(1))["Label"].alias("label"),
        F.col("o.Value").alias("code"),
        "position",
    ).where(F.col("label").isNotNull())
    latest = first_per_key(labels, ["option_set", "label"], [F.desc("position"), F.desc_nulls_last("code")])
    return latest.select("option_set", "label", "code")
