"""Table schemas by layer.  All times are UTC wall-clock times (TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinsync.rules import CONTACTS, UNIFIED_ID, Entity, System


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STR, _INT, _BOOL, _TIME = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampNTZType()


def bronze(system: System) -> T.StructType:
    texts = (*system.attributes, *system.bronze_only, "raw")
    return _schema(("load_ts", _TIME), (system.id, _STR), (system.modified, _TIME), *((c, _STR) for c in texts))


def landed(system: System) -> T.StructType:
    """Bronze rows as stored: rows that cannot be kept lie beside the others, in a folder of their own."""
    return T.StructType([
        *bronze(system).fields, *_schema(("reject_reason", _STR), ("rejected", _BOOL), ("load_date", T.DateType())).fields
    ])


def snapshot(system: System) -> T.StructType:
    return _schema((system.id, _STR), (system.modified, _TIME), *((c, _STR) for c in system.attributes))


def outbox(system: System) -> T.StructType:
    return _schema(
        (UNIFIED_ID, _STR), (system.id, _STR), ("payload", _STR), ("status", _STR),
        ("attempt", _INT), ("last_attempt_ts", _TIME),
    )


def crosswalk(entity: Entity) -> T.StructType:
    return _schema((UNIFIED_ID, _STR), ("email", _STR), *((s.id, _STR) for s in entity.systems))


def matched(entity: Entity) -> T.StructType:
    sides = [(s.matched(f.name), f.dataType) for s in entity.systems for f in snapshot(s).fields]
    return _schema((UNIFIED_ID, _STR), ("match_email", _STR), *sides)


def unified(entity: Entity) -> T.StructType:
    return _schema((UNIFIED_ID, _STR), *((c, _STR) for c in entity.fields))


def history(entity: Entity) -> T.StructType:
    times = (("valid_from", _TIME), ("valid_to", _TIME), ("is_current", _BOOL), ("checksum", _STR))
    return _schema(*((f.name, f.dataType) for f in unified(entity).fields), *times)


def keyed(system: System) -> T.StructType:
    return _schema((UNIFIED_ID, _STR), ("match_email", _STR), *((f.name, f.dataType) for f in snapshot(system).fields))


def changes(system: System) -> T.StructType:
    """Records that a run changed, with the key that each had before and has now."""
    return _schema(("old_uid", _STR), *((f.name, f.dataType) for f in keyed(system).fields))


def batches(system: System) -> T.StructType:
    return _schema(("batch", T.LongType()), (UNIFIED_ID, _STR), (system.id, _STR), ("payload", _STR))


WATERMARKS = _schema(("entity", _STR), ("source", _STR), ("watermark_ts", _TIME), ("updated_at", _TIME))
PUSHES = _schema((UNIFIED_ID, _STR), ("status", _STR), ("attempt", _INT), ("last_attempt_ts", _TIME))
AUDIT_LOG = _schema(
    ("ts", _TIME), ("system", _STR), ("entity", _STR), ("operation", _STR), ("request_id", _STR),
    ("status", _STR), ("http_code", _INT), ("message", _STR), ("payload", _STR),
)
DEAD_LETTER = _schema(
    ("ts", _TIME), ("system", _STR), ("entity", _STR), ("key", _STR), ("reason", _STR), ("payload", _STR)
)

# States that lie in one bucket: a row per source, however many records there are.
SMALL_STATES = ("meta/watermarks",)


def tables(entity: Entity) -> dict[str, T.StructType]:
    """Layer and schema of each table.  Those in ``state_keys`` are states, the others logs."""
    per_system = {}
    for system in entity.systems:
        per_system[f"bronze/{system.name}_raw"] = landed(system)
        per_system[f"silver/{system.name}_snapshot"] = snapshot(system)
        per_system[f"silver/{system.name}_changes"] = changes(system)
        per_system[f"silver/{system.name}_keyed"] = keyed(system)
        per_system[f"gold/{system.name}_outbox"] = outbox(system)
        per_system[f"gold/{system.name}_pushes"] = PUSHES
        per_system[f"gold/{system.name}_batches"] = batches(system)
    return {
        **per_system,
        "silver/matched": matched(entity),
        "silver/crosswalk": crosswalk(entity),
        "silver/unified": unified(entity),
        "silver/history_open": history(entity),
        "silver/history_closed": history(entity),
        "meta/watermarks": WATERMARKS,
        "meta/audit_log": AUDIT_LOG,
        "meta/dead_letter": DEAD_LETTER,
    }


def state_keys(entity: Entity) -> dict[str, tuple[str, ...]]:
    """The columns that each state's rows are dealt to buckets by."""
    keys: dict[str, tuple[str, ...]] = {"meta/watermarks": ("entity", "source")}
    for system in entity.systems:
        keys[f"silver/{system.name}_snapshot"] = (system.id,)
        for name in ("silver/{}_keyed", "gold/{}_outbox", "gold/{}_pushes", "gold/{}_batches"):
            keys[name.format(system.name)] = (UNIFIED_ID,)
    for name in ("matched", "crosswalk", "unified", "history_open"):
        keys[f"silver/{name}"] = (UNIFIED_ID,)
    return keys


# The tables of contacts.
CROSSWALK, MATCHED, UNIFIED, HISTORY = (make(CONTACTS) for make in (crosswalk, matched, unified, history))
TABLES = tables(CONTACTS)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The state of a table before its first write.  Spark knows that it has no rows, and skips joins with it."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)
