"""Display values in patches to the values the target system stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.functions.payloads import from_typed_patch
from twinsync.operators.lookups import BROADCAST_BYTES, fits_broadcast, left_lookup
from twinsync.rules import UNIFIED_ID

# A lookup text of at least this many characters is an entity id.
ENTITY_ID_LENGTH = 32
BIND_SUFFIX = "@odata.bind"


def _is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def _text(value: Column) -> Column:
    return F.when(_is_text(value), F.try_variant_get(value, "$", "string"))


def translate_payload(
    outbox: DataFrame,
    option_dim: DataFrame | None = None,
    option_sets: Mapping[str, str] | None = None,
    lookups: Mapping[str, str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The outbox with translated payloads; all other columns stay.

    ``option_sets`` maps fields to option sets: a label becomes its code, an unknown label stays.
    ``lookups`` maps fields to entities: an entity id becomes ``<field>@odata.bind`` with
    ``/<entity>(<id>)``.  Other fields, nulls and values that are no text stay as they are.  Where a
    binding meets a field of its name, the later one stays.  A patch that cannot be read stays as it is.

    Each option field is one lookup by its own label, so no row is exploded or regrouped.
    """
    option_sets, lookups = dict(option_sets or {}), dict(lookups or {})
    rows = outbox.withColumn("_patch", from_typed_patch(F.col("payload")))

    codes = {}
    if option_sets:
        if option_dim is None:
            raise ValueError("option sets need their dimension")
        dimension = option_dim.groupBy("option_set", "label").agg(F.max("code").alias("code"))
        broadcast = fits_broadcast(dimension, broadcast_bytes)
        for number, (field, option_set) in enumerate(option_sets.items()):
            code = f"_code_{number}"
            labels = dimension.where(F.col("option_set") == option_set).select("label", F.col("code").alias(code))
            label = _text(F.try_element_at("_patch", F.lit(field)))
            rows = left_lookup(rows, labels, label, UNIFIED_ID, broadcast)
            codes[field] = F.col(code)

    def translated(key: Column, value: Column) -> Column:
        new_key, new_value = key, value
        for field, entity in lookups.items():
            if field in option_sets:
                continue
            binds = (key == field) & (F.length(_text(value)) >= ENTITY_ID_LENGTH)
            new_key = F.when(binds, F.lit(field + BIND_SUFFIX)).otherwise(new_key)
            bound = F.concat(F.lit(f"/{entity}("), _text(value), F.lit(")")).cast("variant")
            new_value = F.when(binds, bound).otherwise(new_value)
        for field, code in codes.items():
            coded = (key == field) & code.isNotNull()
            new_value = F.when(coded, code.cast("variant")).otherwise(new_value)
        return F.struct(new_key.alias("key"), new_value.alias("value"))

    entries = F.transform(F.map_entries("_patch"), lambda e: translated(e["key"], e["value"]))
    rows = rows.withColumn("_entries", entries)
    last = F.filter(
        "_entries",
        lambda e, i: ~F.exists(F.slice("_entries", i + 2, F.size("_entries")), lambda later: later["key"] == e["key"]),
    )
    payload = F.coalesce(F.to_json(F.map_from_entries(last)), F.col("payload"))
    return rows.select(*(payload.alias(c) if c == "payload" else F.col(c) for c in outbox.columns))


def translate_options(outbox: DataFrame, option_dim: DataFrame, option_sets: Mapping[str, str]) -> DataFrame:
    """Option labels to codes only."""
    return translate_payload(outbox, option_dim, option_sets)


def bind_lookups(outbox: DataFrame, lookups: Mapping[str, str]) -> DataFrame:
    """Entity ids to bindings only; needs no join."""
    return translate_payload(outbox, lookups=lookups)
