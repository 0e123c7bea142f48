"""Left join to a dimension whose size is measured first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 64


def fits_broadcast(dimension: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the text of all rows, plus a fixed overhead per row, stays under the limit."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dimension.columns), F.lit(0))
    size = dimension.agg(F.sum(width + F.lit(_ROW_OVERHEAD)).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def left_lookup(rows: DataFrame, dimension: DataFrame, key: Column, row_id: str, broadcast: bool) -> DataFrame:
    """``rows`` with the value columns of ``dimension``, whose first column is its unique key.

    With ``broadcast`` (see ``fits_broadcast``) the rows are not shuffled.  Else they are, by key: rows
    without one join under their own id, which spreads them, and the partition of a hot key is one that
    Spark splits at run time, as a left join lets it split its left side.
    """
    name, *values = dimension.columns
    side = dimension.where(F.col(name).isNotNull()).withColumnRenamed(name, "_lookup_key")
    keyed = rows.withColumn("_row_key", key)
    match = F.coalesce(F.col("_row_key"), F.col(row_id)) == F.col("_lookup_key")
    joined = keyed.join(F.broadcast(side) if broadcast else side, match & F.col("_row_key").isNotNull(), "left")
    return joined.select(*rows.columns, *values)
