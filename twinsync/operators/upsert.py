"""Keyed insert-or-update as set algebra."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPREAD = 1024


def reject_duplicates(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows as they are; the job fails if two of them share a key (null keys are no key).

    Ranking stops at two rows per key and map task, before the shuffle, so a badly repeated key fails
    fast and does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= 2)
    failure = F.raise_error(F.lit(f"two rows of {what} share a key ({', '.join(keys)})")).cast("boolean")
    return ranked.where(F.when(F.col("_rank") == 2, failure).otherwise(F.lit(True))).drop("_rank")


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with every row of the source taken in: all columns updated on a match, else inserted.

    As with a merge, null keys match nothing, every target row of a matched key is updated, and two
    source rows with one key are an error.  One full outer join, so either side is read once.  Its source side is grouped
    by key first, which finds duplicates before the shuffle and leaves one row per key; rows without a key join under a
    number of their own content, which spreads them.
    """
    has_key = reduce(and_, (F.col(k).isNotNull() for k in keys))

    def spread(sign: int) -> Column:
        """0 beside a key; else 1 to 1024, above or below 0 by the side, so that the sides do not meet."""
        content = F.pmod(F.xxhash64(*target.columns), F.lit(_SPREAD)).cast("int") + 1
        return F.when(has_key, 0).otherwise(sign * content).alias("_spread")

    values = [c for c in target.columns if c not in keys] or keys[:1]
    failure = F.raise_error(F.lit(f"two rows of the source share a key ({', '.join(keys)})")).cast("boolean")
    # Rows without a key stay apart by a number of their own: they may be equal, and all are kept.
    alone = F.when(~has_key, F.monotonically_increasing_id()).alias("_alone")
    grouped = source.select(*target.columns, spread(-1), alone).groupBy(*keys, "_spread", "_alone").agg(
        F.count(F.lit(1)).alias("_rows"), F.any_value(F.struct(*values)).alias("_new")
    )
    unique = grouped.where(F.when(F.col("_rows") > 1, failure).otherwise(F.lit(True))).drop("_rows", "_alone")
    rows = target.select(*keys, F.struct(*values).alias("_old"), spread(1))
    merged = rows.join(unique, [*keys, "_spread"], "full")
    row = F.coalesce("_new", "_old")
    return merged.select(*(F.col(c) if c in keys else row[c].alias(c) for c in target.columns))
