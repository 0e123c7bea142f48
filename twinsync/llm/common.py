"""What the operators share: inputs, stored steps, and marks of rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsync.session import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage so that a lost executor costs one step, and fixes what a later step must see unchanged
    (row numbers, names).  What was shuffled for them is removed.
    """
    spark = rows.sparkSession
    folder = work_folder(spark, purpose)
    with _shuffles_removed(spark):
        rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def whole_text(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_mod(doc_id: str, modulus: int) -> Column:
    """CRC-32 of an id's text, modulo; an id that is null has none."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(modulus)
