"""Ingest and snapshot upkeep as streams over landed files.

The stream's checkpoint takes the place of the position table: each run picks up the files that came since.  A
micro-batch commits under the stream's own id and its batch id, all it writes at once, so a batch that is repeated after a
failure is written if it was not, and left alone if it was.  A stream with a new checkpoint is another writer, and
adds to what others wrote.  The job and any number of streams may write the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsync.plans import sync_job
from twinsync.rules import System
from twinsync.sources import landing
from twinsync.sources.tables import Tables, Work, bucket_marks, bucket_of, marked_buckets


def _landed(spark: SparkSession, landing_dir: str, files_per_batch: int | None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(landing_dir).withColumnRenamed("value", "raw")


def _run_available(stream: DataFrame, tables: Tables, checkpoint: str, steps: Callable[[Work, DataFrame], None]) -> None:
    """Takes in what is there, one commit per micro-batch."""
    query_id: Future[str] = Future()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The id is kept in the checkpoint; it is known once the stream has started.
        tables.run(lambda work: steps(work, batch), f"stream {query_id.result()}", batch_id)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query_id.set_result(query.id)
    query.awaitTermination()


def stream_ingest(
    tables: Tables,
    landing_dir: str,
    checkpoint: str,
    system: System,
    load_ts: datetime,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Takes in all landed files not seen before, then returns the whole bronze table."""
    name = f"bronze/{system.name}_raw"

    def steps(work: Work, batch: DataFrame) -> None:
        found = sync_job.ingest(work, batch, system, load_ts, None)
        if found.letters is not None:
            work.append("meta/dead_letter", found.letters, ("system", "entity"))

    _run_available(_landed(tables.spark, landing_dir, files_per_batch), tables, checkpoint, steps)
    return landing.kept(tables.log(name), system)


def stream_snapshot(
    tables: Tables,
    landing_dir: str,
    checkpoint: str,
    system: System,
    load_ts: datetime,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Keeps the snapshot of a system current with its landed files, then returns it.

    A micro-batch rewrites the buckets of the snapshot that its records change, and adds to the system's changes, which
    the next run of the job takes on to matches, history and outboxes.
    """

    def steps(work: Work, batch: DataFrame) -> None:
        parsed = landing.parse_records(batch, system, load_ts)
        changes = work.scratch(f"stream/{system.name}", landing.accepted_records(parsed, system))
        marks = changes.agg(bucket_marks(bucket_of([system.id], tables.buckets)).alias("buckets")).first()
        sync_job.take_in(work, changes, marked_buckets(marks["buckets"]), system)

    _run_available(_landed(tables.spark, landing_dir, files_per_batch), tables, checkpoint, steps)
    return tables.state(f"silver/{system.name}_snapshot")


def land_text(rows: DataFrame, landing_dir: str) -> None:
    """Writes column ``raw`` as landed text files, one record per line."""
    rows.select(F.col("raw").alias("value")).write.mode("append").text(landing_dir)
