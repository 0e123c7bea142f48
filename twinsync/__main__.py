"""The job's steps from the command line, for a scheduler to call.

    python -m twinsync sync --root R --landed-a A --landed-b B --run-id 7 --as-of 2024-05-01
    python -m twinsync push --root R --system a --out requests/ [--batches 90]
    python -m twinsync results --root R --system a --results outcomes/ --run-id 8 --as-of 2024-05-01T01:00:00
    python -m twinsync redact --text docs/ --column text --out masked/
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from twinsync.functions.text import redact_text
from twinsync.operators import outbox
from twinsync.plans import sync_job
from twinsync.rules import CONTACTS, Entity, FieldRule
from twinsync.sources.tables import Tables


def read_rules(path: str) -> tuple[FieldRule, ...]:
    """Field rules from a JSON list of objects: unified, a, b, and optionally direction and strategy."""
    entries = json.loads(Path(path).read_text(encoding="utf-8"))
    return tuple(FieldRule(**{"a": None, "b": None, **entry}) for entry in entries)


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="twinsync")
    steps = parser.add_subparsers(dest="step", required=True)
    time = datetime.fromisoformat

    sync = steps.add_parser("sync", help="landed JSON text to fresh outboxes")
    push = steps.add_parser("push", help="write the next requests of an outbox")
    results = steps.add_parser("results", help="take in what came of a push")
    redact = steps.add_parser("redact", help="mask card numbers in a text column")
    for step in (sync, push, results):
        step.add_argument("--root", required=True, help="folder of the tables")
        step.add_argument("--rules", help="JSON file of field rules")
    for step in (sync, results):
        step.add_argument("--run-id", type=int, required=True, help="greater than any before; the same to repeat a run")
        step.add_argument("--as-of", type=time, required=True)
    sync.add_argument("--landed-a", required=True)
    sync.add_argument("--landed-b", required=True)
    sync.add_argument("--default-start", type=time, default=datetime(2000, 1, 1))
    sync.add_argument("--keep-unkeyed", action="store_true")
    sync.add_argument("--pages", action="store_true", help="each landed text is a page of records")
    for step in (push, results):
        step.add_argument("--system", choices=("a", "b"), required=True)
    push.add_argument("--size", type=int, help="rows at most; all pending rows if not given")
    push.add_argument("--batches", type=int, metavar="ROWS", help="one request per batch of so many rows")
    push.add_argument("--out", required=True)
    results.add_argument("--results", required=True, help="Parquet: target id, http_code, message")
    results.add_argument("--batches", action="store_true", help="results name a batch instead of a target id")
    redact.add_argument("--text", required=True, help="Parquet")
    redact.add_argument("--column", default="text")
    redact.add_argument("--out", required=True)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"twinsync-{args.step}").getOrCreate()
    if args.step == "redact":
        texts = spark.read.parquet(args.text)
        texts.withColumn(args.column, redact_text(F.col(args.column))).write.parquet(args.out)
        return

    entity: Entity = replace(CONTACTS, rules=read_rules(args.rules)) if args.rules else CONTACTS
    tables = Tables(spark, args.root, entity, keep_unkeyed=args.step == "sync" and args.keep_unkeyed)
    if args.step == "sync":
        landed = [spark.read.text(path).withColumnRenamed("value", "raw") for path in (args.landed_a, args.landed_b)]
        sync_job.sync_run(tables, *landed, args.run_id, args.as_of, args.default_start, args.pages)
        return
    target = entity.a if args.system == "a" else entity.b
    if args.step == "push" and args.batches:
        batches = sync_job.next_batches(tables, target, args.batches)
        outbox.batch_requests(batches, target).write.json(args.out)
    elif args.step == "push":
        sync_job.next_push(tables, target, args.size).requests.write.json(args.out)
    else:
        take = sync_job.take_batch_results if args.batches else sync_job.take_results
        take(tables, spark.read.parquet(args.results), target, args.run_id, args.as_of)


if __name__ == "__main__":
    main()
