"""Parquet tables in a shared folder: logs that only grow, and states that are replaced bucket by bucket.

Data files are written first, into folders of their own; a commit then names them (``commits``), with schema and row
count.  What no commit names is not there: a writer that dies leaves the tables as they were, and one that takes several
steps (``Tables.run``) shows all of them or none.

A state lies in hash buckets of its key.  A commit names for each bucket the folder that holds it, so a step that knows
which buckets its rows touch reads and writes only those, and all others stay where they are.

A writer that finds that another has committed in between goes on from there if the other left alone what it had read
and written, and else takes its inputs again.
"""

from __future__ import annotations

import json
import random
import threading
import time
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from copy import deepcopy
from typing import Any, NamedTuple, TypeVar

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinsync import schemas
from twinsync.rules import CONTACTS, Entity
from twinsync.session import work_folder
from twinsync.sources.commits import Commit, CommitLog, Conflict

BUCKETS = 16
TRIES = 8
_BUCKET = "bucket"
Result = TypeVar("Result")


class Written(NamedTuple):
    """Rows as written, and what was counted on the way."""

    rows: DataFrame
    count: int
    metrics: dict[str, Any]


def bucket_of(key: Sequence[str | Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def bucket_marks(bucket: Column) -> Column:
    """An aggregate of the buckets that occur (null is none), as text: see ``marked_buckets``."""
    return F.hex(F.bitmap_construct_agg(bucket.cast("bigint")))


def marked_buckets(marks: str | None) -> set[int]:
    bits = bytes.fromhex(marks or "")
    return {8 * at + bit for at, byte in enumerate(bits) for bit in range(8) if byte >> bit & 1}


def _same(one: T.StructType, other: T.StructType) -> bool:
    return {(f.name, f.dataType) for f in one.fields} == {(f.name, f.dataType) for f in other.fields}


class Tables:
    """The tables of an entity, under one folder.

    ``buckets`` (of a state) and ``keep_unkeyed`` (see ``match_records``) belong to the tables: give the same each time.
    A bucket is the least that a run rewrites, so choose their number for buckets of about a gigabyte.
    """

    def __init__(
        self, spark: SparkSession, root: str, entity: Entity = CONTACTS, buckets: int = BUCKETS, keep_unkeyed: bool = False
    ) -> None:
        self.spark = spark
        self.keep_unkeyed = keep_unkeyed
        self.root = root.rstrip("/")
        self.entity = entity
        self.schemas = schemas.tables(entity)
        self.keys = schemas.state_keys(entity)
        self.buckets = buckets
        self.commits = CommitLog(self.root)

    def run(self, steps: Callable[[Work], Result], writer: str = "", number: int = 0) -> Result | None:
        """Takes the steps and commits what they wrote, all at once.

        A named writer gives each of its runs a number.  A number that it has committed before, or one below, is done:
        nothing is read or written, and the result is None.
        """
        tries = 0
        while tries < TRIES:
            work = Work(self, self.commits.latest())
            if writer and number <= work.base.writers.get(writer, -1):
                return None
            result = steps(work)
            while tries < TRIES:
                tries += 1
                try:
                    self.commits.write(work.commit(writer, number))
                    return result
                except Conflict:
                    time.sleep(random.uniform(0.05, 0.15) * tries)
                    if not work.rebase(self.commits.latest()) or (writer and number <= work.base.writers.get(writer, -1)):
                        break
        raise Conflict(f"{TRIES} tries met other writers of the same tables in {self.root}")

    def append(self, name: str, rows: DataFrame, partition_by: Sequence[str] = (), many_values: bool = False) -> DataFrame:
        """Adds rows to a log and returns them as written."""
        return self.run(lambda work: work.append(name, rows, partition_by, many_values).rows)

    def replace(self, name: str, rows: DataFrame, only: Collection[int] | None = None) -> DataFrame:
        """Replaces a state, or some of its buckets, and returns it."""
        self.run(lambda work: work.replace(name, rows, only))
        return self.state(name)

    def log(self, name: str) -> DataFrame:
        return Work(self, self.commits.latest()).log(name)

    def state(self, name: str, only: Collection[int] | None = None) -> DataFrame:
        return Work(self, self.commits.latest()).state(name, only)

    def rewrite(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """Takes a state to a new schema: it is read as it was written, changed, and checked against the schema now."""

        def step(work: Work) -> None:
            work.replace(name, change(work.state(name, checked=False)))

        self.run(step)

    def verify(self) -> None:
        """Counts the rows of all that is committed; an error if a table does not hold what its commits tell."""
        commit = self.commits.latest()
        work = Work(self, commit)
        for name, state in commit.states.items():
            whole = [part for part in state["parts"] if part["buckets"] == part["written"]]
            self._verify(name, whole, work._read_buckets(name, whole, None))
        for name in {*commit.logs, *self.commits.read(commit.since).logs}:
            parts = self.commits.parts(commit, name)
            self._verify(name, parts, work._read_parts(name, parts))

    def _verify(self, name: str, parts: list[dict], rows: DataFrame) -> None:
        there, told = rows.count(), sum(part["rows"] for part in parts)
        if there != told:
            raise ValueError(f"{name} holds {there} rows where its commits tell {told}")

    def expire(self, keep: int = 2) -> int:
        """Deletes the folders of states that none of the newest ``keep`` commits names; returns how many.

        Readers of older commits lose them; logs stay whole.
        """
        numbers = self.commits.numbers()
        old, new = numbers[:-keep], numbers[-keep:]
        named = lambda some: {
            part["folder"] for n in some for state in self.commits.read(n).states.values() for part in state["parts"]
        }
        kept = named(new)
        gone, base = 0, self.commits.folder.rpartition("/")[0]
        for folder in named(old) - kept:
            if self.commits.files.get_file_info(f"{base}/{folder}").type == fs.FileType.Directory:
                self.commits.files.delete_dir(f"{base}/{folder}")
                gone += 1
        return gone


class Work:
    """Steps on the tables as one commit left them.  Its own writes are seen by its later reads, and by no one else."""

    def __init__(self, tables: Tables, base: Commit) -> None:
        self.tables, self.base = tables, base
        self.spark = tables.spark
        self._token = uuid.uuid4().hex
        self._lock = threading.Lock()
        self._states: dict[str, dict] = {}
        self._added: dict[str, list[dict]] = {}
        self._read: set[str] = set()
        self._done: list[str] = []

    def done(self, what: str) -> None:
        """Marks something as taken in up to and including this commit: see ``Commit.writers``."""
        self._done.append(what)

    # Reading.

    def _state(self, name: str) -> dict | None:
        with self._lock:
            self._read.add(name)
            return self._states.get(name) or self.base.states.get(name)

    def _schema(self, name: str, parts: list[dict], checked: bool = True) -> T.StructType:
        """The schema now, which the rows must have been written with."""
        written = [T.StructType.fromJson(json.loads(text)) for text in {part["schema"] for part in parts}]
        schema = self.tables.schemas.get(name)
        if schema is None or not checked:
            return written[0]
        for other in written:
            if not _same(schema, other):
                raise ValueError(f"{name} was written with columns {other.names}, not {schema.names}; see Tables.rewrite")
        return schema

    def state(self, name: str, only: Collection[int] | None = None, checked: bool = True) -> DataFrame:
        """A state, or some of its buckets; empty before its first write."""
        state = self._state(name)
        return self._read_buckets(name, state["parts"] if state else [], only, checked)

    def _read_buckets(self, name: str, parts: list[dict], only: Collection[int] | None, checked: bool = True) -> DataFrame:
        paths = [
            f"{self.tables.root}/{part['folder']}/{_BUCKET}={bucket}"
            for part in parts for bucket in part["buckets"] if only is None or bucket in only
        ]
        if not paths:
            return schemas.empty(self.spark, self._schema(name, parts, checked) if parts else self.tables.schemas[name])
        schema = self._schema(name, parts, checked)
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)

    def log(self, name: str, since: int = 0) -> DataFrame:
        """All rows of a log, or those of the commits after one, with what this work added."""
        return self._read_parts(name, self.parts(name, since))

    def parts(self, name: str, since: int = 0) -> list[dict]:
        """What a log was given, commit by commit."""
        with self._lock:
            own = list(self._added.get(name, []))
        return [*(p for p in self.tables.commits.parts(self.base, name) if p["commit"] > since), *own]

    def _read_parts(self, name: str, parts: list[dict]) -> DataFrame:
        full = [part for part in parts if part["rows"]]
        if not full:
            return schemas.empty(self.spark, self.tables.schemas[name])
        schema = self._schema(name, full)
        paths = [f"{self.tables.root}/{part['folder']}" for part in full]
        base = f"{self.tables.root}/{'/'.join(full[0]['folder'].split('/')[:2])}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    # Writing.

    def _write(
        self, name: str, rows: DataFrame, partition_by: Sequence[str], metrics: Mapping[str, Column], schema: T.StructType
    ) -> tuple[str, int, dict]:
        declared = self.tables.schemas.get(name)
        if declared is not None and not _same(declared, schema):
            raise ValueError(f"rows for {name} have columns {schema.names}, not {declared.names}")
        folder = f"{name}/written={self._token}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        counted = rows.observe(
            seen, F.count(F.lit(1)).alias("_rows"), *(column.alias(key) for key, column in metrics.items())
        )
        writer = counted.write.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
        writer.parquet(f"{self.tables.root}/{folder}")
        found = dict(seen.get)
        return folder, found.pop("_rows"), found

    def append(
        self,
        name: str,
        rows: DataFrame,
        partition_by: Sequence[str] = (),
        many_values: bool = False,
        metrics: Mapping[str, Column] | None = None,
        kept: Callable[[dict], dict] = lambda found: {},
    ) -> Written:
        """Adds rows to a log; aggregates of them (``metrics``) come from the write itself.

        Tasks write as they come, without a shuffle, into a folder per partition value.  Where one write
        holds ``many_values``, that would be a file per task and value: then rows are rebalanced by value
        first, and Spark splits the value that holds most of them over tasks.  ``kept`` makes of the metrics what the
        commit keeps beside the part.
        """
        out = rows.hint("rebalance", *partition_by) if many_values else rows
        folder, count, found = self._write(name, out, partition_by, metrics or {}, rows.schema)
        part = {
            "folder": folder, "rows": count, "schema": rows.schema.json(), "commit": self.base.number + 1, "kept": kept(found)
        }
        with self._lock:
            self._added.setdefault(name, []).append(part)
        if not count:
            return Written(schemas.empty(self.spark, rows.schema), 0, found)
        return Written(self.spark.read.schema(rows.schema).parquet(f"{self.tables.root}/{folder}"), count, found)

    def replace(self, name: str, rows: DataFrame, only: Collection[int] | None = None) -> Written:
        """Replaces a state, or some of its buckets, which must hold all the rows given."""
        return self._replace(name, rows, only, None)

    def replace_open(self, name: str, log: str, rows: DataFrame, flag: str, only: Collection[int] | None = None) -> None:
        """As ``replace`` for the rows with the flag, and ``append`` to a log for those without, in one write."""
        self._replace(name, rows, only, (log, flag))

    def clear(self, name: str) -> None:
        """A state without rows; writes nothing."""
        before = self._state(name)
        if before and before["parts"]:
            with self._lock:
                self._states[name] = before | {"parts": []}

    def _replace(self, name: str, rows: DataFrame, only: Collection[int] | None, split: tuple[str, str] | None) -> Written:
        schema = rows.schema
        if only is not None and not only:
            return Written(schemas.empty(self.spark, schema), 0, {})
        key, buckets = self.tables.keys[name], 1 if name in schemas.SMALL_STATES else self.tables.buckets
        before = self._state(name)
        if before and before["buckets"] != buckets:
            if only is not None:
                raise ValueError(f"{name} lies in {before['buckets']} buckets, not {buckets}")
            before = None
        bucketed = rows.withColumn(_BUCKET, bucket_of(key, buckets)).hint("rebalance", _BUCKET)
        flags = ["open"] if split else []
        if split:
            bucketed = bucketed.withColumn("open", F.col(split[1]))
        metrics = {"_open": F.count_if(F.col(split[1]))} if split else {}
        folder, count, found = self._write(name, bucketed, [*flags, _BUCKET], metrics, schema)
        opened = f"{folder}/open=true" if split else folder
        text = schema.json()
        part = {"folder": opened, "rows": found.get("_open", count), "schema": text}
        part["buckets"] = part["written"] = self._buckets_in(opened)
        if only is not None and not set(part["buckets"]) <= set(only):
            raise ValueError(f"rows for {name} lie in buckets {part['buckets']}, beyond {sorted(only)}")
        gone = range(buckets) if only is None else set(only)
        older = [p | {"buckets": [b for b in p["buckets"] if b not in gone]} for p in (before["parts"] if before else [])]
        with self._lock:
            self._states[name] = {"buckets": buckets, "parts": [*(p for p in older if p["buckets"]), part]}
            if split:
                closed = {
                    "folder": f"{folder}/open=false", "rows": count - part["rows"], "schema": text,
                    "commit": self.base.number + 1, "kept": {},
                }
                self._added.setdefault(split[0], []).append(closed)
        return Written(self._read_buckets(name, [part], None), count, found)

    def scratch(self, name: str, rows: DataFrame) -> DataFrame:
        """The rows, stored for the steps to come, in a folder that no commit names."""
        folder = work_folder(self.spark, name.replace("/", "-"))
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def _buckets_in(self, folder: str) -> list[int]:
        commits = self.tables.commits
        inner = f"{commits.folder.rpartition('/')[0]}/{folder}"
        listed = commits.files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        return sorted(int(i.base_name.partition("=")[2]) for i in listed if i.base_name.startswith(f"{_BUCKET}="))

    # Committing.

    def commit(self, writer: str, number: int) -> Commit:
        """The tables after this work, as the commit that follows its base."""
        after = deepcopy(self.base)
        after.number, after.owner = self.base.number + 1, f"{writer} {number}"
        after.states |= self._states
        if after.since == self.base.number and after.since:
            after.logs = {}  # they are listed there
        for name, parts in self._added.items():
            for part in parts:
                part["commit"] = after.number
            after.logs.setdefault(name, []).extend(parts)
        if writer:
            after.writers[writer] = number
        after.writers |= dict.fromkeys(self._done, after.number)
        return after

    def rebase(self, latest: Commit) -> bool:
        """Goes on from another commit, if the states read and written here have not changed up to it."""
        names = self._read | set(self._states)
        if any(latest.states.get(name) != self.base.states.get(name) for name in names):
            return False
        self.base = latest
        return True
