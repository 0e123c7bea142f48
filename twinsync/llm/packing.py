"""Best-fit decreasing packing of whole documents into sequences of bounded length.

Only documents longer than a sequence are cut.  Pieces are packed longest first, each into the open sequence with the
least room that still holds it, found in a segment tree over the room that is left.

Best fit looks at lengths alone, and there are at most ``capacity`` different ones.  So the tree works on the counts of
pieces by length: it gives stretches of equal decisions ("pieces 120 to 980 of length 300 go to sequences 4000 and
on, at 700"), and the pieces, numbered within their length, look their place up.  The result is that of best-fit
decreasing over all pieces one by one; the plan's size depends on the capacity, not on the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsync.llm.common import stored
from twinsync.llm.tokens import Ids

CAPACITY = 1024
END_ID = 2
BUCKET_PIECES = 1000

_PIECE = pa.schema([
    ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """A row per piece of every row of ``docs`` (doc_id, text): a text's ids and then the end id.

    A longer document is cut into pieces of ``capacity`` ids; what is left over is the first piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            owner, rows = [], []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                stop = total % capacity or min(capacity, total)
                start = piece = 0
                while start < total:
                    rows.append((piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
                    owner.append(i)
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owner, pa.int64()))]
                + [pa.array(c, f.type) for c, f in zip(columns, _PIECE)],
                ["doc_id", *_PIECE.names],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


class Rooms:
    """Segment tree over the room left in open sequences, 0 to ``capacity``: how many have exactly that much."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += change
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length``."""
        at = length + self.leaves
        while not self.count[at]:
            while at & 1:  # a right child: what is larger lies right of its parent
                at //= 2
            if not at:
                return None
            at += 1
        while at < self.leaves:
            at *= 2
            at += not self.count[at]
        return at - self.leaves


def best_fit_plan(counts: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """Where pieces go, by length: rows (first piece, first sequence, pieces in each, offset), in order of pieces."""
    tree, open_, plan, opened = Rooms(capacity), {}, {}, 0

    def keep(room: int, first: int, number: int) -> None:
        if room and number:
            open_.setdefault(room, []).append((first, number))
            tree.add(room, number)

    for length in sorted(counts, reverse=True):
        done, rows = 0, []
        while done < counts[length]:
            left = counts[length] - done
            room = tree.tightest(length)
            if room is None:
                room = capacity
                each = room // length
                first, number = opened, -(-left // each)
                opened += number
            else:
                each = room // length
                first, number = open_[room].pop()
                tree.add(room, -number)
            # A sequence takes pieces of this length until none fits: it stays the tightest.
            full = min(number, left // each)
            if not full:
                rows.append((done, first, each, capacity - room))
                keep(room - left * length, first, 1)
                keep(room, first + 1, number - 1)
                done += left
                continue
            rows.append((done, first, each, capacity - room))
            done += full * each
            keep(room - each * length, first, full)
            keep(room, first + full, number - full)
        plan[length] = np.array(rows, dtype=np.int64)
    return plan


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, bucket_pieces: int = BUCKET_PIECES
) -> DataFrame:
    """For each piece of every row of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is a tokenizer file that every worker can read at that path.  Pieces of a sequence stand one after
    another from 0.  Null and empty texts are one piece, the end id alone.  Repeated rows, and rows with null ids, are
    documents of their own.  Other columns are left out.  No rows give no rows.

    Numbering the pieces of a length is dealt out over buckets of about ``bucket_pieces``, so a length that a third
    of all pieces have is no single task.  One row per length reaches the driver.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = F.lit([counts.get(n, 0) // bucket_pieces + 1 for n in range(capacity + 1)])
    plan = pieces.sparkSession.sparkContext.broadcast(best_fit_plan(counts, capacity))

    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), F.get(buckets, F.col("length").cast("int"))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "bucket").count().select(
        "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("length", "bucket").orderBy("row")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for value in np.unique(length):
                mine = np.flatnonzero(length == value)
                rows = plan.value[value]
                row = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                turn = rank[mine] - row[:, 0]
                sequence[mine] = row[:, 1] + turn // row[:, 2]
                offset[mine] = row[:, 3] + turn % row[:, 2] * value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:5])
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
