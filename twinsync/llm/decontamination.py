"""Benchmark decontamination by suffix arrays of the documents.

Each task cuts its documents into shards of some million words and sorts the shard's suffixes.  Every benchmark window
(``window`` consecutive words of an item, from every position) is looked up by binary search in every shard.  The
stretch of the suffix array it finds gives all verbatim occurrences; occurrences on one diagonal join to the longest
matches.  No key is shuffled, so no passage is too frequent.

The benchmark is the stated query set.  It is sent to the tasks in blocks of bounded size; each block passes over
the documents within the same tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 13
BLOCK_BYTES = 16 << 20
SHARD_WORDS = 1 << 20
CELLS_AT_ONCE = 1 << 21
HITS, ITEMS, MATCHES, WORDS = "_llm_hits", "_llm_items", "_llm_matches", "_llm_words"

# Word bytes: digits, lower-case letters, and every byte of a character beyond ASCII; A-Z become a-z, others split.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_ADDED = {
    WORDS: T.LongType(),
    HITS: T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])),
    ITEMS: T.ArrayType(T.StringType()),
    MATCHES: T.ArrayType(T.StructType([
        T.StructField("item_id", T.StringType()), T.StructField("doc_start", T.LongType()),
        T.StructField("item_start", T.LongType()), T.StructField("length", T.LongType()),
    ])),
}
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_MATCH = pa.list_(pa.struct([
    ("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())
]))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


@dataclass
class Windows:
    """The different windows of one width, and where in which items each stands (rows of ``places``, by window)."""

    width: int
    rows: np.ndarray
    first: np.ndarray
    places: np.ndarray


@dataclass
class Block:
    """A block of the benchmark: its words' numbers, item names and windows."""

    numbers: dict[bytes, int]
    names: list[str]
    windows: list[Windows]
    shortest: int


def make_block(items: Iterable[tuple[object, str | None]], window: int) -> Block:
    numbers: dict[bytes, int] = {}
    names: list[str] = []
    by_width: dict[int, list[tuple[tuple[int, ...], int, int]]] = {}
    for name, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in words(text)]
        if not ids:
            continue
        width = min(window, len(ids))
        names.append("null" if name is None else str(name))
        found = by_width.setdefault(width, [])
        found.extend((tuple(ids[i:i + width]), len(names) - 1, i) for i in range(len(ids) - width + 1))
    tables = []
    for width, found in sorted(by_width.items()):
        found.sort()
        rows = np.array([f[0] for f in found], dtype=np.int64)
        new = np.ones(len(found), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        first = np.append(np.flatnonzero(new), len(found))
        tables.append(Windows(width, rows[new], first, np.array([f[1:] for f in found], dtype=np.int64)))
    return Block(numbers, names, tables, min(by_width, default=0))


def blocks_of(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Block]:
    """The benchmark (item_id, text) in blocks of about ``block_bytes``; one block is on the driver at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"] or "")
        if size >= block_bytes:
            yield make_block(held, window)
            held, size = [], 0
    if held:
        yield make_block(held, window)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes whose first word is not 0, sorted by ``depth`` words at least (prefix doubling)."""
    rank = np.asarray(ids, dtype=np.int64)
    span = 1
    while span < depth:
        after = np.zeros_like(rank)
        after[:-span] = rank[span:]
        rank = np.unique(rank * (after.max(initial=0) + 1) + after, return_inverse=True)[1].astype(np.int64)
        # Suffixes that begin with a 0 stay at rank 0, so that no match runs over a gap.
        rank = np.where(ids == 0, 0, rank + 1)
        span *= 2
    order = np.argsort(rank, kind="stable")
    return order[np.count_nonzero(ids == 0):]


def search(ids: np.ndarray, order: np.ndarray, rows: np.ndarray, after: bool) -> np.ndarray:
    """For each row of words, how many suffixes come before it (or, with ``after``, are equal to it as well)."""
    width = rows.shape[1]
    padded = np.append(ids, np.zeros(width, dtype=ids.dtype))
    low = np.zeros(len(rows), dtype=np.int64)
    high = np.full(len(rows), len(order), dtype=np.int64)
    each = np.arange(len(rows))
    while (open_ := low < high).any():
        middle = np.where(open_, (low + high) // 2, 0)
        there = padded[order[middle][:, None] + np.arange(width)]
        at = (there != rows).argmax(axis=1)
        left, right = there[each, at], rows[each, at]
        before = (left < right) | (after & (left == right))
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them), one after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches without a 0 begin and end, of those long enough to hold a window."""
    edges = np.diff(np.concatenate(([0], (ids != 0).astype(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - begin >= shortest
    return begin[long], end[long]


def _stretches(place: np.ndarray, window: np.ndarray, table: Windows, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest matches as rows of (item, place less place in the item, first place), and the place of the last window.

    ``place`` and ``window`` are the windows found in a shard of ``words`` words.  A match begins where the windows before,
    on both sides, are not the same one, and ends where those behind are not.  Of the cells of occurrence and place in
    an item, which may be many in repetitive text, a bounded number is laid out at a time, and only these ends are kept.
    """
    there = np.full(words + 2, -1, dtype=np.int64)
    there[place + 1] = window
    item, at = table.places.T
    span = np.zeros(int(item.max()) + 1, dtype=np.int64)
    np.maximum.at(span, item, at + 2)
    base = np.cumsum(span) - span + 1
    own = np.full(int(span.sum()) + 2, -2, dtype=np.int64)
    copies = np.diff(table.first)
    own[base[item] + at] = np.repeat(np.arange(len(copies)), copies)

    cells = copies[window]
    upto = np.cumsum(cells)
    cuts = np.unique(np.append(np.searchsorted(upto, np.arange(CELLS_AT_ONCE, int(upto[-1]), CELLS_AT_ONCE)), [0, len(cells)]))
    begins, ends = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        row = _spread(table.first[:-1][window[a:b]], cells[a:b])
        here = np.repeat(place[a:b], cells[a:b])
        flat = base[item[row]] + at[row]
        for out, step in ((begins, -1), (ends, 1)):
            edge = there[here + 1 + step] != own[flat + step]
            out.append(np.stack([item[row[edge]], here[edge] - at[row[edge]], here[edge]], axis=1))
    first, last = (x[np.lexsort(x.T[::-1])] for x in (np.concatenate(begins), np.concatenate(ends)))
    return first, last[:, 2]


def scan_shard(texts: list[list[bytes]], block: Block) -> tuple[list, list, list]:
    """For each document of a shard: hit stretches, names of the items found, and longest matches."""
    hits: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    matches: list[list[tuple]] = [[] for _ in texts]
    if not block.windows:
        return hits, items, matches
    number = block.numbers.get
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.zeros(int(sizes.sum()), dtype=np.int64)
    for start, text in zip(starts, texts):
        ids[start:start + len(text)] = [number(w, 0) for w in text]
    begin, end = _runs(ids, block.shortest)
    if not len(begin):
        return hits, items, matches
    # Only stretches of benchmark words can match; they stand one after another, with a gap between.
    origin = _spread(begin, end - begin + 1)
    short = ids[origin]
    order = suffix_array(short, max(w.width for w in block.windows))
    mark = np.zeros(len(ids) + 1, dtype=np.int64)
    found = []
    for table in block.windows:
        low = search(short, order, table.rows, False)
        count = search(short, order, table.rows, True) - low
        if not count.any():
            continue
        window = np.repeat(np.arange(len(low)), count)
        place = origin[order[_spread(low, count)]]
        np.add.at(mark, place, 1)
        np.add.at(mark, place + table.width, -1)
        first, last = _stretches(place, window, table, len(ids))
        found.append(np.column_stack([
            np.searchsorted(starts, first[:, 2], side="right") - 1, first, last - first[:, 2] + table.width
        ]))
    if not found:
        return hits, items, matches
    inside = np.cumsum(mark[:-1]) > 0
    edges = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
        doc = int(np.searchsorted(starts, a, side="right")) - 1
        hits[doc].append((int(a - starts[doc]), int(b - starts[doc])))
    table = np.concatenate(found)
    table = table[np.lexsort(table.T[[3, 2, 1, 0]])]
    for doc, item, diagonal, place, length in table.tolist():
        name = block.names[item]
        matches[doc].append((name, place - int(starts[doc]), place - diagonal, length))
        if name not in items[doc]:
            items[doc].append(name)
    return hits, items, matches


def _pass(block, shard_words: int, names: list[str], first: bool):
    """The task function for one block; ``names`` are the columns to keep besides those it adds to."""

    def lists(batch: pa.RecordBatch, name: str) -> list[list]:
        return [[] for _ in range(batch.num_rows)] if first else batch.column(name).to_pylist()

    def flush(batch: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
        hits, items, matches = scan_shard(texts, block.value)
        hits = [o + [{"start": a, "stop": b} for a, b in n] for o, n in zip(lists(batch, HITS), hits)]
        items = [o + [x for x in n if x not in o] for o, n in zip(lists(batch, ITEMS), items)]
        keys = ("item_id", "doc_start", "item_start", "length")
        matches = [o + [dict(zip(keys, m)) for m in n] for o, n in zip(lists(batch, MATCHES), matches)]
        added = [
            pa.array([len(t) for t in texts], pa.int64()), pa.array(hits, _SPAN),
            pa.array(items, pa.list_(pa.string())), pa.array(matches, _MATCH),
        ]
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + added, [*names, *_ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, texts, size = 0, [], 0
            for i, text in enumerate(batch.column("text")):
                texts.append(words(text.as_py()))
                size += len(texts[-1])
                if size >= shard_words:
                    yield flush(batch.slice(begin, i + 1 - begin), texts)
                    begin, texts, size = i + 1, [], 0
            if texts:
                yield flush(batch.slice(begin), texts)

    return run


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with what the benchmark's windows hit in each text, added under names that begin with ``_llm_``."""
    spark: SparkSession = docs.sparkSession
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in _ADDED.items())])
    found = docs
    for i, block in enumerate(blocks_of(benchmark, window, block_bytes)):
        found = found.mapInArrow(_pass(spark.sparkContext.broadcast(block), shard_words, names, i == 0), schema)
    if found is docs:
        found = docs.mapInArrow(_pass(spark.sparkContext.broadcast(make_block([], window)), shard_words, names, True), schema)
    return found


def _hit_words() -> Column:
    """How many words lie in at least one hit stretch."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(so_far: Column, hit: Column) -> Column:
        stop = F.greatest(so_far["upto"], hit["stop"])
        return F.struct(
            (so_far["n"] + stop - F.greatest(so_far["upto"], F.least(hit["start"], stop))).alias("n"), stop.alias("upto")
        )

    return F.aggregate(F.array_sort(HITS), start, add, lambda x: x["n"])


def _contaminated(hit: Column, share: int) -> Column:
    return (hit > 0) & (F.lit(share) * hit >= F.col(WORDS))


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches.

    A word is hit inside any occurrence of a window; a document is contaminated when at least one in ``share`` of
    its words is hit.  ``matches`` has the longest verbatim stretches: item, places in words, and length.

    Null and empty texts have no words and are clean.  Items without words find nothing; an item whose id is null goes
    by the name ``null``; items that repeat an id count once.  Repeated rows give a row each.  Other columns are left
    out.  An empty benchmark finds nothing; no documents give no rows.
    """
    found = scan(docs.select("doc_id", "text"), benchmark, **options)
    return found.select(
        "doc_id", F.col(WORDS).alias("n_words"), _hit_words().alias("n_hit"),
        F.size(ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ITEMS), ",").cast("binary"), 256).alias("items_sha256"),
        F.col(MATCHES).alias("matches"), F.col(WORDS), F.col(HITS),
    ).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", _contaminated(F.col("n_hit"), share).alias("contaminated"),
        "matches",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, by the rule of ``mark_contaminated``."""
    found = scan(docs, benchmark, **options)
    return found.where(~_contaminated(_hit_words(), share)).select(*docs.columns)
