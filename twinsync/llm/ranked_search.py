"""Ranked lexical search: term at a time, with a limit on accumulators.

1. **Postings.**  Tasks count the terms of whole texts and keep those that a filter of the queries' terms lets pass (a fixed
   2 MB of bits; what it lets pass wrongly is dropped by a join).  One row per document: its length, terms and counts.
2. **Statistics.**  Document and term totals, and in how many documents each term stands, are Spark sums over all rows.
3. **Search.**  A task takes its documents in blocks and, for each query, the terms from the rarest to the most common.
   The bound of a term is its weight times the greatest impact in the block.  While the bounds of the terms to come add up
   to the k-th best partial score, new documents get accumulators.  After that none can come in: documents that can
   still reach the k-th score survive, and the remaining terms are added to the survivors alone, exactly.  The k-th
   score of earlier blocks is carried on.
4. **Merge.**  Each task gives k documents a query at most; Spark keeps the best k of all.

Queries go in groups of a bounded number of terms, one stored pass over the postings each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinsync.llm.common import stored

TOP = 10
FILTER_BITS = 24
CACHE_TERMS = 500_000
GROUP_TERMS = 1 << 20  # terms of the queries that are sent to the tasks at once
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 16, 1 << 21
# Fixed values of the score.
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 8, 90
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
_NO_ID = np.iinfo(np.int64).max


def _counted(text: bytes) -> Counter[bytes]:
    return Counter(_TERM.findall(text.lower()))  # bytes fold A-Z only


def query_terms(queries: DataFrame) -> DataFrame:
    """A row per different term of each row of ``queries`` (item_id, text): item (the row's number), item_id, term."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [list(_counted(text.as_py())) for text in batch.column("text")]
            flat = pa.array(terms, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), flat], ["item", "item_id", "terms"])

    texts = queries.where(F.col("text").isNotNull()).select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("binary").alias("text")
    )
    id_type = queries.schema["item_id"].dataType.simpleString()
    rows = texts.mapInArrow(split, f"item bigint, item_id {id_type}, terms array<string>")
    return stored(rows.select("item", "item_id", F.explode("terms").alias("term")), "query-terms")


def _filter_of(vocabulary: DataFrame) -> np.ndarray:
    """Bits by CRC-32 of the terms; at most 2^21 bytes come to the driver."""
    bit = F.crc32(F.col("term").cast("binary")) % F.lit(1 << FILTER_BITS)
    marks = vocabulary.select((bit / 8).cast("int").alias("byte"), F.pow(F.lit(2), bit % 8).cast("int").alias("mark"))
    bytes_ = marks.groupBy("byte").agg(F.bit_or("mark").alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    bits[bytes_["byte"].to_numpy()] = bytes_["mask"].to_numpy()
    return bits


class _Passing(dict):
    """Whether the filter lets a term pass; remembers a bounded number of terms."""

    def __init__(self, bits: np.ndarray) -> None:
        super().__init__()
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        if len(self) >= CACHE_TERMS:
            self.clear()
        bit = crc32(term) & ((1 << FILTER_BITS) - 1)
        value = self[term] = bool(self.bits[bit >> 3] >> (bit & 7) & 1)
        return value


def _postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """A row per row of ``docs`` that has terms: doc_id, n, and terms with counts, as far as queries hold them."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = _Passing(bits.value)
        for batch in batches:
            lengths, terms, counts = [], [], []
            for text in batch.column("text"):
                counted = _counted(text.as_py())
                kept = [term for term in counted if passing[term]]
                lengths.append(counted.total())
                terms.append(kept)
                counts.append([counted[term] for term in kept])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.string())),
                 pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "counts"],
            )

    texts = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    counted = texts.mapInArrow(count, "doc_id bigint, n bigint, terms array<string>, counts array<bigint>")
    return stored(counted.where("n > 0"), "postings")


class _Query(NamedTuple):
    item: int
    terms: np.ndarray  # numbers in the group's vocabulary, the rarest first
    weights: np.ndarray


class _Group(NamedTuple):
    """Some queries, and the numbers of their terms."""

    vocabulary: pa.Array
    queries: list[_Query]


def _group(rows: pa.Table) -> _Group:
    """Queries from rows (item, term, df, w), sorted by item and df."""
    terms = rows["term"].combine_chunks().dictionary_encode()
    items, weights = rows["item"].to_numpy(), rows["w"].to_numpy()
    starts = np.flatnonzero(np.diff(items, prepend=-1))
    numbers = terms.indices.to_numpy()
    queries = [
        _Query(int(items[a]), numbers[a:b], weights[a:b]) for a, b in zip(starts, [*starts[1:], len(items)])
    ]
    return _Group(terms.dictionary, queries)


class _Block(NamedTuple):
    """Some documents' postings, by term."""

    ids: np.ndarray
    starts: np.ndarray  # of each term's postings
    docs: np.ndarray
    impacts: np.ndarray
    greatest: np.ndarray  # impact of each term


def _block(batch: pa.Table, vocabulary: pa.Array, total: int, all_terms: int) -> _Block:
    n = batch["n"].to_numpy()
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * total) // all_terms
    terms, counts = batch["terms"].combine_chunks(), batch["counts"].combine_chunks()
    number = pc.index_in(terms.flatten(), value_set=vocabulary).fill_null(-1).to_numpy()
    doc = np.repeat(np.arange(len(n)), np.diff(terms.offsets.to_numpy()))
    known = number >= 0
    number, doc, tf = number[known], doc[known], counts.flatten().to_numpy()[known]
    order = np.argsort(number, kind="stable")
    doc, tf = doc[order], tf[order]
    impacts = (SCALE * tf) // (1000 * tf + SATURATION * m[doc])
    starts = np.searchsorted(number[order], np.arange(len(vocabulary) + 1))
    greatest = np.zeros(len(vocabulary), dtype=np.int64)
    held = np.flatnonzero(np.diff(starts))
    if len(held):
        greatest[held] = np.maximum.reduceat(impacts, starts[held])
    ids = batch["doc_id"].fill_null(_NO_ID).to_numpy()
    return _Block(ids, starts, doc, impacts, greatest)


def _kth(scores: np.ndarray, top: int, floor: int) -> int:
    """The k-th greatest score, or the floor if that is greater or there are fewer."""
    return floor if len(scores) < top else max(floor, int(np.partition(scores, -top)[-top]))


def search_block(query: _Query, block: _Block, top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores and places of the block's documents that may be among the best; all with the best k among them.

    ``floor`` is a k-th score known from elsewhere: documents below it are left out.
    """
    bounds = query.weights * block.greatest[query.terms]
    to_come = np.append(np.cumsum(bounds[::-1])[::-1], 0)
    partial = np.zeros(len(block.ids), dtype=np.int64)
    kth, step = floor, 0
    while step < len(query.terms) and to_come[step] >= max(kth, 1):
        term = query.terms[step]
        at = slice(block.starts[term], block.starts[term + 1])
        partial[block.docs[at]] += query.weights[step] * block.impacts[at]
        step += 1
        if kth < to_come[step]:  # else the loop ends whatever the k-th score is
            kth = _kth(partial[partial > 0], top, floor)
    alive = np.flatnonzero((partial > 0) & (partial + to_come[step] >= kth))
    scores = partial[alive]
    for place in range(step, len(query.terms)):
        term = query.terms[place]
        docs = block.docs[block.starts[term]:block.starts[term + 1]]
        if not len(alive) or not len(docs):
            continue
        spot = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
        found = docs[spot] == alive
        scores[found] += query.weights[place] * block.impacts[block.starts[term] + spot[found]]
        kth = _kth(scores, top, floor)
        live = scores + to_come[place + 1] >= kth
        alive, scores = alive[live], scores[live]
    return scores, alive


def _best(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by score, then by id."""
    order = np.lexsort((ids, -scores))[:top]
    return scores[order], ids[order]


def _search(postings: DataFrame, group: _Group, total: int, all_terms: int, top: int) -> DataFrame:
    """Rows (item, doc_id, score): each task's best documents for each query."""
    sent = postings.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, queries = sent.value
        none = np.zeros(0, dtype=np.int64)
        best = {query.item: (none, none) for query in queries}

        def take(waiting: list[pa.RecordBatch]) -> None:
            block = _block(pa.Table.from_batches(waiting), vocabulary, total, all_terms)
            for query in queries:
                scores, ids = best[query.item]
                floor = int(scores[-1]) if len(scores) == top else 0
                more, places = search_block(query, block, top, floor)
                if len(more):
                    best[query.item] = _best(np.append(scores, more), np.append(ids, block.ids[places]), top)

        waiting, docs, held = [], 0, 0
        for batch in batches:
            for start in range(0, len(batch), 4096):
                part = batch.slice(start, 4096)
                waiting.append(part)
                docs += len(part)
                held += len(part.column("terms").flatten())
                if docs >= BLOCK_DOCS or held >= BLOCK_POSTINGS:
                    take(waiting)
                    waiting, docs, held = [], 0, 0
        if waiting:
            take(waiting)
        for item, (scores, ids) in best.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(scores), pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(scores)],
                    ["item", "doc_id", "score"],
                )

    return postings.select("doc_id", "n", "terms", "counts").mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, group_terms: int = GROUP_TERMS) -> DataFrame:
    """The best ``top`` documents of ``docs`` (doc_id, text) for each row of ``queries`` (item_id, text).

    Returns item_id, rank (from 1), doc_id, score, item: the highest score first, equal scores by ascending doc_id (an
    integer; null ids last).  ``item`` numbers the rows of ``queries``, so that rows that repeat keep results apart.

    A term is a maximal run of digits, ASCII letters and characters beyond ASCII, A-Z folded.  A document without terms
    (null, empty) is never found and counts nowhere; a query without terms, or none that a document has, gives no rows.
    Documents that repeat are ranked each.  Other columns are left out.  A group of queries holds ``group_terms`` terms,
    or one query that has more.
    """
    terms = query_terms(queries)
    postings = _postings(docs, terms.select("term").distinct())
    size = postings.agg(F.count(F.lit(1)).alias("total"), F.sum("n").alias("terms")).first()
    total, all_terms = size["total"], size["terms"] or 1
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * total + 2) / (2 * F.col("df") + 1)))
    weighted = terms.join(held.withColumn("w", weight), "term")
    groups = max(1, -(-terms.count() // group_terms))
    weighted = stored(weighted.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups))), "weighted")

    found = None
    for number in range(groups):
        rows = weighted.where(F.col("group") == number).select("item", "term", "df", "w").orderBy("item", "df", "term")
        rows = rows.toArrow()
        if rows.num_rows:
            part = stored(_search(postings, _group(rows), total, all_terms, top), "found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(terms.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score", "item")
