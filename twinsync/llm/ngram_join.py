"""Jaccard similarity join of documents by their word shingles, in the metric space of Jaccard distance.

d(x, y) = 1 - |x and y| / |x or y| is a metric.  Two documents link at d <= r.

1. **Voronoi regions.**  Take every shingle {s} as a pivot.  A document of n shingles has its n nearest pivots at one
   distance, 1 - 1/n; an order of all shingles settles the tie.  In each of a few orders a document lies in one region
   and is compared with that region's least document.  Near copies share most of their regions, so this links large
   groups at a cost in proportion to their size.  It need not find all.
2. **Copies at the boundary.**  In one more order, rare shingles first, each document is copied into the regions that
   the distance allows: sets within r share one of the first n - ceil((1 - r) n) + 1 shingles of either, so every linked
   pair meets.  Regions whose documents are all in one component are done.
3. **Windows and recursion.**  In what is left, only documents of different components are paired, and only if their
   sizes and the places of the shared pivot in both orders leave them within r.  A large region first goes on around
   a document c at its center: x -> x ^ c keeps distances between sets, so the members in which documents differ from
   c make regions and windows of the same kind, in which what a group has in common no longer counts.
4. **Distances.**  A parity sketch of the set keeps or shortens distances; pairs it leaves are counted exactly.

Equal sets are one node throughout.  Orders and pivots affect the work, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored, whole_text
from twinsync.llm.components import components
from twinsync.llm.shingles import Shingler, common, identity, sketch, sketch_distance

WORDS, PERCENT = 4, 85
COMMON_FROM, COMMON_MOST = 8, 1 << 20
ORDERS, LEAF = 4, 32
FOLDED = 512
# Odd multipliers, one per order of the shingles (fixed values).
_ORDERS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9], dtype=np.uint64)


def _prefix(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def _text_key() -> list[Column]:
    return [F.xxhash64(whole_text()).alias("t1"), F.xxhash64(F.lit(1), whole_text()).alias("t2")]


def _ordered(shingles: np.ndarray, lengths: np.ndarray, frequent: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` shingles in the order of all: not known as frequent, long, by number."""
    late = np.zeros(len(shingles), dtype=np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, shingles)
        at[at == len(frequent)] = 0
        late = (frequent[at] == shingles).astype(np.int64)
    order = np.argsort(late * 1024 - np.minimum(lengths, 1000), kind="stable")
    return shingles[order[:count]]


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _frequent(docs: DataFrame, words: int, percent: int) -> np.ndarray:
    """Shingles that stand first in many documents: the most frequent ones, ``COMMON_MOST`` (8 MB) at most."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, none = Shingler(words), np.zeros(0, dtype=np.uint64)
        for batch in batches:
            found = []
            for text in batch.column("text"):
                shingles, lengths = shingler(text.as_py())
                found.append(_ordered(shingles, lengths, none, 3 * _prefix(len(shingles), percent) // 2))
            yield pa.RecordBatch.from_arrays([_lists(found).flatten()], ["shingle"])

    counts = docs.select("text").mapInArrow(firsts, "shingle bigint").groupBy("shingle").count()
    most = counts.where(F.col("count") >= COMMON_FROM).orderBy(F.desc("count"), "shingle").limit(COMMON_MOST)
    # One table, read back in parts: no more than COMMON_MOST numbers come to the driver.
    return np.sort(stored(most.select("shingle"), "frequent").toArrow()["shingle"].to_numpy().view(np.uint64))


def _nodes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row per row of ``docs`` that has words: doc_id, text key, set's identity, size, sketch and first shingles."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, words, percent))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sizes, ones, twos, sketches, firsts, least = [], [], [], [], [], []
            for text in batch.column("text"):
                shingles, lengths = shingler(text.as_py())
                one, two = identity(shingles)
                sizes.append(len(shingles))
                ones.append(one)
                twos.append(two)
                sketches.append(sketch(shingles) if len(shingles) else b"")
                firsts.append(_ordered(shingles, lengths, frequent.value, _prefix(len(shingles), percent) if len(shingles) else 0))
                least.append((shingles[:, None] * _ORDERS).min(axis=0) if len(shingles) else shingles)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "t1", "t2")]
                + [pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                   pa.array(sketches, pa.binary()), _lists(firsts), _lists(least)],
                ["doc_id", "t1", "t2", "n", "f1", "f2", "sketch", "firsts", "least"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    described = docs.select("doc_id", *_text_key(), "text").mapInArrow(
        describe,
        f"doc_id {id_type}, t1 bigint, t2 bigint, n bigint, f1 bigint, f2 bigint, sketch binary, firsts array<bigint>, least array<bigint>",
    )
    return stored(described.withColumn("row", F.monotonically_increasing_id()), "described")


def _with(pairs: DataFrame, side: str, table: DataFrame, *columns: str) -> DataFrame:
    """Adds a table's columns for one end of the pairs."""
    other = table.select(F.col("id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
    return pairs.join(other, side)


def _near_by_sketch(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), with ``n_a`` and ``n_b``, that their sketches leave within the distance."""
    both = _with(_with(pairs, "a", nodes, "n", "sketch"), "b", nodes, "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = [sketch_distance(x.as_py(), y.as_py()) for x, y in zip(batch.column("sketch_a"), batch.column("sketch_b"))]
            sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            near = pa.array((100 + percent) * np.array(apart, dtype=np.int64) <= (100 - percent) * sizes)
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(near)

    return stored(both.mapInArrow(run, "a bigint, b bigint, n_a bigint, n_b bigint"), "near")


def _with_texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs with the texts of both ends.  Texts travel, not sets: they are smaller."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = stored(nodes.join(ends, "id", "left_semi").select("id", "t1", "t2"), "wanted")
    # Copies of a text meet before they are moved.
    own = docs.select(*_text_key(), "text").groupBy("t1", "t2").agg(F.first("text").alias("text"))
    texts = stored(own.join(wanted, ["t1", "t2"]).select("id", "text"), "texts")
    return _with(_with(pairs, "a", texts, "text"), "b", texts, "text")


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """Each row's batch and place, and the sets of its two texts."""
    shingler, at, right = Shingler(words), None, None
    for batch in batches:
        ends = batch.column("b").to_pylist()
        for i, end in enumerate(ends):
            if end != at:  # rows that share this end mostly stand together
                at, right = end, shingler(batch.column("text_b")[i].as_py())[0]
            yield batch, i, shingler(batch.column("text_a")[i].as_py())[0], right


def _linked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: those that sketches leave are counted on their whole sets."""
    both = _with_texts(docs, nodes, _near_by_sketch(pairs, nodes, percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch, i, left, right in _sets(batches, words):
            shared = common(left.tobytes(), right.tobytes())
            if 100 * shared >= percent * (len(left) + len(right) - shared):
                found.append((batch.column("a")[i].as_py(), batch.column("b")[i].as_py()))
            if len(found) >= 10_000:
                yield _pairs_batch(found)
                found = []
        yield _pairs_batch(found)

    return stored(both.mapInArrow(run, "a bigint, b bigint").distinct(), "linked")


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def _to_pivots(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of each document with the pivots of its nearest regions, one region in each of the orders.

    A region's pivot is its least document.  There are no more pairs than documents and orders, however large a group is.
    """
    marks = F.explode(F.array(*(F.xxhash64(F.lit(k), F.col("least")[k]) for k in range(ORDERS)))).alias("key")
    keyed = stored(nodes.select(F.col("id").alias("a"), marks), "keyed")
    pivots = stored(keyed.groupBy("key").agg(F.min("a").alias("b"), F.max("a").alias("most")).where("b < most"), "pivots")
    return stored(keyed.join(pivots, "key").where("a > b").select("a", "b").distinct(), "pairs")


def _spread(rows: DataFrame, links: DataFrame, percent: int, *space: str) -> DataFrame:
    """The rows of the regions that are not done: key, id, label, n, place, light, and the region's size and center.

    ``rows`` has id, n and ``firsts``, the first members of the set in one order; ``space`` names what else members
    must agree on.  Of two sets within the distance, at most (n_a + n_b)(1 - t)/(1 + t) members are of one side only.  In
    the region of their first shared member all that stands before it is such: so the two places add up to no more, and
    one of the two documents is *light*, its place no more than its own part.  A region without a light document, or with
    documents of one component only, is done.
    """
    labels = components(links).withColumnRenamed("node", "id")
    carried = [c for c in ("folded",) if c in rows.columns]
    rows = rows.join(labels, "id", "left").select(
        *space, *carried, "id", "n", F.coalesce("label", "id").alias("label"), F.posexplode("firsts").alias("place", "member")
    )
    light = (F.col("place") * (100 + percent) <= F.col("n") * (100 - percent)).alias("light")
    rows = rows.select(F.xxhash64(*space, "member").alias("key"), *carried, "id", "n", "label", "place", light)
    regions = rows.groupBy("key").agg(
        F.min("label").alias("least"), F.max("label").alias("most"), F.max("light").alias("any_light"),
        F.count(F.lit(1)).alias("size"), F.min(F.struct("place", "id")).alias("c"),
    )
    regions = stored(regions.where("least <> most and any_light").select("key", "size", F.col("c.id").alias("center")), "regions")
    return stored(rows.join(regions, "key"), "open")


def _crossed(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components in one region whose sizes, places and sketches leave them within the distance."""
    one, two = 100 - percent, 100 + percent
    columns = [c for c in rows.columns if c in ("id", "label", "n", "place", "folded")]
    left = rows.where("light").select("key", *(F.col(c).alias(f"{c}_a") for c in columns))
    right = rows.select("key", "light", *(F.col(c).alias(f"{c}_b") for c in columns))
    window = (F.col("place_a") + F.col("place_b")) * two <= (F.col("n_a") + F.col("n_b")) * one
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    once = ~F.col("light") | (F.col("id_a") < F.col("id_b"))  # two light documents meet twice
    near = (F.col("label_a") != F.col("label_b")) & window & sizes & once
    if "folded" in columns:
        apart = [F.bit_count(F.col("folded_a")[i].bitwiseXOR(F.col("folded_b")[i])) for i in range(FOLDED // 64)]
        near = near & (sum(apart[1:], apart[0]) * two <= (F.col("n_a") + F.col("n_b")) * one)
    met = left.join(right, "key").where(near)
    return met.select(F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b"))


def _from_centers(docs: DataFrame, nodes: DataFrame, cells: DataFrame, words: int, percent: int) -> DataFrame:
    """Cells (a, b) of documents a and centers b, as the documents look from there: center, id, n, linked, firsts.

    The map x -> x ^ c (the members of one side only) keeps the number of members that two sets differ in.  ``firsts``
    are the first members of x ^ c: those outside c, then those of c, by number; as many as one document may be apart
    from another within the distance, and one.  ``folded`` is a parity sketch of x of one small size for all.
    """
    both = _with_texts(docs, nodes, cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, linked, firsts, folded = [], [], [], []
            for _, _, left, right in _sets(iter([batch]), words):
                rest = np.setxor1d(left, right, assume_unique=True)
                total = len(left) + len(right)
                sizes.append(len(left))
                linked.append((100 + percent) * len(rest) <= (100 - percent) * total)
                parity = np.bincount((left & np.uint64(FOLDED - 1)).astype(np.int64), minlength=FOLDED) & 1
                folded.append(np.packbits(parity.astype(np.uint8)).view(np.int64))
                inside = np.isin(rest, right, assume_unique=True)
                most = (100 - percent) * (len(left) + 100 * len(left) // percent) // (100 + percent) + 1
                firsts.append(np.concatenate((rest[~inside], rest[inside]))[:most])
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), batch.column("a"), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()), _lists(firsts), _lists(folded)],
                ["center", "id", "n", "linked", "firsts", "folded"],
            )

    return stored(both.mapInArrow(run, "center bigint, id bigint, n bigint, linked boolean, firsts array<bigint>, folded array<bigint>"), "from-centers")


def _join_regions(docs: DataFrame, nodes: DataFrame, words: int, percent: int, leaf: int) -> DataFrame:
    """Labels (node, label) of all nodes that link to another.

    Large regions go on as cells around their centers.  Two documents of a cell that link, in different components, share
    a member of their sets as seen from the center c: else they differ in |x ^ c| + |y ^ c| members, so one of them, say
    x, is within n_x (1 - t)/(1 + t) of c and linked to it; then y is not, and |x ^ c| < n_x - n_c, which no set is.
    """
    links = _linked(docs, nodes, _to_pivots(nodes), words, percent)
    rows = _spread(nodes, links, percent)
    met = stored(_crossed(rows.where(F.col("size") <= leaf), percent).distinct(), "pairs")
    cells = rows.where((F.col("size") > leaf) & (F.col("id") != F.col("center"))).select(
        F.col("id").alias("a"), F.col("center").alias("b")
    )
    seen = _from_centers(docs, nodes, stored(cells.distinct(), "cells"), words, percent)
    links = stored(links.union(seen.where("linked").select("id", "center")), "links")
    rows = _spread(seen, links, percent, "center")
    stars = rows.where(F.col("id") != F.col("center")).select(F.greatest("id", "center").alias("a"), F.least("id", "center").alias("b"))
    links = stored(links.union(_linked(docs, nodes, stored(stars.distinct(), "pairs"), words, percent)), "links")
    rows = _spread(seen, links, percent, "center")
    pairs = stored(met.union(_crossed(rows, percent)).distinct(), "pairs")
    return components(stored(links.union(_linked(docs, nodes, pairs, words, percent)), "links"))


def _grouped(docs: DataFrame, words: int, percent: int, leaf: int) -> DataFrame:
    """A row per row of ``docs``: doc_id, t1, t2, n, and ``label``, null for rows without words."""
    rows = _nodes(docs, words, percent)
    full = rows.where("n > 0")
    nodes = stored(full.groupBy("f1", "f2").agg(
        F.min("row").alias("id"), F.min(F.struct("t1", "t2")).alias("one"),
        *(F.first(c).alias(c) for c in ("n", "sketch", "firsts", "least")),
    ).select("f1", "f2", "id", "one.*", "n", "sketch", "firsts", "least"), "nodes")
    labels = _join_regions(docs, nodes, words, percent, leaf).withColumnRenamed("node", "id")
    named = nodes.select("f1", "f2", "id").join(labels, "id", "left").select(
        "f1", "f2", F.coalesce("label", "id").alias("label")
    )
    named = stored(named, "named")
    joined = full.select("doc_id", "t1", "t2", "n", "f1", "f2").join(named, ["f1", "f2"])
    none = rows.where("n = 0").select("doc_id", "t1", "t2", "n", F.lit(None).cast("bigint").alias("label"))
    return stored(joined.select("doc_id", "t1", "t2", "n", "label").unionByName(none), "grouped")


def mark_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two rows link when 100 * shared >= percent * all of their different shingles; component_id is the least doc_id that
    links lead to.  A text with fewer than ``words`` words is one shingle.  Rows without words, or with null text, have
    none and link with nothing: their component_id is their own.  Rows that repeat are linked.  Null ids count as
    no id: the component is named by the least other, and is null if there is none.  Other columns are left out.
    No rows give no rows.
    """
    rows = _grouped(docs, words, percent, leaf)
    least = stored(rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least")), "least")
    return rows.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one of each group: that with the least id (null ids last).

    Rows without words all stay.
    """
    rows = _grouped(docs, words, percent, leaf).where("label is not null")
    stay = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "t1", "t2")).alias("stay"))
    stay = stored(stay.select(*(F.col(f"stay.{c}").alias(f"_stay_{c}") for c in ("doc_id", "t1", "t2"))), "stay")
    t1, t2 = _text_key()
    wordless = ~whole_text().rlike(r"[^\x20\x09-\x0D]")
    # The row travels as one value, so no name of its columns can clash.
    keyed = docs.where(~wordless).select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), t1, t2)
    same = (
        keyed["id"].eqNullSafe(stay["_stay_doc_id"]) & (keyed["t1"] == stay["_stay_t1"]) & (keyed["t2"] == stay["_stay_t2"])
    )
    left = keyed.join(stay, same, "left_semi").dropDuplicates(["id", "t1", "t2"])
    return left.select("doc.*").union(docs.where(wordless).select(*docs.columns))
