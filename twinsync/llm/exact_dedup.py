"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes.  All different blocks are sorted and named by whole numbers.
Then the names of neighbours are paired, the different pairs sorted and named in turn, and so on, until one name
is left for each text.  Texts of equally many blocks have equal names if and only if they are equal, so a text's
identity is (number of blocks, name): no hash decides.

Names travel back to the documents by a 128-bit key of the block, which is checked to be one to one with the blocks of
the table at hand; should two blocks ever share a key, keys are drawn anew with another seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored, whole_text

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    """The text's bytes in blocks of ``size``; the empty text is one empty block."""
    raw = text.cast("binary")
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(text) / F.lit(size)) - 1).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * size + 1, F.lit(size)))


def _key(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), block).alias("k1"), F.xxhash64(block, F.lit(seed + 1)).alias("k2")]


def _named(different: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Whole-number names of different values: each partition is sorted, its place and theirs make the name."""
    return stored(
        different.sortWithinPartitions(*by).select(*keep, F.monotonically_increasing_id().alias("name")), "names"
    )


def _one_to_one(names: DataFrame) -> bool:
    return names.groupBy("k1", "k2").count().where("count > 1").isEmpty()


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, seed: int = 11) -> DataFrame:
    """A row per row of ``docs``: ``row``, doc_id, text_sha256, and its identity (``n_blocks``, ``name``).

    ``row`` numbers the rows.  Null text is the empty text.
    """
    text = whole_text()
    blocks = docs.select(F.explode(_blocks(text, block_bytes)).alias("block")).distinct()
    while True:
        names = _named(blocks.select("block", *_key(F.col("block"), seed)), ["block"], ["k1", "k2"])
        if _one_to_one(names):
            break
        seed += 2

    keys = F.transform(_blocks(text, block_bytes), lambda b: F.struct(*_key(b, seed)))
    units = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        keys.alias("keys"),
    ), "units")

    parts = units.select("row", F.size("keys").alias("n_blocks"), F.posexplode("keys").alias("at", "key"))
    parts = parts.select("row", "n_blocks", "at", F.col("key.k1").alias("k1"), F.col("key.k2").alias("k2"))
    level = parts.join(names, ["k1", "k2"]).select("row", "n_blocks", "at", "name")
    most = units.agg(F.max(F.size("keys"))).first()[0] or 1
    width, done = 1, []
    while width < most:
        # ``width`` blocks lie under each name; texts of no more blocks than that have their identity.
        level = stored(level, "level")
        done.append(level.where(F.col("n_blocks") <= width))
        level = _paired(level.where(F.col("n_blocks") > width))
        width *= 2
    done.append(level)
    named = done[0]
    for rows in done[1:]:
        named = named.unionByName(rows)
    return units.select("row", "doc_id", "text_sha256").join(named.select("row", "n_blocks", "name"), "row")


def _paired(level: DataFrame) -> DataFrame:
    """Names of neighbours become one name; a name without a neighbour is paired with none (-1)."""
    left = F.max(F.when(F.col("at") % 2 == 0, F.col("name")))
    right = F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1).cast("long"))
    pairs = level.groupBy("row", "n_blocks", F.expr("at div 2").cast("int").alias("at")).agg(
        left.alias("left"), right.alias("right")
    )
    pairs = stored(pairs, "pairs")
    names = _named(pairs.select("left", "right").distinct(), ["left", "right"], ["left", "right"])
    return pairs.join(names, ["left", "right"]).select("row", "n_blocks", "at", "name")


def mark_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group; the row with the largest doc_id stays.  Of rows that share that id too, one stays.
    Null text counts as empty; a null id counts as smallest, so it stays only in a group without ids.  Other
    columns are left out.  No rows give no rows.
    """
    named = stored(identities(docs, block_bytes), "identities")
    groups = named.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stored(groups, "groups")  # so that the join deals out both sides, and may split a large group
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rule of ``mark_copies``.

    Ids lead back to the rows, together with the text's SHA-256, so one id may stand at several texts.
    """
    stay = mark_copies(docs, block_bytes).where("kept").select(
        F.col("doc_id").alias("_stay_id"), F.col("text_sha256").alias("_stay_sha")
    )
    # The row travels as one value, so no name of its columns can clash.
    marked = docs.select(
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"),
        F.sha2(whole_text().cast("binary"), 256).alias("sha"),
    )
    same = marked["id"].eqNullSafe(stay["_stay_id"]) & (marked["sha"] == stay["_stay_sha"])
    return marked.join(stay, same, "left_semi").dropDuplicates(["id", "sha"]).select("doc.*")
