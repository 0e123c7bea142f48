"""Sharding by sampled splitters, under the law ``bytes``: shards of nearly equal size.

Every document has a place in one order: by a hash of its text, then by a hash of its id.  Equal texts are
neighbours in it.  A shard is a stretch of that order.  To find each document's place without sorting all of
them in one task:

1. draw a sample of keys, weighted by size, and take its quantiles as splitters of ranges;
2. measure the ranges exactly, and subdivide those that turn out overfull;
3. sum the sizes within each range and add what lies before the range.

The sample decides only how evenly the work is dealt out: the places, and so the shards, are exact and the same
for every sample.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinsync.llm.common import stored, whole_text

LAW = "bytes"
SCHEMA = "doc_id {id}, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int"


def _hash60(text: Column) -> Column:
    """The first 60 bits of a text's SHA-256, as a whole number."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _sample(units: DataFrame, size: int, total: int, rows: int, seed: int) -> list[tuple[int, int]]:
    """At most ``size`` keys without replacement, a unit's chance growing with its bytes and its rows."""
    uniform = (F.shiftrightunsigned(F.xxhash64("key", "tie", F.lit(seed)), 11) + 1) / F.lit(float(1 << 53))
    weight = F.col("copies") * (F.col("size") / F.lit(float(total)) + F.lit(1.0 / rows))
    drawn = units.select("key", "tie", (-F.log(uniform) / weight).alias("turn")).orderBy("turn", "key", "tie").limit(size)
    return sorted((r["key"], r["tie"]) for r in drawn.collect())


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """How many splitters are at or below a row's (key, tie): a binary search in constant arrays."""
    steps = []
    step = 1
    while sum(steps) < len(splitters):
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.lit(0)
    keys, ties = (F.lit([s[i] for s in splitters]) for i in (0, 1))

    def probe(found: Column, step: Column) -> Column:
        at = found + step - 1
        key, tie = F.get(keys, at), F.get(ties, at)
        reached = (F.col("key") > key) | ((F.col("key") == key) & (F.col("tie") >= tie))
        return F.when(reached, found + step).otherwise(found)

    return F.aggregate(F.lit(steps), F.lit(0), probe)


def _subdivided(ranged: DataFrame, spread: float) -> DataFrame:
    """Adds ``sub``: rows of a range with over ``spread`` times its share are cut into narrower ranges.

    The cuts are even steps of the key, or of the tie where the range holds one key, so the order stays.
    """
    measured = ranged.groupBy("range").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"),
        F.sum("copies").alias("rows"),
        *(f(c).alias(f"{c}_{n}") for c in ("key", "tie") for n, f in (("least", F.min), ("most", F.max))),
    )
    everything = Window.partitionBy()
    load = F.greatest(
        F.col("bytes") * F.count(F.lit(1)).over(everything) / F.sum("bytes").over(everything),
        F.col("rows") * F.count(F.lit(1)).over(everything) / F.sum("rows").over(everything),
    )
    cuts = measured.withColumn("parts", F.greatest(F.lit(1), F.ceil(load / F.lit(spread))).cast("int"))
    joined = ranged.join(F.broadcast(cuts.drop("bytes", "rows")), "range")

    def share(c: str) -> Column:
        return (F.col(c) - F.col(f"{c}_least")) / (F.col(f"{c}_most") - F.col(f"{c}_least") + 1)

    where = F.when(F.col("key_least") < F.col("key_most"), share("key")).otherwise(share("tie"))
    sub = F.least(F.col("parts") - 1, F.floor(where * F.col("parts"))).cast("int")
    return joined.select(*ranged.columns, sub.alias("sub"))


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 16,
    ranges: int = 256,
    samples: int = 4096,
    spread: float = 2.0,
    group_share: float = 0.01,
    seed: int = 7,
) -> DataFrame:
    """A shard and a gapless slot for every row of ``docs`` (doc_id, text).

    The size of a row is its text's UTF-8 bytes plus 1.  Copies of one text share a shard as long as they make up
    at most ``group_share`` of a shard; larger groups are cut where a shard is full.  So no shard differs from the
    mean by more than that share or one document.

    Null text has size 1 and the checksum of the empty text, and stands with the empty texts.  Null ids come before
    others.  Rows that repeat get a slot each.  Other columns are left out.  No rows give no rows.
    Reads the text once; the steps after it carry 40 bytes a row.  At most ``samples`` keys reach the driver; the
    tables that are broadcast have a row per range or per shard.
    """
    text = whole_text()
    units = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _hash60(text).alias("key"),
        _hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("tie"),
    )
    units = units.groupBy(*units.columns).agg(F.count(F.lit(1)).alias("copies"))
    units = stored(units, "shard-units")
    sums = units.agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows")).first()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if not sums["rows"]:
        return docs.sparkSession.createDataFrame([], SCHEMA.format(id=id_type))

    keys = _sample(units, samples, sums["bytes"], sums["rows"], seed)
    splitters = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})
    cells = _subdivided(units.withColumn("range", _range_of(splitters)), spread)

    # What lies before each cell; a row per cell, of which there are at most ranges * (1 + 2 / spread).
    before = Window.partitionBy().orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.groupBy("range", "sub").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows")
    ).select(
        "range", "sub",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("cell_bytes"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("cell_rows"),
    )
    within = Window.partitionBy("range", "sub").orderBy("key", "tie", "doc_id", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = cells.select(
        "*",
        F.coalesce(F.sum(F.col("size") * F.col("copies")).over(within), F.lit(0)).alias("bytes_in_cell"),
        F.coalesce(F.sum("copies").over(within), F.lit(0)).alias("rows_in_cell"),
    ).join(F.broadcast(starts), ["range", "sub"])
    placed = stored(placed.select(
        "doc_id", "size", "text_crc32", "key", "copies",
        (F.col("cell_bytes") + F.col("bytes_in_cell")).alias("start"),
        (F.col("cell_rows") + F.col("rows_in_cell")).alias("row"),
    ), "shard-places")

    groups = placed.groupBy("key").agg(
        F.min("start").alias("group_start"), F.sum(F.col("size") * F.col("copies")).alias("group_bytes"),
        F.sum("copies").alias("group_rows"),
    ).where(F.col("group_rows") > 1)
    groups = stored(groups, "shard-groups")  # so that the join below deals out both sides, and may split a large group
    rows = placed.join(groups, "key", "left").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    )
    # Twice the middle of what must stay together: a whole group, if it is small, or one row.
    together = F.col("group_bytes") * F.lit(shards) <= F.lit(group_share * sums["bytes"])
    middle = F.when(together, 2 * F.col("group_start") + F.col("group_bytes")).otherwise(
        2 * (F.col("start") + F.col("copy") * F.col("size")) + F.col("size")
    )
    rows = rows.select(
        "doc_id", "size", "text_crc32", (F.col("row") + F.col("copy")).alias("row"),
        F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * sums["bytes"]))).cast("int").alias("shard"),
    )
    firsts = rows.groupBy("shard").agg(F.min("row").alias("first"))
    return rows.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
