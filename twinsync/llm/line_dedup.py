"""Repeated runs of lines, found by winnowing over line hashes.

Of every ``run`` consecutive lines (blank ones do not count), the one with the least hash is selected.  Equal runs select
the same line, so two places that share ``run`` lines or more share a fingerprint, and about two lines in run + 1 are
fingerprints.  Fingerprints that stand at one place only are left out.  Around the others the match is extended both
ways: each run of lines that holds the position is compared, and what equals an earlier run is a later repeat.
Overlapping repeats make up the longest repeated stretch, which is deleted.  A shorter stretch of many words is a repeat as
well: each such stretch is a fingerprint of its own.

All of it is built-in expressions; nothing is gathered by line, so a line that stands everywhere is summed up before it
is shuffled and its joins can be split.  The joins are merge joins at every size, as no side has a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored, whole_text

RUN, WORDS = 3, 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _places(lines: Column) -> Column:
    """Where the lines stand that are not blank."""
    return F.filter(F.transform(lines, lambda line, i: F.when(F.trim(line) != "", i)), lambda i: i.isNotNull())


def _selected(hashes: Column, run: int) -> Column:
    """For each window of ``run`` hashes the place of its least one, the last of equals."""

    def least(start: Column) -> Column:
        window = F.slice(hashes, start + 1, run)
        return start + run - F.array_position(F.reverse(window), F.array_min(window)).cast("int")

    starts = F.sequence(F.lit(0), F.size(hashes) - run)
    return F.when(F.size(hashes) >= run, F.array_distinct(F.transform(starts, least))).otherwise(F.array().cast("array<int>"))


def _described(docs: DataFrame, run: int, keep: list[str]) -> DataFrame:
    lines = _lines(whole_text())
    rows = docs.select(F.struct(*(F.col(c) for c in keep)).alias("doc"), whole_text().alias("text"), lines.alias("lines"))
    rows = rows.select("*", _places(F.col("lines")).alias("places"))
    hashes = F.transform("places", lambda i: F.xxhash64(F.get("lines", i)))
    sizes = F.transform("places", lambda i: F.regexp_count(F.get("lines", i), F.lit(r"[^ \t]+")))
    rows = rows.select("doc", "text", "places", hashes.alias("hashes"), sizes.alias("sizes"))
    rows = rows.select("*", _selected(F.col("hashes"), run).alias("selected"), F.monotonically_increasing_id().alias("row"))
    return stored(rows, "lines")


def _heavy_runs(described: DataFrame, run: int, words: int) -> DataFrame:
    """Runs of fewer lines than ``run`` that hold as many words, and stand at several places: see ``_runs``."""

    def windows(size: int) -> Column:
        total = lambda start: F.aggregate(F.slice("sizes", start + 1, size), F.lit(0), lambda x, y: x + y)
        starts = F.filter(F.sequence(F.lit(0), F.size("sizes") - size), lambda start: total(start) >= words)
        found = F.transform(starts, lambda start: F.struct(start.alias("start"), F.lit(size).alias("size")))
        return F.when(F.size("sizes") >= size, found).otherwise(F.array().cast("array<struct<start:int,size:int>>"))

    runs = described.select(
        F.col("doc.doc_id").alias("doc_id"), "row", "hashes", F.inline(F.concat(*(windows(n) for n in range(1, run))))
    )
    held = F.slice("hashes", F.col("start") + 1, F.col("size"))
    keyed = runs.select("doc_id", "row", "start", "size", F.xxhash64(held).alias("k1"), F.xxhash64(F.lit(1), held).alias("k2"))
    several = keyed.groupBy("k1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1")
    return keyed.join(stored(several, "heavy").hint("merge"), "k1").select("doc_id", "row", "start", "size", "k1", "k2")


def _runs(described: DataFrame, run: int) -> DataFrame:
    """Runs of ``run`` lines around the marks: document, row, start, size and two hashes of their lines."""
    near = F.greatest(F.col("at") - (run - 1), F.lit(0))
    marks = described.select(F.col("doc.doc_id").alias("doc_id"), "row", "hashes", F.explode("selected").alias("at"))
    marks = marks.select(
        "doc_id", "row", F.get("hashes", "at").alias("mark"), near.alias("from"),
        F.slice("hashes", near + 1, F.lit(2 * run - 1) - (near - F.col("at") + run - 1)).alias("around"),
    )
    several = marks.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    marks = marks.join(stored(several, "marks").hint("merge"), "mark")
    starts = F.sequence(F.lit(0), F.size("around") - run)
    runs = marks.select("doc_id", "row", "from", "around", F.explode(starts).alias("i")).select(
        "doc_id", "row", (F.col("from") + F.col("i")).alias("start"), F.slice("around", F.col("i") + 1, run).alias("run")
    )
    return runs.select(
        "doc_id", "row", "start", F.lit(run).alias("size"), F.xxhash64("run").alias("k1"), F.xxhash64(F.lit(1), "run").alias("k2")
    ).distinct()


def _repeats(described: DataFrame, run: int, words: int) -> DataFrame:
    """Rows (row, removed): for each row of documents the places of its lines to delete, counted without blank ones."""
    runs = stored(_runs(described, run).unionByName(_heavy_runs(described, run, words)), "runs")
    first = runs.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(first.where("n > 1").select("k1", "k2", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")), "firsts")
    later = runs.join(first.hint("merge"), ["k1", "k2"]).where(
        (F.col("row") != F.col("first_row")) | (F.col("start") >= F.col("first_start") + F.col("size"))
    )
    covered = later.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("line"))
    return covered.groupBy("row").agg(F.collect_set("line").alias("removed"))


def remove_repeats(docs: DataFrame, run: int = RUN, keep: list[str] | None = None, words: int = WORDS) -> DataFrame:
    """``docs`` without later repeats of line runs: the columns ``keep``, cleaned text, n_lines, n_removed.

    A run of ``run`` lines, or of fewer lines with ``words`` words or more in all (words are what stands between blanks and
    tabs), is a repeat when an equal run stands in an earlier document (by doc_id, null first), or
    earlier in the same one without overlap; the earliest place always keeps its lines.  Every line of a repeat goes, so
    longer repeated stretches go whole.  Blank lines are not counted, do not break a run, and stay.

    Null text counts as empty; empty texts and texts of fewer lines and words are unchanged.  Repeated rows are documents one after
    another, so the later ones lose their lines.  ``keep`` is doc_id if not given.  No rows give no rows.
    """
    keep = keep or ["doc_id"]
    described = _described(docs, run, keep)
    removed = stored(_repeats(described, run, words), "removed")
    joined = described.select("doc", "text", "places", "row").join(removed.hint("merge"), "row", "left")
    gone = F.transform("removed", lambda i: F.get("places", i))
    left = F.filter(_lines(F.col("text")), lambda line, i: ~F.array_contains(gone, i))
    return joined.select(
        *(F.col(f"doc.{c}").alias(c) for c in keep),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.size("places").cast("long").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )


def digest(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, n_lines, n_removed and the cleaned text's SHA-256 for each row of ``docs``."""
    return remove_repeats(docs, run).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )
