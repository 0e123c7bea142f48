"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

Each class is a normal density over transformed statistics of the text.  Its covariance is shrunk toward the pooled one
and toward the identity, so that small or degenerate classes stay usable.  A document's score is the probability
that its difference of log densities gives: Mahalanobis distances through the classes' Cholesky factors, which are
made once and sent to the tasks.

Means and covariances are exact sums over all labelled rows; nothing is sampled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import crc_mod, stored

POOLED, ROUND = 0.5, 0.02
# Usual bytes and words that every text is taken to have besides its own, so that ratios of short texts mean little.
_BYTES, _WORDS = 40, 8
FOLDS, HELD_OUT = 3, 1

_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _SIGN, _HIGH = range(7)
_KIND = np.full(256, _SIGN)
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[*b".,;:!?'\"()-"]] = _STOP
_KIND[128:] = _HIGH
STATISTICS = (
    "words", "word_bytes", "word_spread", "different", "commonest", "letters", "capitals", "digits", "stops", "signs",
    "wordless", "lines", "line_bytes", "same_lines", "cells",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, transformed so that they spread about evenly; all finite, for any text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=7)
    words = raw.split()
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    lines = [line for line in raw.split(b"\n") if line]
    tally = Counter(words)
    n, dark = len(words), len(raw) - kinds[_SPACE]
    letters = kinds[_LETTER] + kinds[_HIGH]
    word_sum, word_squares = lengths.sum() + 5 * _WORDS, (lengths**2).sum() + 40 * _WORDS
    mean = word_sum / (n + _WORDS)
    # Words without a letter or digit: only bytes of other kinds are left once those are deleted.
    bare = sum(c for w, c in tally.items() if not w.translate(None, _MARKS))

    def share(part: float, whole: float, usual: float, weight: float) -> float:
        return float(np.arcsin(np.sqrt(min(1.0, (part + usual * weight) / (whole + weight)))))

    return [
        np.log1p(n), np.log(mean), 0.5 * np.log(word_squares / (n + _WORDS) - mean**2 + 1),
        np.log((len(tally) + _WORDS) / (n + _WORDS)),
        share(max(tally.values(), default=0), n, 0.05, _WORDS), share(letters, dark, 0.95, _BYTES),
        share(counts[65:91].sum(), letters, 0.02, _BYTES), share(kinds[_DIGIT], dark, 0, _BYTES),
        share(kinds[_STOP], dark, 0.03, _BYTES), share(kinds[_SIGN], dark, 0, _BYTES), share(bare, n, 0, _WORDS),
        np.log1p(len(lines)), np.log((len(raw) + 100) / (len(lines) + 1)),
        share(len(lines) - len(set(lines)), len(lines), 0, 1), share(counts[124] + counts[9], n, 0, _WORDS),
    ]


_MARKS = bytes(b for b in range(128) if _KIND[b] in (_STOP, _SIGN))


@dataclass
class Model:
    """Both classes' means, Cholesky factors of the inverse covariances, and constants, after standardising."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    constants: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row of statistics."""
        x = (rows - self.centre) / self.scale
        logs = [c - 0.5 * (((x - m) @ w) ** 2).sum(axis=1) for m, w, c in zip(self.means, self.whiten, self.constants)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def solve(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float, round_: float) -> Model:
    """The model from each class's count, sums and sums of products.  A class without rows takes the other's shape."""
    size = len(STATISTICS)
    n = np.array([sums[k][0] if k in sums else 0.0 for k in (0, 1)])
    first = [sums[k][1] if k in sums else np.zeros(size) for k in (0, 1)]
    second = [sums[k][2] if k in sums else np.zeros((size, size)) for k in (0, 1)]
    total = max(1.0, n.sum())
    centre = sum(first) / total
    scale = np.sqrt(np.maximum(np.diag(sum(second)) / total - centre**2, 1e-6))
    means, spreads = [], []
    for k in (0, 1):
        mean = first[k] / n[k] if n[k] else centre
        scatter = second[k] - n[k] * np.outer(mean, mean)
        means.append((mean - centre) / scale)
        spreads.append(scatter / np.outer(scale, scale))
    common = sum(spreads) / total
    whiten, constants = [], []
    for k in (0, 1):
        own = spreads[k] / n[k] if n[k] else common
        shrunk = (1 - pooled) * own + pooled * common
        shrunk = (1 - round_) * shrunk + round_ * np.eye(size) * max(np.trace(shrunk) / size, 1e-3)
        factor = np.linalg.cholesky(shrunk)
        whiten.append(np.linalg.inv(factor).T)
        constants.append(np.log((n[k] + 1) / (n.sum() + 2)) - np.log(np.diag(factor)).sum())
    return Model(centre, scale, np.array(means), np.array(whiten), np.array(constants))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "statistics"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, statistics array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("statistics").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(STATISTICS))


def fit(described: DataFrame, labels: DataFrame, pooled: float = POOLED, round_: float = ROUND) -> Model:
    """The model of all labelled rows outside the held-out fold.  ``labels`` has doc_id and quality (0 or 1)."""
    taught = labels.where(F.col("quality").isin(0, 1) & (crc_mod("doc_id", FOLDS) != HELD_OUT))
    rows = described.join(taught.select("doc_id", F.col("quality").cast("int").alias("quality")), "doc_id")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch), batch.column("quality").to_numpy()
            for k in (0, 1):
                mine = np.column_stack([np.ones((y == k).sum()), x[y == k]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([(mine.T @ mine).ravel()], pa.list_(pa.float64()))], ["quality", "products"]
                )

    parts = rows.select("quality", "statistics").mapInArrow(sums, "quality int, products array<double>")
    parts = parts.select("quality", F.posexplode("products").alias("at", "value"))
    got: dict[int, np.ndarray] = {}
    size = len(STATISTICS) + 1
    for row in parts.groupBy("quality", "at").agg(F.sum("value").alias("value")).collect():
        got.setdefault(row["quality"], np.zeros(size * size))[row["at"]] = row["value"]
    tables = {k: v.reshape(size, size) for k, v in got.items()}
    return solve({k: (t[0, 0], t[0, 1:], t[1:, 1:]) for k, t in tables.items() if t[0, 0]}, pooled, round_)


def score(docs: DataFrame, labels: DataFrame, pooled: float = POOLED, round_: float = ROUND) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from the labelled rows whose id's CRC-32 modulo 3 is not 1, and scores all.  Null text counts as empty and is
    scored like any; rows with a null id are scored and not held out.  Rows that repeat are scored alike, and count as
    often as they are labelled.  Labels that are null or not 0 or 1 are left out; without any, each score is one half.
    Other columns are left out.  No rows give no rows.
    """
    described = stored(describe(docs), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit(described, labels, pooled, round_))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.value.scores(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = described.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id", F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, pooled: float = POOLED, round_: float = ROUND) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns; learns as ``score`` does."""
    model = docs.sparkSession.sparkContext.broadcast(fit(stored(describe(docs), "statistics"), labels, pooled, round_))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text.as_py()) for text in batch.column("text")]
            good = model.value.scores(np.array(rows).reshape(-1, len(STATISTICS))) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
