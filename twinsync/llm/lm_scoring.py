"""Cross-entropy difference of documents under two matched class-bigram models.

A target model and a background model are alike in all but their counts: one vocabulary, one map of words to classes, one
smoothing.  A token's chance is that of its word's class after the class of the word before, times that of the word within
its class.  A word with at least one in ``CLASS_SHARE`` tokens is a class of its own; all others share a class with the
words that end like them.  A document's score is the mean over its tokens of the target's loss less the background's; the
lower, the more the document looks like the target.

All counts are over all documents, and none is left out: every word has its own count, however rare, and every pair of
classes.  A document is scored by models without it: its own counts are taken out of each side that holds it.

The classes bound the table of their pairs, and a bounded number of words is frequent, so both are sent to the tasks.  The
other words grow with the corpus.  Their counts stay a Spark table, which meets one row per document and word in a merge
join; no such word has a large share, so no key of the join is hot.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored

# One in so many tokens: words that are a class of their own, and words whose counts are sent to the tasks.
CLASS_SHARE, SENT_SHARE = 1 << 10, 1 << 17
ENDINGS = 1 << 8
SMOOTHING, PRIOR = 8.0, 0.5
CACHE_WORDS = 500_000
# Tokens that are held as arrays at a time, and rows of counts that meet before they leave the task.
CHUNK_TOKENS, HELD_COUNTS = 1 << 16, 1 << 19


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, with A-Z folded."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def ending(word: bytes) -> int:
    """The class, from 0, that a word shares with others: by its last three bytes."""
    return xxhash.xxh3_64_intdigest(word[-3:]) % ENDINGS


def _mark(word: bytes) -> int:
    """A negative number for a word: 55 bits of its hash, then its ending's class."""
    return -1 - (xxhash.xxh3_64_intdigest(word) >> 9 << 8 | ending(word))


@dataclass
class Vocabulary:
    """Marks of the frequent words, sorted, and the class of each; classes of words' own follow those of endings.

    The last class stands before a document's first word.
    """

    marks: np.ndarray
    classes: np.ndarray

    @property
    def size(self) -> int:
        return max(ENDINGS, int(self.classes.max(initial=0)) + 1) + 1

    def class_of(self, words: np.ndarray) -> np.ndarray:
        known = words >= 0
        out = (-1 - words) & (ENDINGS - 1)
        out[known] = self.classes[words[known]]
        return out


class _Numbers(dict):
    """A frequent word's place in the vocabulary; the mark of any other."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.places = {mark: at for at, mark in enumerate(vocabulary.marks.tolist())}

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        mark = _mark(word)
        number = self[word] = self.places.get(mark, mark)
        return number


def _word_counts(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            marks = [_mark(w) for w in tally]
            return pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(list(tally.values()), pa.int64())], ["mark", "n"])

        for batch in batches:
            for text in batch.column("text"):
                tally.update(tokens(text.as_py()))
                if len(tally) > CACHE_WORDS:
                    yield out()
                    tally.clear()
        yield out()

    return docs.select("text").mapInArrow(run, "mark bigint, n bigint").groupBy("mark").agg(F.sum("n").alias("n"))


def learn_vocabulary(docs: DataFrame, class_share: int = CLASS_SHARE, sent_share: int = SENT_SHARE) -> Vocabulary:
    """The frequent words of all documents; at most ``sent_share`` of them reach the driver."""
    words = stored(_word_counts(docs), "lm-words")
    total = words.agg(F.sum("n")).first()[0] or 0
    often = words.where(F.col("n") * max(class_share, sent_share) >= total).toArrow().sort_by("mark")
    marks, counts = often["mark"].to_numpy(), often["n"].to_numpy()
    classes = (-1 - marks) & (ENDINGS - 1)
    own = counts * class_share >= total
    classes[own] = ENDINGS + np.arange(int(own.sum()))
    return Vocabulary(marks, classes)


@dataclass
class Chunk:
    """Tokens of some documents: the document, word, class, and class before, of each."""

    doc: np.ndarray
    word: np.ndarray
    kind: np.ndarray
    before: np.ndarray
    sizes: np.ndarray


def _chunk(texts: list[list[bytes]], numbers: _Numbers, vocabulary: Vocabulary) -> Chunk:
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    word = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(sizes.sum()))
    kind = vocabulary.class_of(word)
    before = np.concatenate((kind[:1], kind[:-1]))
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = vocabulary.size - 1
    return Chunk(np.repeat(np.arange(len(sizes)), sizes), word, kind, before, sizes)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The words of a batch's texts, some texts at a time, with the row of the first."""
    begin, texts, size = 0, [], 0
    for i, text in enumerate(batch.column("text")):
        texts.append(tokens(text.as_py()))
        size += len(texts[-1])
        if size >= CHUNK_TOKENS:
            yield begin, texts
            begin, texts, size = i + 1, [], 0
    if texts:
        yield begin, texts


def _sums(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, how often each occurs (or the sum of its weights), and each row's place among them."""
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights=weights, minlength=len(found)), place


# Rows of the counts: a pair of classes, a frequent word, any other word.
_PAIR, _SENT, _OTHER = 0, 1, 2


def _counts(flagged: DataFrame, vocabulary) -> DataFrame:
    """Counts of class pairs and of words in the background (all rows) and the target (rows with ``target``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        numbers = _Numbers(known)
        cells = known.size * known.size
        pairs = np.zeros((2, cells), dtype=np.int64)
        sent = np.zeros((2, len(known.marks)), dtype=np.int64)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out(what: int, keys: np.ndarray, background: np.ndarray, target: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(np.full(len(keys), what, dtype=np.int32)), *(pa.array(c, pa.int64()) for c in (keys, background, target))]
            return pa.RecordBatch.from_arrays(columns, ["what", "key", "background", "target"])

        def others() -> pa.RecordBatch:
            keys, background, target = map(np.concatenate, zip(*held))
            held.clear()
            found, n, place = _sums(keys, background)
            return out(_OTHER, found, *(x.astype(np.int64) for x in (n, np.bincount(place, weights=target, minlength=len(found)))))

        for batch in batches:
            flags = np.array([bool(f) for f in batch.column("target").to_pylist()])
            for begin, texts in _chunks(batch):
                chunk = _chunk(texts, numbers, known)
                mine = flags[begin:begin + len(texts)][chunk.doc]
                code, frequent = chunk.before * known.size + chunk.kind, chunk.word >= 0
                for side, rows in enumerate((slice(None), mine)):
                    found, n, _ = _sums(code[rows])
                    pairs[side, found] += n
                    sent[side] += np.bincount(chunk.word[rows][frequent[rows]], minlength=len(known.marks))
                found, n, place = _sums(chunk.word[~frequent])
                held.append((found, n, np.bincount(place, weights=mine[~frequent], minlength=len(found))))
                if sum(len(keys) for keys, _, _ in held) >= HELD_COUNTS:
                    yield others()
        if held:
            yield others()
        for what, table in ((_PAIR, pairs), (_SENT, sent)):
            at = np.flatnonzero(table[0])
            yield out(what, at, table[0, at], table[1, at])

    counted = flagged.select("text", "target").mapInArrow(run, "what int, key bigint, background bigint, target bigint")
    return counted.groupBy("what", "key").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


@dataclass
class Side:
    """The counts of one side: class pairs, by the class before; classes; contexts; frequent words; all tokens."""

    pairs: np.ndarray
    sent: np.ndarray

    def __post_init__(self) -> None:
        self.kinds, self.contexts, self.total = self.pairs.sum(axis=0), self.pairs.sum(axis=1), float(self.pairs.sum())


@dataclass
class Models:
    """Both sides' bounded counts, and how many different words share each class."""

    vocabulary: Vocabulary
    sharing: np.ndarray
    background: Side
    target: Side
    smoothing: float

    def losses(self, chunk: Chunk) -> tuple[list[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per document, but for its words that are not sent: losses under the background without it, the target, and
        the target without it; and those words, as document, mark and count."""
        size, docs, s = self.vocabulary.size, len(chunk.sizes), self.smoothing
        pair, n, _ = _sums((chunk.doc * size + chunk.before) * size + chunk.kind)
        doc, before, kind = pair // (size * size), pair // size % size, pair % size
        _, context, at = _sums(pair // size, n)
        context = context[at]
        classed, in_class, at = _sums(doc * size + kind, n)
        of, shared = classed // size, classed % size < ENDINGS
        single = in_class[at]
        words, place = np.unique(chunk.word, return_inverse=True)
        entry, times, _ = _sums(chunk.doc * max(1, len(words)) + place)
        holder, word = entry // max(1, len(words)), words[entry % max(1, len(words))]
        plain = np.flatnonzero(word >= 0)
        plain = plain[self.vocabulary.classes[word[plain]] < ENDINGS]

        out = []
        for side, own in ((self.background, 1), (self.target, 0), (self.target, 1)):
            left = lambda counts, mine: np.maximum(counts - own * mine, 0)
            chance = (left(side.kinds[kind], single) + PRIOR) / (left(side.total, chunk.sizes[doc]) + PRIOR * (size - 1))
            after = (left(side.pairs[before, kind], n) + s * chance) / (left(side.contexts[before], context) + s)
            loss = np.bincount(doc, weights=-n * np.log(after), minlength=docs)
            within = left(side.kinds[classed % size], in_class)[shared] + PRIOR * self.sharing[classed[shared] % size]
            loss += np.bincount(of[shared], weights=in_class[shared] * np.log(within), minlength=docs)
            seen = left(side.sent[word[plain]], times[plain])
            out.append(loss + np.bincount(holder[plain], weights=-times[plain] * np.log(seen + PRIOR), minlength=docs))
        rare = word < 0
        return out, (holder[rare], word[rare], times[rare])


def train(docs: DataFrame, flagged: DataFrame, smoothing: float = SMOOTHING, **shares: int) -> tuple[Models, DataFrame]:
    """The bounded part of the models, and the counts of all other words (mark, in_background, in_target).

    ``flagged`` are the rows of ``docs`` with ``target``, true for the target's.
    """
    vocabulary = learn_vocabulary(docs, **shares)
    counts = stored(_counts(flagged, docs.sparkSession.sparkContext.broadcast(vocabulary)), "lm-counts")
    bounded = counts.where(F.col("what") != _OTHER).toArrow()
    what, key = bounded["what"].to_numpy(), bounded["key"].to_numpy()
    sides = []
    for name in ("background", "target"):
        n = bounded[name].to_numpy()
        pairs, sent = np.zeros(vocabulary.size * vocabulary.size), np.zeros(len(vocabulary.marks))
        pairs[key[what == _PAIR]] = n[what == _PAIR]
        sent[key[what == _SENT]] = n[what == _SENT]
        sides.append(Side(pairs.reshape(vocabulary.size, vocabulary.size), sent))
    others = counts.where(F.col("what") == _OTHER).select(
        F.col("key").alias("mark"), F.col("background").alias("in_background"), F.col("target").alias("in_target")
    )
    ended = others.groupBy((-1 - F.col("mark")).bitwiseAND(ENDINGS - 1).alias("class")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    sharing = np.bincount(vocabulary.classes, minlength=vocabulary.size)
    sharing[ended["class"].to_numpy()] += ended["n"].to_numpy()
    return Models(vocabulary, sharing, *sides, smoothing), others


_LOSSES = ("background", "target", "target_without")


def _parts(docs: DataFrame, models) -> DataFrame:
    """A row for each document, with the losses known within the task, and one for each of its words that is not sent.

    A document's own row has no count, and its number, which is no word's mark, as the mark.
    """
    id_field = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = models.value
        numbers = _Numbers(both.vocabulary)
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for begin, texts in _chunks(batch):
                chunk = _chunk(texts, numbers, both.vocabulary)
                losses, (holder, marks, n) = both.losses(chunk)
                here, more = rows[begin:begin + len(texts)], len(marks)
                ids = batch.column("doc_id").slice(begin, len(texts))
                none = pa.nulls(len(texts), pa.int64())
                join = lambda first, second: pa.concat_arrays([first, second])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((here, marks))), pa.array(np.concatenate((here, here[holder]))),
                    join(none, pa.array(n, pa.int64())), join(ids, pa.nulls(more, ids.type)),
                    join(pa.array(chunk.sizes), pa.nulls(more, pa.int64())),
                    *(join(pa.array(x, pa.float64()), pa.nulls(more, pa.float64())) for x in losses),
                ], ["mark", "row", "n", "doc_id", "n_tokens", *_LOSSES])

    losses = ", ".join(f"{c} double" for c in _LOSSES)
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).mapInArrow(
        run, f"mark bigint, row bigint, n bigint, doc_id {id_field}, n_tokens bigint, {losses}"
    )


def score(docs: DataFrame, targets: DataFrame, smoothing: float = SMOOTHING, **shares: int) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_tokens, target_loss, background_loss, score.

    Target are the rows whose doc_id is in ``targets``; background are all rows.  Losses are means per token in nats, each
    under counts without the row, and score is the target's less the background's.

    Null and empty texts have no tokens, and losses and score 0.  Rows with a null id are background only; an id that
    repeats in ``targets`` counts once.  Repeated rows count and are scored each; a row's copies stay in the counts that
    score it.  Without target rows the target model knows nothing: all classes, and all words of a class, are equally
    likely in it.  Other columns are left out.  No rows give no rows.
    """
    chosen = targets.select("doc_id").where("doc_id is not null").distinct().withColumn("chosen", F.lit(True))
    docs = docs.select("doc_id", "text")
    flagged = docs.join(chosen.hint("merge"), "doc_id", "left").withColumnRenamed("chosen", "target")  # ids without a bound
    models, others = train(docs, flagged, smoothing, **shares)
    parts = _parts(docs, docs.sparkSession.sparkContext.broadcast(models))

    def loss(known: str, count: str, own: int):
        left = F.greatest(F.col(count) - own * F.col("n"), F.lit(0))
        return F.sum(F.coalesce(F.col(known), -F.col("n") * F.log(left + F.lit(PRIOR)))).alias(known)

    sums = parts.join(others.hint("merge"), "mark", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"),
        loss("background", "in_background", 1), loss("target", "in_target", 0), loss("target_without", "in_target", 1),
    )
    tokens_ = F.greatest(F.col("n_tokens"), F.lit(1))
    return sums.join(chosen.hint("merge"), "doc_id", "left").select(
        "doc_id", "n_tokens",
        (F.when(F.col("chosen"), F.col("target_without")).otherwise(F.col("target")) / tokens_).alias("target_loss"),
        (F.col("background") / tokens_).alias("background_loss"),
    ).withColumn("score", F.col("target_loss") - F.col("background_loss"))
