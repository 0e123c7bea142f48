"""Chat transcripts to canonical turns, by a hidden Markov model over lines.

A line's hidden state is a role and whether the line opens a turn.  What is seen of it: the kind of speaker marker it
begins with, how long it is, and whether it is blank.  Chances are counted from transcripts whose turns are known, with
add-one smoothing.  Viterbi's path gives each line its state; opening lines start turns, markers are cut off, and turns
are written in one form.

Long transcripts are no single task.  Lines are dealt out in blocks; each block gives the best score from every state
before it to every state at its end (a small matrix), those are chained in order, forth and back, and each block
then finds its own lines' states between its known ends.  The path is that of one pass over the whole transcript.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import crc_mod, stored

ROLES = ("system", "user", "assistant")
STATES = len(ROLES) * 2  # state = 2 * role + (0 if the line opens a turn else 1)
BEGIN = STATES  # stands before the first line
BLOCK_LINES = 1 << 26
FOLDS, HELD_OUT = 5, 0

# How transcripts name their speakers.
MARKERS = (
    ("system", ("system", "instructions", "context")),
    ("user", ("user", "human", "customer", "q", "question", "prompter")),
    ("assistant", ("assistant", "ai", "bot", "agent", "a", "answer", "model")),
)
_NAMES = {name: i for i, (_, names) in enumerate(MARKERS) for name in names}
_MARKER = re.compile(r"\s*(?:#{1,6}\s*|<\|?|\[|\*\*|>\s*)?([A-Za-z]+)\s*(?:(?:\|?>|\]|\*\*)\s*:?|:)\s*")
NO_MARKER, OTHER_MARKER = len(ROLES), len(ROLES) + 1
LENGTHS = (0, 40, 80, 160, 320, 640)
KINDS = (len(ROLES) + 2) * len(LENGTHS)


def observe(line: str | None) -> tuple[int, int]:
    """What is seen of a line, as one number, and where its text begins after a marker that names a role."""
    line = line or ""
    found = _MARKER.match(line)
    kind = NO_MARKER if not found else _NAMES.get(found[1].lower(), OTHER_MARKER)
    length = sum(len(line) > x for x in LENGTHS[1:])
    return kind * len(LENGTHS) + length, found.end() if kind < len(ROLES) else 0


@dataclass
class Model:
    """Logarithms: of moves (from each state, or BEGIN, to each state) and of what is seen in each state."""

    moves: np.ndarray
    seen: np.ndarray


def model_of(moves: np.ndarray, seen: np.ndarray) -> Model:
    """From counts, with one added to each move that can be: a turn's later lines keep its role."""
    allowed = np.ones((STATES + 1, STATES))
    for state in range(1, STATES, 2):
        allowed[:, state] = 0
        allowed[[state - 1, state], state] = 1
    counts = (moves + 1) * allowed
    with np.errstate(divide="ignore"):
        return Model(
            np.log(counts / counts.sum(axis=1, keepdims=True)),
            np.log((seen + 1) / (seen + 1).sum(axis=1, keepdims=True)),
        )


def block_matrix(model: Model, kinds: list[int]) -> np.ndarray:
    """Best scores from each state before a block (or BEGIN) to each state of its last line."""
    best = model.moves + model.seen[:, kinds[0]]
    for kind in kinds[1:]:
        best = (best[:, :, None] + model.moves[None, :STATES]).max(axis=1) + model.seen[:, kind]
    return best


def block_path(model: Model, kinds: list[int], before: int, last: int) -> list[int]:
    """The best states of a block's lines between the state before it and its last one."""
    score = model.moves[before] + model.seen[:, kinds[0]]
    back = []
    for kind in kinds[1:]:
        options = score[:, None] + model.moves[:STATES]
        back.append(options.argmax(axis=0))
        score = options.max(axis=0) + model.seen[:, kind]
    path = [last]
    for choice in reversed(back):
        path.append(int(choice[path[-1]]))
    return path[::-1]


def _kinds(lines: DataFrame, block_lines: int) -> DataFrame:
    """Adds ``block`` and ``kind``, and the text after the marker, to lines (conv_id, line_no, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, texts = [], []
            for line in batch.column("line"):
                text = line.as_py() or ""
                kind, start = observe(text)
                kinds.append(kind)
                texts.append(text[start:])
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], [*names, "kind", "content"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema.fields)
    seen = lines.mapInArrow(run, f"{schema}, kind int, content string")
    return seen.withColumn("block", F.floor(F.col("line_no") / block_lines))


def _by_run(rows: DataFrame, keys: list[str], order: list[Column], columns: list[str], function: Callable, schema: str) -> DataFrame:
    """Feeds rows, dealt out and sorted by ``keys`` and ``order``, to ``function(keys, rows)`` run by run.

    ``function`` gets an iterator over the run's rows (tuples of ``columns``), so that it may hold no more than it needs,
    and yields output rows.
    """
    dealt = rows.select(*keys, *(c for c in columns if c not in keys)).repartition(*keys)
    dealt = dealt.sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def all_rows() -> Iterator[tuple[tuple, tuple]]:
            for batch in batches:
                own = list(zip(*(batch.column(k).to_pylist() for k in keys)))
                yield from zip(own, zip(*(batch.column(c).to_pylist() for c in columns)))

        def rows_out() -> Iterator[tuple]:
            source = all_rows()
            ahead = next(source, None)
            while ahead is not None:
                key = ahead[0]

                def own() -> Iterator[tuple]:
                    nonlocal ahead
                    while ahead is not None and ahead[0] == key:
                        row = ahead[1]
                        ahead = next(source, None)
                        yield row

                mine = own()
                yield from function(key, mine)
                for _ in mine:
                    pass

        def batch_of(waiting: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*waiting), arrow)], arrow.names)

        for row in rows_out():
            waiting.append(row)
            if len(waiting) >= 5000:
                yield batch_of(waiting)
                waiting = []
        if waiting:
            yield batch_of(waiting)

    arrow = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    return dealt.mapInArrow(run, schema)


def recover(lines: DataFrame, model: Model, block_lines: int = BLOCK_LINES) -> DataFrame:
    """For each line of ``lines`` (conv_id, line_no, line): conv_id, line_no, role, opens, content.

    ``role`` is who speaks, ``opens`` whether the line begins a turn (the first of a transcript always does), ``content``
    the line without a marker that names a role.  ``line_no`` gives the order; lines that share one stand in the order of
    their text.  Null lines are blank ones.  Lines of null conv_id are one transcript; a null line_no comes first.
    Other columns are left out.  No lines give no rows.
    """
    lines = lines.select("conv_id", F.coalesce("line_no", F.lit(-1)).cast("long").alias("line_no"), "line")
    seen = stored(_kinds(lines, block_lines), "chat-lines")
    sent = lines.sparkSession.sparkContext.broadcast(model)
    id_type = lines.schema["conv_id"].dataType.simpleString()
    in_order = [F.col("line_no"), F.col("line")]

    def matrix(key, rows):
        yield (*key, block_matrix(sent.value, [r[0] for r in rows]).ravel().tolist())

    blocks = stored(_by_run(
        seen, ["conv_id", "block"], in_order, ["kind", "line_no", "line"], matrix, f"conv_id {id_type}, block bigint, best array<double>"
    ), "chat-blocks")

    def forth(key, rows):
        score = np.full(STATES + 1, -np.inf)
        score[BEGIN] = 0
        for block, best in rows:
            yield (*key, block, score.tolist(), best)
            score = np.append((score[:, None] + np.array(best).reshape(STATES + 1, STATES)).max(axis=0), -np.inf)

    reached = stored(_by_run(
        blocks, ["conv_id"], [F.col("block")], ["block", "best"], forth,
        f"conv_id {id_type}, block bigint, score array<double>, best array<double>",
    ), "chat-reached")

    def back(key, rows):
        last = None
        for block, score, best in rows:
            options = np.array(score)[:, None] + np.array(best).reshape(STATES + 1, STATES)
            if last is None:
                last = int(options.max(axis=0).argmax())
            before = int(options[:, last].argmax())
            yield (*key, block, before, last)
            last = before

    ends = stored(_by_run(
        reached, ["conv_id"], [F.desc("block")], ["block", "score", "best"], back,
        f"conv_id {id_type}, block bigint, before int, last int",
    ), "chat-ends")

    same = seen["conv_id"].eqNullSafe(ends["conv_id"]) & (seen["block"] == ends["block"])
    joined = seen.join(ends, same).select(seen["conv_id"], seen["block"], "line_no", "line", "kind", "content", "before", "last")

    def path(key, rows):
        rows = list(rows)
        for row, state in zip(rows, block_path(sent.value, [r[2] for r in rows], rows[0][4], rows[0][5])):
            yield key[0], row[0], ROLES[state // 2], state % 2 == 0, row[3]

    return _by_run(
        joined, ["conv_id", "block"], in_order, ["line_no", "line", "kind", "content", "before", "last"], path,
        f"conv_id {id_type}, line_no bigint, role string, opens boolean, content string",
    )


def train(lines: DataFrame, turns: DataFrame) -> Model:
    """The model of known transcripts, counted over all their lines.

    ``lines`` has conv_id, turn, at (the line's place in its turn, from 0), line and role; ``turns`` has conv_id, turn,
    before (the role of the turn before, null for the first), role and n (the turn's number of lines).
    """
    role = lambda c: F.array_position(F.lit(list(ROLES)), F.col(c)).cast("int") - 1
    known = lines.where(F.col("role").isin(*ROLES))
    shown = _kinds(known.select(
        "conv_id", F.lit(0).cast("long").alias("line_no"), "line",
        (2 * role("role") + (F.col("at") > 0).cast("int")).alias("state"),
    ), 1)
    seen = np.zeros((STATES, KINDS))
    for row in shown.groupBy("state", "kind").count().collect():
        seen[row["state"], row["kind"]] = row["count"]
    moves = np.zeros((STATES + 1, STATES))
    known = turns.where(F.col("role").isin(*ROLES))
    counted = known.groupBy(
        role("role").alias("role"), F.coalesce(role("before"), F.lit(-1)).alias("before"), F.coalesce(F.col("n_before") > 1, F.lit(False)).alias("long")
    ).agg(F.count(F.lit(1)).alias("turns"), F.sum(F.col("n") - 1).alias("later"), F.sum((F.col("n") > 1).cast("int")).alias("second"))
    for row in counted.collect():
        opening = 2 * row["role"]
        before = BEGIN if row["before"] < 0 else 2 * row["before"] + row["long"]
        moves[before, opening] += row["turns"]
        moves[opening, opening + 1] += row["second"]
        moves[opening + 1, opening + 1] += row["later"] - row["second"]
    return model_of(moves, seen)


def canonical(recovered: DataFrame) -> DataFrame:
    """Recovered lines in the one form: ``rendered`` has a line as it is written, with ``<|role|>`` before a turn's first."""
    own = F.when(F.col("content") == "", "").otherwise(F.concat(F.lit("\n"), F.col("content")))
    opening = F.concat(F.lit("<|"), F.col("role"), F.lit("|>"), own)
    return recovered.select("*", F.when(F.col("opens"), opening).otherwise(F.col("content")).alias("rendered"))


# Transcripts of known conversations, for training and for checking.


def transcripts(conversations: DataFrame, line_span: int = 1 << 20) -> DataFrame:
    """Raw transcript lines of conversations (conv_id, turn, role, text), in several styles.

    A conversation's style goes by its id: names and punctuation of the markers differ, and in three of ten turns after
    the first the marker is missing.  Gives conv_id, turn, at, n, line_no, line, role.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    names = [("System", "User", "Assistant"), ("Instructions", "Human", "AI"), ("system", "user", "assistant"),
             ("Context", "Q", "A"), ("SYSTEM", "CUSTOMER", "AGENT")]
    forms = [("", ": "), ("### ", ":\n"), ("<|", "|>\n"), ("", ": "), ("[", "] ")]
    role = F.array_position(F.lit(list(ROLES)), F.col("role")).cast("int") - 1
    marker = F.lit("")
    for i, (names_of, (before, after)) in enumerate(zip(names, forms)):
        marker = F.when(style == i, F.concat(F.lit(before), F.get(F.lit(list(names_of)), role), F.lit(after))).otherwise(marker)
    silent = (F.col("turn") > 0) & (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) < 3)
    text = F.concat(F.when(silent, F.lit("")).otherwise(F.coalesce(marker, F.lit(""))), F.coalesce("text", F.lit("")))
    parts = conversations.select("conv_id", "turn", "role", F.split(text, "\n").alias("lines"))
    return parts.select(
        "conv_id", "turn", "role", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line")
    ).withColumn("line_no", F.col("turn").cast("long") * line_span + F.col("at"))


def taught(conversations: DataFrame) -> Model:
    """The model of the transcripts of all conversations outside the held-out fold (CRC-32 of conv_id modulo 5 is 0)."""
    known = conversations.where(crc_mod("conv_id", FOLDS) != HELD_OUT)
    lines = transcripts(known)
    turns = lines.where("at = 0").select("conv_id", "turn", "role", "n")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"), F.col("n").alias("n_before"))
    return train(lines, turns.join(before, ["conv_id", "turn"], "left"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Every conversation's transcript, parsed and written anew: a row per line.

    Gives conv_id, line_no, held_out, role (recovered), opens, rendered, and ``right``: whether role and opening are
    those of the conversation.  Null texts are empty turns; roles other than the known three can't be right and have no
    marker; rows with a null conv_id are one transcript.
    """
    lines = transcripts(conversations)
    found = canonical(recover(lines, taught(conversations)))
    truth = lines.groupBy("conv_id", F.coalesce("line_no", F.lit(-1)).alias("line_no")).agg(
        F.min("role").alias("true_role"), (F.min("at") == 0).alias("true_opens")
    )
    same = found["conv_id"].eqNullSafe(truth["conv_id"]) & (found["line_no"] == truth["line_no"])
    right = (F.col("role") == F.coalesce("true_role", F.lit(""))) & (F.col("opens") == F.col("true_opens"))
    return found.join(truth, same, "left").select(
        found["conv_id"], found["line_no"],
        F.coalesce(F.crc32(found["conv_id"].cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False)).alias("held_out"),
        "role", "opens", "rendered", F.coalesce(right, F.lit(False)).alias("right"),
    )
