"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows.  A forward and a backward gated recurrent layer run over each window, and the
two states at a byte give that byte's probabilities of the languages.  A document's probabilities are the means over
all its bytes.  Training is back-propagation through time in numpy, with a loss at every byte, on a sample of texts of
bounded size; labelling runs in Spark tasks over all bytes of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import crc_mod

HIDDEN, WINDOW = 8, 96
SAMPLE_TEXTS, SAMPLE_CHARS = 500, 768
STEPS, BATCH, RATE = 500, 192, 0.02
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
ROWS_AT_ONCE = 1024


@dataclass
class Network:
    """Weights: per direction a table of gate inputs by byte and a recurrent matrix; and the output layer."""

    languages: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def _new(languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    return Network(
        languages, [draw(256, 3 * hidden, s=0.5) for _ in range(2)], [draw(hidden, 3 * hidden, s=hidden**-0.5) for _ in range(2)],
        draw(2 * hidden, len(languages), s=0.3), np.zeros(len(languages), dtype=np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _layer(x: np.ndarray, table: np.ndarray, recurrent: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States after each byte of the windows x (time, row), in order of x.

    Gates: reset, update, then the candidate.  ``trace`` takes what the backward pass needs.
    """
    hidden = recurrent.shape[0]
    state = np.zeros((x.shape[1], hidden), dtype=np.float32)
    states = np.empty((*x.shape, hidden), dtype=np.float32)
    for t, row in enumerate(x):
        given, back = table[row], state @ recurrent
        gates = given[:, :2 * hidden]
        gates += back[:, :2 * hidden]
        gates = _sigmoid(gates)
        reset, update = gates[:, :hidden], gates[:, hidden:]
        candidate = np.tanh(given[:, 2 * hidden:] + reset * back[:, 2 * hidden:])
        if trace is not None:
            trace.append((state, reset, update, candidate, back[:, 2 * hidden:]))
        state = candidate + update * (state - candidate)
        states[t] = state
    return states


def _layer_gradient(
    x: np.ndarray, recurrent: np.ndarray, trace: list, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the table and the recurrent matrix, from those of the states: back-propagation through time."""
    hidden = recurrent.shape[0]
    inputs = np.empty((*x.shape, 3 * hidden), dtype=np.float32)
    matrix = np.zeros_like(recurrent)
    carried = np.zeros(wanted.shape[1:], dtype=np.float32)
    for t in range(len(x) - 1, -1, -1):
        state, reset, update, candidate, back = trace[t]
        carried = carried + wanted[t]
        at_candidate = carried * (1 - update) * (1 - candidate**2)
        at_update = carried * (state - candidate) * update * (1 - update)
        at_reset = at_candidate * back * reset * (1 - reset)
        gates = np.concatenate([at_reset, at_update, at_candidate * reset], axis=1)
        inputs[t] = np.concatenate([at_reset, at_update, at_candidate], axis=1)
        matrix += state.T @ gates
        carried = carried * update + gates @ recurrent.T
    flat, columns = x.ravel(), inputs.reshape(-1, 3 * hidden)
    table = np.stack([np.bincount(flat, weights=c, minlength=256) for c in columns.T], axis=1)
    return table.astype(np.float32), matrix


def _run(x: np.ndarray, table: np.ndarray, recurrent: np.ndarray) -> np.ndarray:
    """What ``_layer`` gives, faster: each gate in memory of its own, and halves of the sigmoids folded into weights.

    With u = tanh(half of a gate's input), the gate is (1 + u) / 2.
    """
    hidden = recurrent.shape[0]
    given, back = [], []
    for i, half in enumerate((0.5, 0.5, 1.0)):
        given.append(np.ascontiguousarray(table[:, i * hidden:(i + 1) * hidden]) * np.float32(half))
        back.append(np.ascontiguousarray(recurrent[:, i * hidden:(i + 1) * hidden]) * np.float32(0.5))
    states = np.empty((*x.shape, hidden), dtype=np.float32)
    state = np.zeros((x.shape[1], hidden), dtype=np.float32)
    reset, update, candidate, product = (np.empty_like(state) for _ in range(4))
    for t, row in enumerate(x):
        for gate, g, b in zip((reset, update), given, back):
            np.take(g, row, axis=0, out=gate, mode="clip")
            np.matmul(state, b, out=product)
            gate += product
            np.tanh(gate, out=gate)
            gate += 1
        np.matmul(state, back[2], out=product)
        product *= reset
        np.take(given[2], row, axis=0, out=candidate, mode="clip")
        candidate += product
        np.tanh(candidate, out=candidate)
        np.subtract(state, candidate, out=product)
        product *= update
        product *= 0.5
        state = states[t]
        np.add(candidate, product, out=state)
    return states


def probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities of the languages (language, time, row) at each byte of the windows (row, time)."""
    x = np.ascontiguousarray(windows.T)
    ahead = _run(x, net.table[0], net.recurrent[0])
    behind = _run(x[::-1], net.table[1], net.recurrent[1])[::-1]
    hidden = ahead.shape[2]
    scores = net.output[:hidden].T @ ahead.reshape(-1, hidden).T
    scores += net.output[hidden:].T @ behind.reshape(-1, hidden).T
    scores += net.bias[:, None]
    # States lie between -1 and 1, so the scores are as small as the weights and need no shift.
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0)
    return scores.reshape(-1, *x.shape)


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean loss over all bytes but padding."""
    x = np.ascontiguousarray(windows.T)
    traces: list[list] = [[], []]
    ahead = _layer(x, net.table[0], net.recurrent[0], traces[0])
    behind = _layer(x[::-1], net.table[1], net.recurrent[1], traces[1])[::-1]
    states = np.concatenate([ahead, behind], axis=2)
    scores = states @ net.output + net.bias
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    error = scores / scores.sum(axis=2, keepdims=True)
    error[:, np.arange(len(labels)), labels] -= 1
    real = (x != 0)[:, :, None]
    error = (error * real / max(1, real.sum())).astype(np.float32)
    hidden = ahead.shape[2]
    wanted = error @ net.output.T
    flat = error.reshape(-1, error.shape[2])
    first = _layer_gradient(x, net.recurrent[0], traces[0], wanted[:, :, :hidden])
    second = _layer_gradient(x[::-1], net.recurrent[1], traces[1], wanted[::-1, :, hidden:])
    return [first[0], second[0], first[1], second[1], states.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)]


def windows_of(text: str, width: int) -> np.ndarray:
    """The text's bytes in rows of ``width``, the last one padded with 0."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(-(-len(raw) // width) * width, dtype=np.uint8)
    out[:len(raw)] = raw
    return out.reshape(-1, width)


def train(
    texts: list[str], langs: list[str], hidden: int = HIDDEN, window: int = WINDOW, steps: int = STEPS,
    batch: int = BATCH, rate: float = RATE, seed: int = 5,
) -> Network:
    """The network after ``steps`` of Adam on windows of the texts, each language drawn alike often."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    net = _new(languages, hidden, rng)
    pools = [np.concatenate([windows_of(t, window) for t, l in zip(texts, langs) if l == lang]) for lang in languages]
    weights = [*net.table, *net.recurrent, net.output, net.bias]
    mean, square = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        labels = rng.integers(len(languages), size=batch)
        rows = np.stack([pools[k][rng.integers(len(pools[k]))] for k in labels])
        gradients = _gradients(net, rows, labels)
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients))
        now = rate * min(1.0, 1.2 * (1 - step / (steps + 1)))
        for w, g, m, s in zip(weights, gradients, mean, square):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def _sample(docs: DataFrame, per_language: int, chars: int) -> tuple[list[str], list[str]]:
    """Stretches of ``chars`` characters from about ``per_language`` labelled texts of each language.

    Drawn by a hash from the rows outside the held-out fold; the driver holds at most ``2 * per_language`` rows a
    language.
    """
    taught = docs.where(F.col("lang").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT) & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    turn = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.element_at(F.create_map(*(F.lit(x) for l, n in counts.items() for x in (l, per_language / n))), F.col("lang"))
    spare = F.greatest(F.char_length("text") - chars, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.lit(4), "doc_id"), spare).cast("int") + 1
    drawn = taught.where(turn < share).select(
        "lang", F.substring("text", start, F.lit(chars)).alias("text"), turn.alias("turn")
    ).orderBy("turn", "lang", "text").limit(2 * per_language * len(counts))
    rows = drawn.collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def _labeller(net, window: int):
    def pooled(texts: list[str]) -> np.ndarray:
        """Mean probabilities of each text (all have at least one byte)."""
        sums = np.zeros((len(texts), len(net.value.languages)))
        sizes = np.zeros(len(texts))
        held: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def flush() -> None:
            rows, owner = np.concatenate(held), np.concatenate(owners)
            held.clear()
            owners.clear()
            for i in range(0, len(rows), ROWS_AT_ONCE):
                part, mine = rows[i:i + ROWS_AT_ONCE], owner[i:i + ROWS_AT_ONCE]
                real = part != 0
                at = (probabilities(net.value, part) * real.T).sum(axis=1).T
                np.add.at(sums, mine, at)
                np.add.at(sizes, mine, real.sum(axis=1))

        waiting = 0
        for i, text in enumerate(texts):
            held.append(windows_of(text, window))
            owners.append(np.full(len(held[-1]), i))
            waiting += len(held[-1])
            if waiting >= ROWS_AT_ONCE:
                flush()
                waiting = 0
        if held:
            flush()
        return sums / np.maximum(sizes, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if net.value else []
            langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                found = pooled([texts[i] for i in known])
                for i, best, row in zip(known, found.argmax(axis=1), found):
                    langs[i], scores[i] = net.value.languages[best], float(min(1.0, row[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return run


def identify(
    docs: DataFrame, hidden: int = HIDDEN, window: int = WINDOW, steps: int = STEPS,
    per_language: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score.

    Learns from rows with a language whose id's CRC-32 modulo 5 is not 0 (about ``per_language`` stretches of ``chars``
    characters per language), and predicts every row from its text alone.  ``score`` is the mean probability of the
    predicted language.

    Null texts, and texts without a letter, are ``und`` with score 0; so is everything where there is nothing to learn
    from.  Rows with a null id are not learnt from and not held out.  Repeated rows are predicted alike.  Other columns
    are left out.  No rows give no rows.
    """
    texts, langs = _sample(docs, per_language, chars)
    net = train(texts, langs, hidden, window, steps) if texts else None
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        _labeller(docs.sparkSession.sparkContext.broadcast(net), window), f"doc_id {id_type}, lang_pred string, score double"
    )
    held_out = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
