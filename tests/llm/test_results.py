"""Results against brute force, SQL, exact round trips and held-out accuracy."""

import bisect
import hashlib
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from twinsync.llm import chat_format, components, decontamination, language, line_dedup, lm_scoring, ngram_join, packing
from twinsync.llm import queries, sharding
from twinsync.llm.common import table
from twinsync.llm.tokens import Ids

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES = queries.all_queries()


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"create view {file[:-8]} as select * from '{SF_DIR}/{file}'")
    found = QUERIES[name](spark, SF_DIR)
    expected = connection.sql(queries.all_sql()[name]).project(", ".join(sorted(found.columns))).fetchall()
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in found.select(*sorted(found.columns)).collect())


def test_language(spark, texts):
    langs = {r["doc_id"]: r["lang"] for r in table(spark, SF_DIR, "documents").collect()}
    found = by_id(QUERIES["op1_language_id"](spark, SF_DIR))
    held = [i for i in texts if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in found.items() if r["held_out"]} == set(held)
    assert np.mean([found[i]["lang_pred"] == langs[i] for i in held]) >= 0.9


def test_language_gradients():
    rng = np.random.default_rng(1)
    net = language._new(["a", "b"], 3, rng)
    windows, labels = rng.integers(1, 255, size=(4, 7)).astype(np.uint8), np.array([0, 1, 1, 0])
    loss = lambda: -np.log(language.probabilities(net, windows)[labels, :, np.arange(4)]).mean()
    for weight, gradient in zip([*net.table, *net.recurrent, net.output], language._gradients(net, windows, labels)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = weight[at], 1e-2
        weight[at] = old + step
        above = loss()
        weight[at] = old - step
        below = loss()
        weight[at] = old
        assert (above - below) / (2 * step) == pytest.approx(gradient[at], rel=0.02)


def test_quality(spark):
    found = by_id(QUERIES["op4_quality"](spark, SF_DIR))
    labels = [r for r in table(spark, SF_DIR, "labels").collect() if found[r["doc_id"]]["held_out"]]
    assert np.mean([found[r["doc_id"]]["predicted"] == r["quality"] for r in labels]) >= 0.9


@pytest.mark.parametrize("sent", [1 << 6, 1 << 30])
def test_lm_scoring(spark, texts, sent):
    """Against models that are counted anew for each document; which words are sent to the tasks changes nothing."""
    good = {r["doc_id"] for r in table(spark, SF_DIR, "labels").where("quality = 1").collect()}
    found = by_id(lm_scoring.score(
        table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels").where("quality = 1"), class_share=1 << 6, sent_share=sent
    ))
    split = {i: lm_scoring.tokens(t) for i, t in texts.items()}
    words = Counter(w for t in split.values() for w in t)
    total = words.total()
    kind = {w: w if n << 6 >= total else lm_scoring.ending(w) for w, n in words.items()}
    assert any(isinstance(k, bytes) for k in kind.values())
    classes = lm_scoring.ENDINGS + sum(n << 6 >= total for n in words.values())
    sharing = Counter(kind.values())
    pairs = {i: Counter(zip([None, *(kind[w] for w in t)], (kind[w] for w in t))) for i, t in split.items()}

    def counted(ids):
        pair, word, single, context = Counter(), Counter(), Counter(), Counter()
        for i in ids:
            pair.update(pairs[i])
            word.update(split[i])
        for (b, k), n in pair.items():
            single[k] += n
            context[b] += n
        return pair, word, single, context, single.total()

    def loss(i, every, ids):
        pair, word, single, context, n = every
        mine = counted([i] if i in ids else [])
        before, out = None, []
        for w in split[i]:
            k = kind[w]
            chance = (single[k] - mine[2][k] + 0.5) / (n - mine[4] + 0.5 * classes)
            p = (pair[before, k] - mine[0][before, k] + 8 * chance) / (context[before] - mine[3][before] + 8)
            if not isinstance(k, bytes):
                p *= (word[w] - mine[1][w] + 0.5) / (single[k] - mine[2][k] + 0.5 * sharing[k])
            out.append(-np.log(p))
            before = k
        return np.mean(out) if out else 0.0

    sides = {"background_loss": set(texts), "target_loss": good & set(texts)}
    sides = {name: (counted(ids), ids) for name, ids in sides.items()}
    for i, row in found.items():
        for name, (every, ids) in sides.items():
            assert row[name] == pytest.approx(loss(i, every, ids))
    assert len(found) == len(texts)


def test_lm_scoring_holds_few_tokens_at_a_time():
    """What a task holds for its texts does not grow with the rows of a batch."""
    rng = random.Random(2)
    batch = pa.record_batch({"text": [" ".join(rng.choices("abcdefgh", k=50)) for _ in range(20_000)]})
    vocabulary = lm_scoring.Vocabulary(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    numbers = lm_scoring._Numbers(vocabulary)
    side = lm_scoring.Side(np.ones((vocabulary.size, vocabulary.size)), np.zeros(0))
    models = lm_scoring.Models(vocabulary, np.ones(vocabulary.size), side, side, 8.0)
    tracemalloc.start()
    rows = 0
    for begin, split in lm_scoring._chunks(batch):
        assert begin == rows
        rows += len(split)
        models.losses(lm_scoring._chunk(split, numbers, vocabulary))
    assert rows == 20_000 and tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()


def test_lm_scoring_tells_good_from_bad(spark):
    found = by_id(QUERIES["op2_lm_scoring"](spark, SF_DIR))
    labels = table(spark, SF_DIR, "labels").collect()
    good, bad = ([found[r["doc_id"]]["score"] for r in labels if r["quality"] == q] for q in (1, 0))
    assert np.mean([g < b for g in good for b in bad]) > 0.9


@pytest.mark.parametrize("share", [0, 0.01])
def test_sharding(spark, texts, share):
    found = by_id(sharding.shard_by_bytes(table(spark, SF_DIR, "documents"), group_share=share))
    key = lambda t: int(hashlib.sha256(t.encode()).hexdigest()[:15], 16)
    order = sorted(texts, key=lambda i: (key(texts[i]), key(str(i))))
    size = {i: len(t.encode()) + 1 for i, t in texts.items()}
    total, start, slots = sum(size.values()), 0, Counter()
    for i in order:
        if not share:
            assert found[i]["shard"] == min(15, (2 * start + size[i]) * 16 // (2 * total))
        assert (found[i]["size"], found[i]["text_crc32"]) == (size[i], zlib.crc32(texts[i].encode()))
        assert found[i]["slot"] == slots[found[i]["shard"]]
        slots[found[i]["shard"]] += 1
        start += size[i]
    loads = Counter()
    for i, r in found.items():
        loads[r["shard"]] += r["size"]
    assert max(abs(n - total / 16) for n in loads.values()) <= max(size.values()) + share * total / 16


def test_overfull_ranges_are_subdivided(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    found = sharding.shard_by_bytes(docs, ranges=4, samples=8, spread=0.1)
    loads = {r["shard"]: r["sum(size)"] for r in found.groupBy("shard").sum("size").collect()}
    assert len(loads) == 16 and max(loads.values()) - min(loads.values()) <= 10


def test_tokens(texts):
    whole = Tokenizer.from_file(TOKENIZER)
    odd = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b\n<|endoftext|>\n", "<|endoftext|", "x <|endoftext|> a <|endof"]
    odd += ["  a  b\n\n c\t d ", "it's\nx <|endoftext|> a", "\n", "a \n b", "é　x y 1234,5'll don't", " lead", "trail ", "a\r\nb c", "😀 x"]
    ids = Ids(TOKENIZER)
    for text in [*odd, *texts.values()][:250]:
        assert np.frombuffer(ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_plan(seed):
    lengths = random.Random(seed).choices(range(1, 65), weights=[random.Random(seed + i).random() ** 3 for i in range(64)], k=700)
    plan, used = packing.best_fit_plan(Counter(lengths), 64), defaultdict(int)
    for length, count in Counter(lengths).items():
        for rank in range(count):
            row = plan[length][np.searchsorted(plan[length][:, 0], rank, side="right") - 1]
            turn = rank - row[0]
            used[row[1] + turn // row[2]] += length
    rooms, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        opened += at == len(rooms)
        bisect.insort(rooms, (rooms.pop(at) if at < len(rooms) else 64) - length)
    assert max(used.values()) <= 64 and len(used) == opened


def test_packing(spark, texts):
    found = packing.pack(table(spark, SF_DIR, "documents"), TOKENIZER, bucket_pieces=5).collect()
    ids, pieces, places = Ids(TOKENIZER), defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        whole = ids(text) + (2).to_bytes(4, "little")
        start = 0
        for n, r in enumerate(sorted(pieces[i], key=lambda r: r["piece"])):
            part = whole[4 * start:4 * (start + r["length"])]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, start, zlib.crc32(part)) and (n == 0 or r["length"] == 1024)
            start += r["length"]
        assert 4 * start == len(whole)
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 1024


def decontaminated(texts, items, width=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for name, text in items:
        words = word.findall(fold(text))
        for i in range(len(words) - min(width, len(words)) + 1 if words else 0):
            windows[tuple(words[i:i + width])].add(str(name))
    out = {}
    for i, text in texts.items():
        words, hit, names = word.findall(fold(text)), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if tuple(words[at:at + n]) in windows:
                    names |= windows[tuple(words[at:at + n])]
                    hit |= set(range(at, at + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[i] = (len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words))
    return out


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000, "shard_words": 500}])
def test_decontamination(spark, texts, options):
    benchmark = table(spark, SF_DIR, "benchmark")
    found = by_id(decontamination.mark_contaminated(table(spark, SF_DIR, "documents"), benchmark, **options))
    expected = decontaminated(texts, [(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert {i: tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for i, r in found.items()} == expected


def test_longest_matches_of_repetitive_texts(monkeypatch):
    """All maximal matches, found by trying every pair of places; few cells at once change nothing."""
    rng = random.Random(5)
    docs = [[rng.choice([b"a", b"a", b"b"]) for _ in range(rng.randrange(60))] for _ in range(12)]
    items = [(i, " ".join(rng.choice("aab") for _ in range(n))) for i, n in enumerate([2, 3, 9, 30, 30])]
    expected = []
    for d, doc in enumerate(docs):
        for name, text in items:
            item = [w.encode() for w in text.split()]
            for i in range(len(doc)):
                for j in range(len(item)):
                    n = 0
                    while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]:
                        n += 1
                    if n >= min(4, len(item)) and not (i and j and doc[i - 1] == item[j - 1]):
                        expected.append((d, str(name), i, j, n))
    for cells in (7, 1 << 21):
        monkeypatch.setattr(decontamination, "CELLS_AT_ONCE", cells)
        found = decontamination.scan_shard(docs, decontamination.make_block(items, 4))[2]
        assert sorted((d, *m) for d, of in enumerate(found) for m in of) == sorted(expected)


def test_many_equal_words_take_little_memory():
    block = decontamination.make_block([(1, "a " * 1000)], 13)
    tracemalloc.start()
    hits, items, matches = decontamination.scan_shard([[b"a"] * 40_000], block)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (hits, items) == ([[(0, 40_000)]], [["1"]]) and max(m[3] for m in matches[0]) == 1000
    assert most < 400 << 20


def test_longest_matches_and_short_items(spark):
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, "x y " + " ".join(words[5:30]) + " z w1"), (2, "W1 w0")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, " ".join(words)), (8, "w1")], "item_id bigint, text string")
    found = by_id(decontamination.mark_contaminated(docs, benchmark))
    assert sorted(tuple(m) for m in found[1]["matches"]) == [("7", 2, 5, 25), ("8", 28, 0, 1)]
    assert (found[1]["n_hit"], found[2]["n_hit"], found[2]["n_items"]) == (26, 1, 1)


def components_of(texts, size, percent):
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        sets[i] = {tuple(words[j:j + size]) for j in range(max(1, len(words) - size + 1))} if words else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sorted(sets):
        for b in sets:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if a < b and small and 100 * small >= percent * large:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    low, high = sorted((root(a), root(b)))
                    label[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(seed, groups, each, length):
    """Chains and stars of near copies with a shared passage, so that components need more than one pivot."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefgh", k=draw.choice((2, 3, 7))))
    passage, texts = [word() for _ in range(30)], {}
    for _ in range(groups):
        hub = [word() for _ in range(draw.randint(length // 2, length))] + passage
        for n in range(each):
            copy = list(hub)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = word()
            texts[len(texts)] = " ".join(copy)
            if n % 3 == 2:
                hub = copy
    return texts


@pytest.mark.parametrize("percent, leaf", [(85, 32), (85, 1), (80, 1)])
def test_ngram_join(spark, percent, leaf):
    texts = near_copies(3, 6, 14, 90)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    found = by_id(ngram_join.mark_groups(docs, 4, percent, leaf))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == components_of(texts, 4, percent)


def test_ngram_join_documents(spark, texts):
    found = by_id(QUERIES["op10_ngram_join"](spark, SF_DIR))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == components_of(texts, 4, 85)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    expected = {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 160)}, 200: 199}
    assert {r["node"]: r["label"] for r in found} == expected


def test_line_dedup(spark):
    """Short lines in runs of three; lines of many words alone or in pairs, as single lines of a document too."""
    draw = random.Random(4)
    long = [" ".join(f"w{draw.randint(0, 9)}" for _ in range(n)) for n in (30, 30, 49, 50, 60, 60)]
    pools = [["a", "b", "", "c", " "]] * 60 + [["a", "", "\t x", *long]] * 60
    texts = {i: "\n".join(draw.choice(pool) for _ in range(draw.randint(0, 14))) for i, pool in enumerate(pools)}
    texts |= {200: long[4] + " once", 201: long[4] + " once", 202: long[0] + " pair\n" + long[1], 203: "x\n" + long[0] + " pair\n\n" + long[1]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    found = by_id(line_dedup.remove_repeats(docs))
    first = {}
    for i in sorted(texts):
        lines = texts[i].split("\n")
        solid = [n for n, line in enumerate(lines) if line.strip(" ")]
        gone = set()
        for at in range(len(solid)):
            for size in (1, 2, 3):
                run = tuple(lines[n] for n in solid[at:at + size])
                words = sum(len(re.findall("[^ \t]+", line)) for line in run)
                if len(run) < size or (size < 3 and words < 50):
                    continue
                where = first.setdefault(run, (i, at))
                if where[0] != i or at >= where[1] + size:
                    gone |= set(solid[at:at + size])
        assert found[i]["text"] == "\n".join(line for n, line in enumerate(lines) if n not in gone)
        assert (found[i]["n_lines"], found[i]["n_removed"]) == (len(solid), len(gone))
    assert (found[201]["n_removed"], found[203]["text"]) == (1, "x\n")


def test_chat_format(spark):
    found = QUERIES["op9_chat_format"](spark, SF_DIR)
    rate = found.groupBy("held_out").agg(F.avg(F.col("right").cast("int")).alias("rate")).collect()
    assert all(r["rate"] > 0.7 for r in rate)


def test_chat_blocks_do_not_change_the_path(spark):
    talks = table(spark, SF_DIR, "conversations")
    lines, model = chat_format.transcripts(talks), chat_format.taught(talks)
    whole, cut = ({(r[0], r[1]): r[2:] for r in chat_format.recover(lines, model, b).collect()} for b in (1 << 40, 1 << 20))
    assert whole == cut


def test_pipeline(spark, texts):
    found = corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().collect()
    good = {i for i, r in by_id(QUERIES["op4_quality"](spark, SF_DIR)).items() if r["predicted"] == 1}
    latest = {texts[i]: i for i in sorted(good)}
    kept = {i: texts[i] for i in latest.values()}
    groups = components_of(kept, 5, 80)
    kept = {i: t for i, t in kept.items() if groups[i][1] == i}
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    dirty = {i for i, r in decontaminated(kept, bench).items() if r[4]}
    assert {r["doc_id"] for r in found} == set(kept) - dirty
