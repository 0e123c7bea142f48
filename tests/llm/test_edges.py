"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from twinsync.llm import (
    chat_format, decontamination, exact_dedup, language, line_dedup, lm_scoring, ngram_join, packing, quality, sharding,
)
from twinsync.llm.common import stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "\n".join(f"line {i} of a very long text about shuffles and spills" for i in range(4000))
ROWS = [
    (1, None, None), (2, "", "en"), (3, "   \n\t", "en"), (4, "the same words as before stand here again", "en"),
    (5, "the same words as before stand here again", None), (5, "the same words as before stand here again", None),
    (6, LONG, "en"), (7, "1234 5678", "de"), (None, "a row without an id has a text", "fr"),
    (None, "the same words as before stand here again", "fr"), (8, "été", "fr"), (9, "\U0001f600 \x00   x", "en"),
]
LABELS = [(4, 1), (5, 0), (6, 1), (6, 1), (None, 0), (7, None), (99, 0)]
BENCH = [("b", "the same words as before stand"), ("a", "here again"), (None, "été"), ("c", None), ("d", "")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id bigint, text string, lang string")
    # Names that operators use inside; they must neither fail nor show.
    return rows.repartition(3).withColumns({
        c: F.lit("extra") for c in ("row", "name", "size", "key", "n", "label", "shard", "score", "piece", "block", "id", "count", "doc", "sha", "t1",
        "_sha", "_t1", "_t2", "_stay_id", "_stay_doc_id")
    })


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCH, "item_id string, text string").withColumn("doc_id", F.lit("clash"))


def rows(df):
    return [r.asDict() for r in df.collect()]


def unspoilt(found):
    """The extra columns hold what they held."""
    return all(r[c] == "extra" for r in rows(found) for c in found.columns if c not in ("doc_id", "text", "lang"))


def test_exact_dedup(docs):
    found = rows(exact_dedup.mark_copies(docs))
    assert len(found) == len(ROWS)
    copies = [r for r in found if r["group_size"] == 4]
    assert sorted((r["doc_id"] or 0) for r in copies) == [0, 4, 5, 5]
    assert {r["keep_id"] for r in copies} == {5} and sum(r["kept"] for r in copies) == 1
    empty = [r for r in found if r["doc_id"] in (1, 2)]
    assert [r["keep_id"] for r in empty] == [2, 2]
    lone = [r for r in found if r["doc_id"] is None and r["group_size"] == 1]
    assert len(lone) == 1 and lone[0]["kept"] and lone[0]["keep_id"] is None
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns and unspoilt(left)
    assert sorted((r["doc_id"] or 0) for r in rows(left)) == [0, 2, 3, 5, 6, 7, 8, 9]


def test_sharding(docs):
    found = rows(sharding.shard_by_bytes(docs, shards=4))
    assert len(found) == len(ROWS)
    assert {r["size"] for r in found if r["doc_id"] in (1, 2)} == {1}
    for shard in {r["shard"] for r in found}:
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))


def test_packing(docs):
    found = rows(packing.pack(docs, TOKENIZER))
    assert [r["length"] for r in found if r["doc_id"] == 1] == [1]
    assert len([r for r in found if r["doc_id"] == 5]) == 2
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)
    assert max(r["offset"] + r["length"] for r in found) <= 1024


def test_decontamination(docs, benchmark):
    found = rows(decontamination.mark_contaminated(docs, benchmark))
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(ROWS) and by_id[1]["n_words"] == by_id[2]["n_words"] == 0 and not by_id[1]["contaminated"]
    assert (by_id[4]["n_hit"], by_id[4]["n_items"], by_id[4]["contaminated"]) == (8, 2, True)
    assert by_id[8]["n_items"] == 1 and by_id[8]["matches"][0]["item_id"] == "null"
    assert by_id[6]["n_hit"] == 0 and by_id[6]["n_words"] == 44000
    left = decontamination.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in rows(left)) == [0, 1, 2, 3, 6, 7, 9]


def test_quality(docs, labels):
    found = rows(quality.score(docs, labels))
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found)
    none = rows(quality.score(docs, labels.limit(0)))
    assert {r["score"] for r in none} == {0.5}
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_language(docs):
    found = rows(language.identify(docs, steps=5))
    assert len(found) == len(ROWS)
    for r in found:
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (1, 2, 3, 7)) and 0 <= r["score"] <= 1
    unknown = rows(language.identify(docs.withColumn("lang", F.lit(None).cast("string")), steps=5))
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}


def test_stored_steps_leave_no_shuffle_files(spark):
    def files():
        every = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (every.apply(i).getName() for i in range(every.size())) if name.startswith("shuffle_")}

    before = files()
    rows_in = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    kept = stored(rows_in, "test")
    until = time.monotonic() + 10  # files go in the background
    while (left := files() - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left and kept.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_lm_scoring(docs, labels):
    found = rows(lm_scoring.score(docs, labels.where("quality = 1")))
    assert len(found) == len(ROWS)
    assert {(r["n_tokens"], r["score"]) for r in found if r["doc_id"] in (1, 2, 3)} == {(0, 0.0)}
    assert all(r["score"] == r["score"] for r in rows(lm_scoring.score(docs, labels.limit(0))))


def test_line_dedup(docs):
    found = rows(line_dedup.digest(docs))
    assert len(found) == len(ROWS) and all(r["n_removed"] == 0 for r in found)
    twice = rows(line_dedup.digest(docs.where("doc_id = 6").union(docs.where("doc_id = 6"))))
    assert sorted(r["n_removed"] for r in twice) == [0, 4000]


def test_ngram_join(docs):
    found = rows(ngram_join.mark_groups(docs))
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0]
    assert [by_id[i]["component_id"] for i in (1, 2, 3, 4, 5, 6)] == [1, 2, 3, 4, 4, 6]
    assert sorted(str(r["component_id"]) for r in found if r["doc_id"] is None) == ["4", "None"]
    left = ngram_join.keep_one_of_each(docs)
    assert left.columns == docs.columns and unspoilt(left)
    assert sorted((r["doc_id"] or 0) for r in rows(left)) == [0, 1, 2, 3, 4, 6, 7, 8, 9]


def test_chat_format(spark):
    rows_in = [
        (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 1, "assistant", "a\nb"), (None, 0, "user", ""),
        (2, None, "robot", "beep"), (3, 0, None, "x"), (1, 0, "user", "hello"),
    ]
    talks = spark.createDataFrame(rows_in, "conv_id bigint, turn int, role string, text string").withColumn("block", F.lit(1))
    lines = chat_format.transcripts(talks)
    found = rows(chat_format.format_conversations(talks))
    assert len(found) == lines.count() and {r["role"] for r in found} <= set(chat_format.ROLES)
    assert all(r["opens"] for r in found if r["conv_id"] == 2)


def test_empty_tables(spark, docs, labels, benchmark):
    none = docs.limit(0)
    for df in (
        exact_dedup.mark_copies(none), exact_dedup.drop_copies(none), sharding.shard_by_bytes(none), packing.pack(none, TOKENIZER),
        decontamination.mark_contaminated(none, benchmark), quality.score(none, labels), language.identify(none),
        lm_scoring.score(none, labels), line_dedup.digest(none), ngram_join.mark_groups(none), ngram_join.keep_one_of_each(none),
    ):
        assert df.count() == 0
    clean = decontamination.mark_contaminated(docs, benchmark.limit(0))
    assert clean.count() == len(ROWS) and clean.where("contaminated").isEmpty()
    talks = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert chat_format.format_conversations(talks).count() == 0


@pytest.mark.parametrize("filled", [True, False])
def test_pipeline(spark, docs, labels, benchmark, tmp_path, filled):
    """Nulls, empty and long texts, repeated rows and clashing names through all stages; and tables without rows."""
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        (df if filled else df.limit(0)).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = rows(corpus_pipeline.run(spark, str(tmp_path)))
    assert {r["doc_id"] for r in found} <= {r[0] for r in ROWS} and bool(found) <= filled
    tokens = {}
    for r in found:
        tokens[r["sequence_id"]] = tokens.get(r["sequence_id"], 0) + r["length"]
    assert all(n <= 1024 for n in tokens.values())
