import json

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from twinsync.operators import lookups, translate, upsert
from twinsync.sources import landing

GUID = "0123456789abcdef0123456789abcdef"


def translated(spark, payload, **options):
    box = spark.createDataFrame([("u1", "1", payload)], "unified_contact_id string, b_id string, payload string")
    return json.loads(translate.translate_payload(box, **options).first()["payload"])


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("colour", "Red", 1), ("colour", "Blue", 2), ("size", "Red", 9)], "option_set string, label string, code bigint"
    )


@pytest.mark.parametrize("limit", [10**9, 0])  # broadcast, and the way beyond it
@pytest.mark.parametrize("payload, expected", [
    ({"c": "Red", "x": "Red"}, {"c": 1, "x": "Red"}),
    ({"c": "Green"}, {"c": "Green"}),
    ({"c": None, "s": "Red"}, {"c": None, "s": 9}),
    ({"c": 7, "x": 1.5, "y": True}, {"c": 7, "x": 1.5, "y": True}),
    ({"parent": GUID, "c": "Blue"}, {"parent@odata.bind": f"/accounts({GUID})", "c": 2}),
    ({"parent": GUID[:31]}, {"parent": GUID[:31]}),
    ({"parent": None}, {"parent": None}),
    ({}, {}),
])
def test_translate(spark, dim, limit, payload, expected):
    got = translated(
        spark, json.dumps(payload), option_dim=dim, option_sets={"c": "colour", "s": "size"},
        lookups={"parent": "accounts"}, broadcast_bytes=limit,
    )
    assert got == expected
    assert list(got) == list(expected)


@pytest.mark.parametrize("payload", [None, ""])
def test_translate_nothing(spark, payload):
    assert translated(spark, payload, lookups={"parent": "accounts"}) == {}


def test_option_set_wins_over_lookup(spark, dim):
    got = translated(spark, json.dumps({"c": GUID}), option_dim=dim, option_sets={"c": "colour"}, lookups={"c": "accounts"})
    assert got == {"c": GUID}


def test_fits_broadcast_measures(spark, dim):
    assert lookups.fits_broadcast(dim, 1000)
    assert not lookups.fits_broadcast(dim, 100)
    assert lookups.fits_broadcast(dim.where("false"), 0)


def test_shuffled_lookup_spreads_hot_and_missing_keys(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("u"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("k"))
    side = spark.createDataFrame([("hot", 1), ("cold", 2)], "label string, code int")
    joined = lookups.left_lookup(rows, side, F.col("k"), "u", broadcast=False)
    assert joined.columns == ["u", "k", "code"]
    assert {(r["code"], r["count"]) for r in joined.groupBy("code").count().collect()} == {(1, 2000), (None, 1000)}


def test_option_set_dimension(spark):
    def option(value, *labels):
        return {"Value": value, "Label": {"LocalizedLabels": [{"Label": text} for text in labels]}}

    documents = [
        {"Name": "s", "Options": [option(1, "One", "Uno"), option(2, "Two"), option(3, "One"), option(4)]},
        {"Name": "t", "Options": [option(5, "One")]},
        {"Name": "e", "Options": []},
    ]
    raw = spark.createDataFrame([(json.dumps(d),) for d in documents], "raw string")
    got = {(r["option_set"], r["label"]): r["code"] for r in landing.option_set_dimension(raw).collect()}
    assert got == {("s", "One"): 3, ("s", "Two"): 2, ("t", "One"): 5}


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k1 string, k2 int, v string")


def test_upsert(spark):
    target = frame(spark, ("a", 1, "old"), ("a", 2, "stays"), (None, 1, "null key"), ("d", 1, "twice"), ("d", 1, "again"))
    source = frame(spark, ("a", 1, "new"), ("b", 1, "added"), (None, 1, "other null key"), ("d", 1, None))
    got = as_dicts(upsert.upsert_by_key(target, source, ["k1", "k2"]), "k1", "k2", "v")
    assert [tuple(r.values()) for r in got] == [
        (None, 1, "null key"), (None, 1, "other null key"),
        ("a", 1, "new"), ("a", 2, "stays"), ("b", 1, "added"), ("d", 1, None), ("d", 1, None),
    ]


def test_upsert_rejects_duplicate_source_keys(spark):
    target = frame(spark, ("a", 1, "old"))
    source = frame(spark, ("b", 1, "x"), ("b", 1, "y"))
    with pytest.raises(Exception, match="two rows of the source share a key"):
        upsert.upsert_by_key(target, source, ["k1", "k2"]).collect()


def test_upsert_reads_each_side_once(spark, tmp_path):
    frame(spark, ("a", 1, "old")).write.parquet(str(tmp_path / "t"))
    frame(spark, ("b", 1, "x")).write.parquet(str(tmp_path / "s"))
    merged = upsert.upsert_by_key(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["k1", "k2"])
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_upsert_spreads_rows_without_a_key(spark):
    rows = spark.range(3000).select(F.lit(None).cast("string").alias("k1"), F.lit(1).alias("k2"), F.col("id").cast("string").alias("v"))
    merged = upsert.upsert_by_key(rows, rows, ["k1", "k2"])
    assert merged.count() == 6000
    twice = rows.limit(5).union(rows.limit(5))
    assert upsert.upsert_by_key(twice, twice, ["k1", "k2"]).count() == 20


def test_upsert_into_nothing(spark):
    source = frame(spark, ("b", 1, "x"))
    assert upsert.upsert_by_key(frame(spark, ("z", 0, "")).where("false"), source, ["k1", "k2"]).count() == 1


def test_a_binding_that_meets_its_own_name_and_unreadable_patches(spark):
    long, old = "i" * 32, "/accounts(old)"
    texts = [f'{{"c@odata.bind":"{old}","c":"{long}"}}', f'{{"c":"{long}","c@odata.bind":"{old}"}}', '{"c":']
    box = spark.createDataFrame([(f"u{i}", str(i), t) for i, t in enumerate(texts)], "unified_contact_id string, b_id string, payload string")
    got = [r["payload"] for r in translate.bind_lookups(box, {"c": "accounts"}).orderBy("b_id").collect()]
    assert [json.loads(t) for t in got[:2]] == [{"c@odata.bind": f"/accounts({long})"}, {"c@odata.bind": old}]
    assert got[2] == '{"c":'
