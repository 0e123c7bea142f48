import json
from dataclasses import replace

import pytest
from conftest import a_rows, b_rows, day
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.operators import deltas, match, outbox, state
from twinsync.rules import CONTACT_RULES, CONTACTS, SYSTEM_A, SYSTEM_B, FieldRule


def updates(matched, target, **options):
    rows = deltas.deltas_long(deltas.field_deltas(matched, target, **options), target).collect()
    return {(r["field"], r["value"]) for r in rows}


def pair(spark, a, b):
    email = {"id": "1", "email": "x@y.z"}
    return match.match_records(
        a_rows(spark, {**email, "modified": day(1), **a}), b_rows(spark, {**email, "modified": day(1), **b})
    )


@pytest.mark.parametrize("have_a, have_b, to_a, to_b", [
    ("x", "y", set(), set()),
    (None, "y", {("firstname", "y")}, set()),
    ("x", None, set(), {("firstname", "x")}),
    (None, None, set(), set()),
    ("", "y", set(), set()),  # an empty string is a value
])
def test_fill_if_missing(spark, have_a, have_b, to_a, to_b):
    matched = pair(spark, {"firstname": have_a}, {"firstname": have_b})
    assert (updates(matched, SYSTEM_A), updates(matched, SYSTEM_B)) == (to_a, to_b)


def test_fill_with_empty_as_missing(spark):
    matched = pair(spark, {"firstname": ""}, {"firstname": "y"})
    assert updates(matched, SYSTEM_A, empty_is_null=True) == {("firstname", "y")}
    assert updates(pair(spark, {"firstname": None}, {"firstname": ""}), SYSTEM_A, empty_is_null=True) == set()


@pytest.mark.parametrize("have_a, have_b, to_a, to_b", [
    ("x", "y", {("phone", "y")}, {("telephone1", "x")}),  # either side gets the other's value
    ("x", "x", set(), set()),
    (None, "y", set(), set()),
    ("x", None, set(), set()),
])
def test_overwrite(spark, have_a, have_b, to_a, to_b):
    matched = pair(spark, {"phone": have_a}, {"telephone1": have_b})
    assert (updates(matched, SYSTEM_A), updates(matched, SYSTEM_B)) == (to_a, to_b)


@pytest.mark.parametrize("day_a, day_b, to_a, to_b", [
    (2, 1, set(), {("telephone1", "x")}), (1, 2, {("phone", "y")}, set()), (1, 1, set(), {("telephone1", "x")}),
])
def test_newest_wins(spark, day_a, day_b, to_a, to_b):
    matched = pair(spark, {"phone": "x", "modified": day(day_a)}, {"telephone1": "y", "modified": day(day_b)})
    assert updates(matched, SYSTEM_A, conflict="newest") == to_a
    assert updates(matched, SYSTEM_B, conflict="newest") == to_b


def test_directions(spark):
    matched = pair(spark, {"jobtitle": "x", "company": "c"}, {"jobtitle": "y", "company": None})
    assert updates(matched, SYSTEM_A) == {("jobtitle", "y")}
    assert updates(matched, SYSTEM_B) == {("company", "c")}


def test_rules_without_a_side_are_skipped(spark):
    matched = pair(spark, {"phone": "x"}, {"telephone1": "y"})
    rules = (FieldRule("mobilephone", "mobilephone", None), FieldRule("phone", "phone", "telephone1"))
    assert updates(matched, SYSTEM_A, entity=replace(CONTACTS, rules=rules)) == {("phone", "y")}
    with pytest.raises(ValueError):
        deltas.updates_for(SYSTEM_A, entity=replace(CONTACTS, rules=rules[:1]))
    with pytest.raises(ValueError):
        deltas.updates_for(SYSTEM_A, conflict="oldest")


def test_fills_settle(spark):
    """Values filled on one side leave nothing to fill."""
    fills = replace(CONTACTS, rules=tuple(r for r in CONTACT_RULES if r.strategy == "fill_if_missing"))
    after = pair(spark, {"firstname": "y", "lastname": "l"}, {"firstname": "y", "lastname": "l"})
    assert updates(after, SYSTEM_A, entity=fills) == set()


def test_outbox_rows(spark):
    matched = pair(spark, {"phone": 'q"\\', "jobtitle": "a"}, {"telephone1": "ü\n", "jobtitle": "b"})
    built = deltas.build_outbox(deltas.field_deltas(matched, SYSTEM_A), SYSTEM_A)
    row = built.first()
    assert json.loads(row["payload"]) == {"phone": "ü\n", "jobtitle": "b"}
    assert list(json.loads(row["payload"])) == ["phone", "jobtitle"]
    assert (row["a_id"], row["status"], row["attempt"], row["last_attempt_ts"]) == ("1", "PENDING", 0, None)
    assert [(f.name, f.dataType) for f in built.schema] == [(f.name, f.dataType) for f in schemas.outbox(SYSTEM_A)]


@pytest.fixture
def box(spark):
    rows = [
        ("u1", "1", '{"x":"1"}', "PENDING", 0, None), ("u2", "2", '{"x":"2"}', "PENDING", 1, day(1)),
        ("u3", "3", '{"x":"3"}', "PENDING", 0, None), ("u4", "4", "", "PENDING", 0, None),
        ("u5", None, '{"x":"5"}', "PENDING", 0, None), ("u6", "", None, "PENDING", 0, None),
        ("u7", "7", '{"x":"7"}', "SUCCESS", 1, day(1)), ("u8", "8", '{"x":"8"}', "FAILED", 1, day(1)),
    ]
    return spark.createDataFrame(rows, schemas.outbox(SYSTEM_A))


def results(spark, *rows):
    return spark.createDataFrame(list(rows), "a_id string, http_code int, message string")


def test_next_batch(box):
    batch = outbox.next_batch(box, SYSTEM_A, size=5)
    assert [r["unified_contact_id"] for r in batch.rows.orderBy("unified_contact_id").collect()] == ["u1", "u3", "u4", "u5", "u6"]
    requests = {r["a_id"]: r["properties"] for r in batch.requests.collect()}
    assert requests == {"1": {"x": "1"}, "3": {"x": "3"}, "4": {}}
    assert {r["unified_contact_id"] for r in batch.undeliverable.collect()} == {"u5", "u6"}
    assert outbox.next_batch(box, SYSTEM_A, size=None).rows.count() == 6
    assert {r["unified_contact_id"] for r in outbox.undeliverable(outbox.pending(box), SYSTEM_A).collect()} == {"u5", "u6"}


def test_apply_results(spark, box):
    told = results(spark, ("1", 204, "ok"), ("2", 503, "busy"), ("3", 400, "bad"), ("7", 400, "late"), (None, 200, "?"))
    after = {r["unified_contact_id"]: (r["status"], r["attempt"], r["last_attempt_ts"]) for r in
             outbox.apply_results(box, told, SYSTEM_A, day(9)).collect()}
    assert after == {
        "u1": ("SUCCESS", 1, day(9)), "u2": ("PENDING", 2, day(9)), "u3": ("FAILED", 1, day(9)),
        "u4": ("PENDING", 0, None), "u5": ("FAILED", 0, None), "u6": ("FAILED", 0, None),
        "u7": ("SUCCESS", 1, day(1)), "u8": ("FAILED", 1, day(1)),
    }


def test_an_id_equal_to_a_unified_id_is_no_match(spark, box):
    after = outbox.apply_results(box, results(spark, ("u5", 200, "ok")), SYSTEM_A, day(9))
    assert after.where("unified_contact_id = 'u5'").first()["status"] == "FAILED"


def test_two_results_for_one_id_fail(spark, box):
    told = results(spark, ("1", 200, "ok"), ("1", 500, "no"))
    with pytest.raises(Exception, match="two rows of the results share a key"):
        outbox.apply_results(box, told, SYSTEM_A, day(9)).collect()


def stored_at(tmp_path, spark):
    def store(rows):
        rows.write.mode("overwrite").parquet(str(tmp_path / "placed"))
        return spark.read.parquet(str(tmp_path / "placed"))

    return store


def test_batches_are_numbered_in_the_order_of_pushes(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 7).select(
        F.sha2(F.col("id").cast("string"), 256).alias("unified_contact_id"), F.col("id").cast("string").alias("a_id"),
        F.lit("{}").alias("payload"), F.lit("PENDING").alias("status"), (F.col("id") % 3).cast("int").alias("attempt"),
        F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).cast("timestamp_ntz").alias("last_attempt_ts"),
    )
    got = outbox.number_batches(rows, 90, stored_at(tmp_path, spark)).collect()
    order = sorted(got, key=lambda r: (r["attempt"], r["last_attempt_ts"] is not None, r["unified_contact_id"]))
    assert [r["batch"] for r in order] == [n // 90 for n in range(1000)]
    assert outbox.number_batches(rows.where("false"), 90, stored_at(tmp_path, spark)).isEmpty()
    with pytest.raises(ValueError):
        outbox.number_batches(rows, 0, stored_at(tmp_path, spark))


def test_batch_results(spark, box, tmp_path):
    """A result holds for its whole batch; a batch without one stays as it is."""
    sent = outbox.deliverable(outbox.pending(box), SYSTEM_A)
    batches = outbox.number_batches(sent, 2, stored_at(tmp_path, spark))
    requests = {r["batch"]: r for r in outbox.batch_requests(batches, SYSTEM_A).collect()}
    assert [requests[n]["records"] for n in sorted(requests)][0] == 2
    first = json.loads(requests[0]["body"])["inputs"]
    assert [sorted(r) for r in first] == [["id", "properties"]] * 2
    results = spark.createDataFrame([(0, 200, "ok"), (1, 503, "busy"), (None, 200, "none")], "batch bigint, http_code int, message string")
    pushed = outbox.batch_outcomes(batches, results)
    after = {r["unified_contact_id"]: r for r in outbox.settle(box, pushed, SYSTEM_A, day(9)).collect()}
    code = {r["unified_contact_id"]: r["http_code"] for r in pushed.collect()}
    assert {after[u]["status"] for u, c in code.items() if c == 200} == {"SUCCESS"}
    assert {(after[u]["status"], after[u]["last_attempt_ts"]) for u, c in code.items() if c == 503} == {("PENDING", day(9))}
    audit = {r["http_code"]: r for r in state.audit_pushed_batches(pushed, SYSTEM_A, day(9)).collect()}
    assert (audit[200]["status"], audit[200]["message"]) == ("SUCCESS", "Pushed 2 records")
    assert (audit[503]["status"], audit[503]["message"]) == ("FAILED", "busy")
    with pytest.raises(Exception, match="share a key"):
        outbox.batch_outcomes(batches, results.union(results)).collect()


def test_audit_and_letters(spark, box):
    told = results(spark, ("1", 204, "ok"), ("2", 503, "busy"), ("3", 400, "bad"))
    pushed = outbox.outcomes(box, told, SYSTEM_A)
    audit = state.audit_pushed_records(pushed, SYSTEM_A, day(9))
    assert [(f.name, f.dataType) for f in audit.schema] == [(f.name, f.dataType) for f in schemas.AUDIT_LOG]
    assert [(r["status"], r["message"], r["payload"]) for r in audit.orderBy("message").collect()] == [
        ("SUCCESS", "Patched 1", None), ("FAILED", "bad", '{"x":"3"}'), ("FAILED", "busy", '{"x":"2"}'),
    ]
    letters = state.failed_letters(pushed, SYSTEM_A, day(9))
    assert [(f.name, f.dataType) for f in letters.schema] == [(f.name, f.dataType) for f in schemas.DEAD_LETTER]
    assert [(r["key"], r["reason"]) for r in letters.collect()] == [("u3", "bad")]


def test_rows_without_an_id_spread_over_the_join(spark):
    """Half of the outbox has no target id; without a broadcast its rows still reach every partition."""
    rows = spark.range(4000).select(
        F.concat(F.lit("u"), "id").alias("unified_contact_id"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("a_id"),
        F.lit("{}").alias("payload"), F.lit("PENDING").alias("status"), F.lit(0).alias("attempt"),
        F.lit(None).cast("timestamp_ntz").alias("last_attempt_ts"),
    )
    told = spark.range(0, 4000, 4).select(F.col("id").cast("string").alias("a_id"), F.lit(200).alias("http_code"), F.lit("").alias("message"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        after = outbox.apply_results(rows, told, SYSTEM_A, day(9))
        sizes = after.where("a_id is null").groupBy(F.spark_partition_id()).count().collect()
        counts = {r["status"]: r["count"] for r in after.groupBy("status").count().collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert counts == {"SUCCESS": 1000, "FAILED": 2000, "PENDING": 1000}
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 700


def test_rows_to_try_again_block_no_others(spark):
    rows = [(f"u{i:03}", str(i), "{}", "PENDING", 0, None) for i in range(7)]
    box = spark.createDataFrame(rows, schemas.outbox(SYSTEM_A))
    told = results(spark, *((str(i), 503, "busy") for i in range(5)))
    after = outbox.apply_results(box, told, SYSTEM_A, day(9))
    assert {r["a_id"] for r in outbox.take_pending(after, 2).collect()} == {"5", "6"}
    assert outbox.next_batch(after, SYSTEM_A).rows.count() == 7


def test_an_unreadable_patch_fails_with_a_letter(spark):
    rows = [("u1", "1", '{"x":', "PENDING", 0, None), ("u2", "2", " ", "PENDING", 0, None)]
    box = spark.createDataFrame(rows, schemas.outbox(SYSTEM_A))
    batch = outbox.next_batch(box, SYSTEM_A)
    assert [r["a_id"] for r in batch.requests.collect()] == ["2"]
    letter = state.undeliverable_letters(batch.undeliverable, SYSTEM_A, day(9)).first()
    assert (letter["key"], letter["reason"], letter["payload"]) == ("u1", "Unreadable payload", '{"x":')
    after = outbox.apply_results(box, results(spark, ("1", 200, "ok")), SYSTEM_A, day(9))
    assert after.where("a_id = '1'").first()["status"] == "FAILED"
