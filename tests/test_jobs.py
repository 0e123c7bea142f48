"""Tables, the whole job and the streams."""

import json
from datetime import datetime

import pytest
from conftest import as_dicts, day
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.operators import snapshot, state
from twinsync.plans import sync_job
from twinsync.rules import SYSTEM_A, SYSTEM_B, Entity, FieldRule, System
from twinsync.session import work_folder
from twinsync.sources import landing
from twinsync.sources.tables import Tables
from twinsync.streaming import incremental


def landed(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "raw string")


def record_a(id_, time, **properties):
    return {"id": id_, "properties": {"modified": time, **properties}}


def record_b(id_, time, **properties):
    return {"id": id_, "modified": time, **properties}


def test_parse_and_sort_out(spark):
    rows = landed(
        spark,
        record_a("1", "2024-01-02T00:00:00Z", email="x@y.z", lifecyclestage="lead"),
        record_a("2", "2024-01-01T00:00:00Z"),
        record_a("3", "soon"),
        record_a(None, "2024-01-02T00:00:00Z"),
        '{"id": "5", "prop',
        {"id": "6"},
    )
    parsed = landing.parse_records(rows, SYSTEM_A, day(9))
    kept = landing.accepted_records(parsed, SYSTEM_A)
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in schemas.bronze(SYSTEM_A)]
    assert {r["a_id"] for r in kept.collect()} == {"1", "2", "6"}
    assert {r["a_id"] for r in landing.accepted_records(parsed, SYSTEM_A, day(2)).collect()} == {"1"}
    first = kept.where("a_id = '1'").first()
    assert (first["email"], first["lifecyclestage"], first["phone"]) == ("x@y.z", "lead", None)
    assert json.loads(first["raw"])["id"] == "1"
    letters = landing.rejected_letters(landing.sort_out(parsed, SYSTEM_A, day(2)), SYSTEM_A, day(9))
    assert sorted((r["reason"], r["key"] or "") for r in letters.collect()) == [
        ("Missing modified time", "6"), ("Missing record id", ""), ("No document", ""), ("Unreadable modified time", "3"),
    ]


WHOLE = '{"id":"1","properties":{"modified":"2024-01-01"}}'


@pytest.mark.parametrize("text, fault", [
    (WHOLE, None), (f" {WHOLE}\n ", None), ("{}", None), ('{"id":"1","_end":"x"}', None),
    (f"{WHOLE} {WHOLE}", landing.MORE_TEXT), (f"{WHOLE},{WHOLE}", landing.MORE_TEXT), (f"{WHOLE}\n{WHOLE}", landing.MORE_TEXT),
    (f"{WHOLE}]", landing.MORE_TEXT), (f'{WHOLE},{{"_end":"5"}}]', landing.MORE_TEXT), (f"{WHOLE}}}", landing.MORE_TEXT),
    (f"{WHOLE} junk", landing.MORE_TEXT), (f"{WHOLE},", landing.MORE_TEXT),
    ("", landing.NO_DOCUMENT), ("junk", landing.NO_DOCUMENT), (None, landing.NO_DOCUMENT), (WHOLE[:-5], landing.NO_DOCUMENT),
    ("[]", landing.NO_DOCUMENT), (f"[{WHOLE}]", landing.NO_DOCUMENT), ("]", landing.NO_DOCUMENT), ("1", landing.NO_DOCUMENT),
])
def test_a_text_is_one_document(spark, text, fault):
    row = landing.parse_records(spark.createDataFrame([(text,)], "raw string"), SYSTEM_A, day(1)).first()
    assert row["fault"] == fault and row["raw"] == text
    assert fault is None or row["a_id"] is None


def test_pages(spark):
    """Records in a list within a page, under names of the system's own."""
    system = System(
        "a", "a_id", "a_modified", "email", ("email", "phone"), nested="fields",
        json_names={"a_id": "record.id", "a_modified": "@changed", "phone": "tel"}, records_at=("data", "items"),
    )
    record = lambda n: {"record.id": n, "fields": {"@changed": f"2024-01-0{n}", "tel": f"+{n}", "email": "e"}}
    pages = landed(
        spark, {"data": {"items": [record(1), record(2), None, 5], "next": {"link": "x"}}}, {"data": {"items": []}},
        {"data": {"items": None}}, {"other": 1}, "junk", '{"data":{"items":[]}} {}',
    )
    rows = landing.parse_pages(pages, system, day(9))
    assert [(r["a_id"], r["a_modified"], r["phone"]) for r in landing.kept(landing.sort_out(rows, system), system).orderBy("a_id").collect()] == [
        ("1", day(1), "+1"), ("2", day(2), "+2"),
    ]
    assert sorted(r["fault"] for r in rows.where("fault is not null").collect()) == sorted(
        [landing.NO_DOCUMENT] * 3 + [landing.NO_LIST] * 2 + [landing.MORE_TEXT]
    )
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2  # of the page, and of its records


def test_each_text_is_parsed_once(spark):
    parsed = landing.parse_records(landed(spark, record_a("1", "x")), SYSTEM_A, day(1))
    plan = landing.accepted_records(parsed, SYSTEM_A, day(1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("wide"), F.lit(day(1).isoformat()).cast("timestamp_ntz").alias("t")).write.parquet(str(tmp_path / "t"))
    scan = landing.modified_since(spark.read.parquet(str(tmp_path / "t")), "t", day(2)).select("id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t," in plan
    assert "wide" not in plan
    assert landing.modified_since(scan, "t", None) is scan


def test_watermarks(spark):
    rows = spark.createDataFrame([
        ("contacts", "a", day(5), day(1)), ("contacts", "a", day(3), day(2)), ("contacts", "b", day(9), day(1)),
    ], schemas.WATERMARKS)
    assert state.watermark_of(rows, "contacts", "a", None) == day(3)  # written last, though it lies earlier
    assert state.watermark_of(rows, "contacts", "c", day(7)) == day(7)
    plan = state.watermark_current(rows)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan
    moved = state.watermark_advance(state.watermark_current(rows).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")), "contacts", {"b": day(10), "d": day(1)}, day(4))
    assert {(r["source"], r["watermark_ts"]) for r in moved.collect()} == {("a", day(3)), ("b", day(10)), ("d", day(1))}


def test_work_folder_is_under_the_shared_one(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def sync(tables, run_id, time, a, b):
    sync_job.sync_run(tables, landed(tables.spark, *a), landed(tables.spark, *b), run_id, time, datetime(2000, 1, 1))


FIRST_A = [record_a("a1", "2024-01-01T00:00:00Z", email="x@y.z", phone="1"), record_a("a2", "2024-01-01T00:00:00Z", email="only@a.z", lastname="L"), "junk"]
FIRST_B = [record_b("b1", "2024-01-01T00:00:00Z", emailaddress1="X@y.z", telephone1="2")]
SECOND_A = [record_a("a1", "2024-01-03T00:00:00Z", email="x@y.z", phone="3"), record_a("a9", "1999-01-01T00:00:00Z", email="old@a.z")]
SECOND_B = [record_b("b2", "2024-01-03T00:00:00Z", emailaddress1="only@a.z")]


def state_of(tables):
    states = {n: tables.state(n) for n in tables.keys}
    logs = {n: tables.log(n) for n in schemas.TABLES if n not in states}
    return {n: sorted(map(repr, df.collect())) for n, df in {**logs, **states}.items()}


def test_job_over_two_runs(spark, tables):
    sync(tables, 1, day(2), FIRST_A, FIRST_B)
    assert {r["a_id"]: r["b_id"] for r in tables.state("silver/crosswalk").collect()} == {"a1": "b1", "a2": None}
    assert json.loads(sync_job.next_push(tables, SYSTEM_A).rows.first()["payload"]) == {"email": "X@y.z", "phone": "2"}
    letters = as_dicts(tables.log("meta/dead_letter"))
    assert [(r["system"], r["reason"], r["payload"]) for r in letters] == [("a", "No document", "junk")]

    sync(tables, 2, day(4), SECOND_A, SECOND_B)
    once = state_of(tables)
    assert {r["a_id"] for r in tables.state("silver/a_snapshot").collect()} == {"a1", "a2"}  # a9 lies before the position
    assert tables.state("silver/a_snapshot").where("a_id = 'a1'").first()["phone"] == "3"
    past = sync_job.full_history(tables)
    assert past.count() == 3
    assert past.where("not is_current").first()["valid_to"] == day(4)
    assert past.where("is_current").count() == 2
    marks = sync_job.state.watermark_of(tables.state("meta/watermarks"), "contacts", "a", None)
    assert marks == datetime(2024, 1, 3)
    audit = {(r["system"], r["message"]) for r in tables.log("meta/audit_log").collect()}
    assert audit == {("a", "Ingested 2 records"), ("b", "Ingested 1 records"), ("a", "Ingested 1 records")}

    sync(tables, 2, day(4), SECOND_A, SECOND_B)  # done before
    assert state_of(tables) == once
    with pytest.raises(ValueError, match="run ids must grow"):
        sync(tables, 1, day(4), SECOND_A, SECOND_B)
    tables.verify()

    results = spark.createDataFrame([("b1", 204, "ok")], "b_id string, http_code int, message string")
    after = sync_job.take_results(tables, results, SYSTEM_B, 3, day(5))
    assert {(r["b_id"], r["status"]) for r in after.collect()} == {("b1", "SUCCESS"), ("b2", "PENDING")}
    assert sync_job.next_push(tables, SYSTEM_B).rows.count() == 1


def test_run_without_news_adds_no_version(spark, tables):
    sync(tables, 1, day(2), FIRST_A, FIRST_B)
    before = sync_job.full_history(tables).count()
    sync(tables, 2, day(4), [], [])
    assert sync_job.full_history(tables).count() == before
    assert tables.state("silver/a_snapshot").count() == 2
    assert {r["updated_at"] for r in tables.state("meta/watermarks").collect()} == {day(2)}  # no rows, no move


def test_streams_take_new_files_only_and_equal_the_batch(spark, tables, tmp_path):
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    batches = [
        landed(spark, record_a("1", "2024-01-01T00:00:00Z", email="x"), record_a("2", "2024-01-01T00:00:00Z")),
        landed(spark, record_a("1", "2024-01-02T00:00:00Z", email="y"), "junk"),
        landed(spark, record_a("2", "2023-01-01T00:00:00Z", email="late")),
    ]
    for count, batch in enumerate(batches, start=1):
        incremental.land_text(batch.coalesce(1), folder)
        bronze = incremental.stream_ingest(tables, folder, checkpoint + "/b", SYSTEM_A, day(9), files_per_batch=1)
        snap = incremental.stream_snapshot(tables, folder, checkpoint + "/s", SYSTEM_A, day(9))
        seen = batches[0]
        for other in batches[1:count]:
            seen = seen.unionByName(other)
        expected = landing.accepted_records(landing.parse_records(seen, SYSTEM_A, day(9)), SYSTEM_A)
        assert sorted(map(repr, bronze.collect())) == sorted(map(repr, expected.collect()))
        latest = snapshot.snapshot(expected, SYSTEM_A)
        assert sorted(map(repr, snap.collect())) == sorted(map(repr, latest.collect()))
    assert tables.log("meta/dead_letter").count() == 1
    again = incremental.stream_ingest(tables, folder, checkpoint + "/b", SYSTEM_A, day(9))
    assert again.count() == bronze.count()
    anew = incremental.stream_ingest(tables, folder, checkpoint + "/new", SYSTEM_A, day(9))
    assert anew.count() == 2 * bronze.count()  # nothing is lost; the snapshot takes in doubles
    assert incremental.stream_snapshot(tables, folder, checkpoint + "/new-s", SYSTEM_A, day(9)).count() == 2
    tables.verify()


def test_many_values_are_rebalanced(spark, tables):
    """Two thirds of the rows share a date; still one file or few per date, and no row is lost."""
    rows = spark.range(0, 3000, 1, 16).select("id", F.expr("date_add(date'2024-01-01', if(id % 3 = 0, int(id % 20), 0))").alias("load_date"))
    written = tables.append("bronze/x", rows, ["load_date"], many_values=True)
    assert written.count() == 3000
    assert len(written.inputFiles()) <= 4 * 20


def test_partitions_are_pruned(spark, tables):
    rows = landed(spark, record_a("1", "2024-01-01T00:00:00Z"), record_a("2", "never"))
    batch = landing.sort_out(landing.parse_records(rows, SYSTEM_A, day(9)), SYSTEM_A)
    stored = tables.append("bronze/a_raw", batch, ("rejected", "load_date"))
    plan = landing.kept(stored, SYSTEM_A)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rejected" in plan
    assert landing.kept(tables.log("bronze/a_raw"), SYSTEM_A).count() == 1


def test_another_entity(spark, tmp_path):
    """Companies, with systems and rules of their own, through the same job."""
    left = System("a", "a_company", "a_changed", "mail", ("mail", "title", "size"), nested="properties")
    right = System("b", "b_account", "b_changed", "mail", ("mail", "name", "staff"))
    rules = (FieldRule("title", "title", "name", "bi", "overwrite"), FieldRule("size", "size", "staff", "to_b", "fill_if_missing"))
    tables = Tables(spark, str(tmp_path / "companies"), Entity("companies", left, right, rules))
    a = [record_a("1", "2024-01-01T00:00:00Z", mail="info@x.y", title="X", size="5")]
    b = [record_b("9", "2024-01-01T00:00:00Z", mail="INFO@x.y", name="Y")]
    sync_job.sync_run(tables, landed(spark, *a), landed(spark, *b), 1, day(2))
    assert tables.state("silver/crosswalk").select("a_company", "b_account").first() == ("1", "9")
    assert json.loads(tables.state("gold/b_outbox").first()["payload"]) == {"name": "X", "staff": "5"}
    assert json.loads(tables.state("gold/a_outbox").first()["payload"]) == {"title": "Y"}
    assert sync_job.full_history(tables).first()["size"] == "5"
    assert {r["entity"] for r in tables.log("meta/audit_log").collect()} == {"companies"}


def test_a_record_without_a_time_is_rejected_only_beside_a_position(spark):
    rows = landing.parse_records(landed(spark, {"id": "1", "properties": {"email": "a@b.c"}}), SYSTEM_A, day(9))
    assert landing.accepted_records(rows, SYSTEM_A).count() == 1
    letters = landing.rejected_letters(landing.sort_out(rows, SYSTEM_A, day(1)), SYSTEM_A, day(9))
    assert [(r["key"], r["reason"]) for r in letters.collect()] == [("1", "Missing modified time")]
