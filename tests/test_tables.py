"""Commits, buckets, several writers, and work in proportion to the news."""

import json
import threading
from datetime import datetime
from pathlib import Path

import pytest
from conftest import day
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_jobs import landed, record_a, record_b, state_of

from twinsync import schemas
from twinsync.operators import outbox
from twinsync.plans import sync_job
from twinsync.rules import SYSTEM_A, SYSTEM_B
from twinsync.sources import commits, landing
from twinsync.sources.tables import Tables, bucket_marks, bucket_of, marked_buckets
from twinsync.streaming import incremental

NAME = "silver/crosswalk"


def rows(spark, *ids):
    return spark.createDataFrame([(f"u{i}", f"{i}@x.y", str(i), None) for i in ids], schemas.CROSSWALK)


def ids(df):
    return sorted(int(r["a_id"]) for r in df.collect())


def files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_logs_and_states(spark, tables):
    assert tables.state(NAME).isEmpty() and tables.state(NAME).schema == schemas.CROSSWALK
    assert tables.log("meta/dead_letter").isEmpty()
    tables.replace(NAME, rows(spark, *range(50)))
    tables.replace(NAME, tables.state(NAME).where("a_id < '3'"))  # reads what it replaces
    assert ids(tables.state(NAME)) == [0, 1, 2, *range(10, 30)]
    letter = spark.createDataFrame([(day(1), "a", "contacts", "k", "r", "p")], schemas.DEAD_LETTER)
    for _ in range(2):
        tables.append("meta/dead_letter", letter, ("system", "entity"))
    assert tables.log("meta/dead_letter").count() == 2
    tables.verify()


def test_only_some_buckets_are_written(spark, tables):
    tables.replace(NAME, rows(spark, *range(200)))
    before = files(tables.root)
    bucket = rows(spark, 7).select(bucket_of(["unified_contact_id"], tables.buckets)).first()[0]
    held = tables.state(NAME, only={bucket})
    assert 0 < held.count() < 60
    tables.replace(NAME, held.where("a_id <> '7'"), only={bucket})
    assert ids(tables.state(NAME)) == [n for n in range(200) if n != 7]
    new = files(tables.root) - before
    assert new and all(f"/bucket={bucket}/" in name for name in new)
    tables.replace(NAME, held.where("false"), only={bucket})  # a bucket may become empty
    assert tables.state(NAME, only={bucket}).isEmpty() and tables.state(NAME).count() == 200 - held.count()
    tables.replace(NAME, rows(spark, 7), only=set())
    with pytest.raises(ValueError, match="beyond"):
        tables.replace(NAME, rows(spark, *range(200)), only={bucket})
    assert tables.state(NAME).count() == 200 - held.count()


def test_marks_of_buckets(spark):
    numbers = spark.createDataFrame([(n,) for n in (0, 1, 8, 63, 1000, 32767, None, 8)], "n int")
    assert marked_buckets(numbers.agg(bucket_marks(F.col("n"))).first()[0]) == {0, 1, 8, 63, 1000, 32767}
    assert marked_buckets(numbers.where("false").agg(bucket_marks(F.col("n"))).first()[0]) == set()


def test_what_is_not_committed_is_not_there(spark, tables):
    tables.replace(NAME, rows(spark, 1))

    def fails(work):
        work.replace(NAME, rows(spark, 2))
        work.append("meta/dead_letter", spark.createDataFrame([(day(1), "a", "c", "k", "r", "p")], schemas.DEAD_LETTER))
        assert ids(work.state(NAME)) == [2] and work.log("meta/dead_letter").count() == 1  # its own writes are seen
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError):
        tables.run(fails)
    assert ids(tables.state(NAME)) == [1] and tables.log("meta/dead_letter").isEmpty()


def test_success_marks_play_no_part(spark, tables):
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        tables.replace(NAME, rows(spark, 1, 2))
        assert not list(Path(tables.root).rglob("_SUCCESS"))
        assert ids(Tables(spark, tables.root).state(NAME)) == [1, 2]
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_schemas_are_checked(spark, tables):
    with pytest.raises(ValueError, match="have columns"):
        tables.replace(NAME, rows(spark, 1).withColumnRenamed("email", "mail"))
    with pytest.raises(ValueError, match="have columns"):
        tables.append("meta/dead_letter", rows(spark, 1))
    tables.replace(NAME, rows(spark, 1))
    tables.schemas[NAME] = T.StructType([*schemas.CROSSWALK.fields, T.StructField("extra", T.StringType())])
    with pytest.raises(ValueError, match="was written with columns"):
        tables.state(NAME)
    tables.rewrite(NAME, lambda old: old.withColumn("extra", F.lit("x")))
    assert tables.state(NAME).first()["extra"] == "x"


def test_a_lost_file_is_found(spark, tables):
    tables.replace(NAME, rows(spark, *range(30)))
    tables.verify()
    lost = next(p for p in Path(tables.root).rglob("*.parquet"))
    lost.unlink()
    with pytest.raises(ValueError, match="holds .* rows where its commits tell 30"):
        tables.verify()


def test_two_writers_lose_nothing(spark, tables):
    """Both read, then both write the same state: the second takes its inputs again."""
    tables.replace(NAME, rows(spark, 1))
    meet, tries = threading.Barrier(2, timeout=60), []

    def adds(number):
        def steps(work):
            old = work.state(NAME)
            tries.append(number)
            if tries.count(number) == 1:
                meet.wait()
            work.replace(NAME, old.unionByName(rows(spark, number)))

        return lambda: tables.run(steps)

    threads = [threading.Thread(target=adds(n)) for n in (2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert ids(tables.state(NAME)) == [1, 2, 3] and len(tries) == 3
    assert tables.commits.numbers() == [1, 2, 3]


def test_writers_of_other_tables_do_not_hinder(spark, tables):
    tries = []

    def steps(work):
        tries.append(1)
        work.state(NAME)
        if len(tries) == 1:
            tables.replace("silver/unified", schemas.empty(spark, schemas.UNIFIED))
        work.replace(NAME, rows(spark, 1))

    tables.run(steps)
    assert len(tries) == 1 and tables.commits.numbers() == [1, 2]
    assert set(tables.commits.latest().states) == {NAME, "silver/unified"}


def test_claims(spark, tables, monkeypatch):
    """A claim of another writer stands in the way, unless that writer died long ago."""
    tables.replace(NAME, rows(spark, 1))
    folder = Path(tables.root) / "_commits"
    (folder / "0000000002.other.claim").write_text("other")
    with pytest.raises(commits.Conflict):
        tables.replace(NAME, rows(spark, 2))
    assert ids(tables.state(NAME)) == [1]
    assert sorted(p.name for p in folder.iterdir()) == ["0000000001.json", "0000000002.other.claim"]
    monkeypatch.setattr(commits, "CLAIM_SECONDS", -5)
    tables.replace(NAME, rows(spark, 2))
    assert ids(tables.state(NAME)) == [2]


def test_a_number_is_done_once(spark, tables):
    step = lambda work: work.replace(NAME, work.state(NAME).unionByName(rows(spark, 5)))
    for number in (1, 1, 2, 1):
        tables.run(step, "stream x", number)
    assert ids(tables.state(NAME)) == [5, 5]


def test_many_commits_are_read_by_two(spark, tables, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_EVERY", 4)
    letter = lambda n: spark.createDataFrame([(day(1), "a", "c", str(n), "r", "p")], schemas.DEAD_LETTER)
    for n in range(11):
        tables.append("meta/dead_letter", letter(n))
    reads, read = [], commits.CommitLog.read
    monkeypatch.setattr(commits.CommitLog, "read", lambda self, n: reads.append(n) or read(self, n))
    assert sorted(int(r["key"]) for r in tables.log("meta/dead_letter").collect()) == list(range(11))
    assert len(reads) == 2
    assert {len(commits.CommitLog(tables.root).read(n).logs["meta/dead_letter"]) for n in (9, 10, 11)} <= set(range(12))


def test_old_versions_expire(spark, tables):
    for n in range(5):
        tables.replace(NAME, rows(spark, n, 100))
    tables.append("meta/dead_letter", spark.createDataFrame([(day(1), "a", "c", "k", "r", "p")], schemas.DEAD_LETTER))
    assert tables.expire(keep=2) == 4
    assert ids(tables.state(NAME)) == [4, 100] and tables.log("meta/dead_letter").count() == 1
    assert tables.expire(keep=2) == 0
    tables.verify()


# The job.


def people(numbers, time="2024-01-01T00:00:00Z", **more):
    a = [record_a(f"a{n}", time, email=f"u{n}@x.y", phone="1", **more) for n in numbers]
    b = [record_b(f"b{n}", time, emailaddress1=f"u{n}@x.y", telephone1="2") for n in numbers]
    return a, b


def sync(tables, run_id, a, b, **options):
    return sync_job.sync_run(tables, landed(tables.spark, *a), landed(tables.spark, *b), run_id, day(run_id), datetime(2000, 1, 1), **options)


def without_logs(tables):
    return {name: rows for name, rows in state_of(tables).items() if name in tables.keys and name != "meta/watermarks"}


def test_one_changed_record_writes_one_bucket_per_state(spark, tables):
    sync(tables, 1, *people(range(150)))
    before = files(tables.root)
    sync(tables, 2, [record_a("a7", "2024-01-05T00:00:00Z", email="u7@x.y", phone="9")], [])
    written = {}
    for name in files(tables.root) - before:
        layer, table, *inner = name.split("/")
        bucket = next((part for part in inner if part.startswith("bucket=")), None)
        written.setdefault(f"{layer}/{table}", set()).add(bucket)
    states = [name for name in tables.keys if name != "meta/watermarks" and name in written]
    assert len(states) >= 6 and all(len(written[name]) == 1 for name in states), written
    assert "silver/b_snapshot" not in written and "silver/b_keyed" not in written
    assert len({next(iter(written[n])) for n in states if n != "silver/a_snapshot"}) == 1
    assert tables.state("silver/unified").where("phone = '9'").count() == 1
    assert tables.log("silver/history_closed").count() == 1 and tables.state("silver/history_open").count() == 150
    tables.verify()


def test_moving_addresses(spark, tables, tmp_path):
    """Old and new keys are matched anew; the states equal those of one run over all records."""
    a, b = people(range(40))
    first_b = b + [record_b("b99", "2023-12-01T00:00:00Z", emailaddress1="u3@x.y", telephone1="older")]
    sync(tables, 1, a, first_b)
    moves_a = [record_a("a1", "2024-01-05T00:00:00Z", email="u2@x.y"), record_a("a5", "2024-01-05T00:00:00Z", email="none")]
    moves_b = [record_b("b3", "2024-01-06T00:00:00Z", emailaddress1="new@x.y")]  # b99 then stands for its old address
    sync(tables, 2, moves_a, moves_b)
    walk = {r["email"]: (r["a_id"], r["b_id"]) for r in tables.state("silver/crosswalk").collect()}
    assert walk["u1@x.y"] == (None, "b1") and walk["u2@x.y"] == ("a1", "b2") and walk["u5@x.y"] == (None, "b5")
    assert walk["u3@x.y"] == ("a3", "b99") and walk["new@x.y"] == (None, "b3")
    whole = Tables(spark, str(tmp_path / "whole"))
    sync(whole, 2, a + moves_a, first_b + moves_b)
    got, expected = without_logs(tables), without_logs(whole)
    for name in ("silver/a_snapshot", "silver/b_snapshot", "silver/a_keyed", "silver/b_keyed", "silver/matched", "silver/crosswalk", "silver/unified", "gold/a_outbox", "gold/b_outbox"):
        assert got[name] == expected[name], name


def test_run_stream_run(spark, tables, tmp_path):
    """The stream keeps the snapshot that the job keeps: nothing is lost, and the next run takes on what it changed."""
    sync(tables, 1, *people(range(10)))
    folder = str(tmp_path / "landing")
    for n, time in ((20, "2024-01-03T00:00:00Z"), (3, "2023-01-01T00:00:00Z"), (4, "2024-01-04T00:00:00Z")):
        incremental.land_text(landed(spark, record_a(f"a{n}", time, email=f"u{n}@x.y", phone="s")).coalesce(1), folder)
    snap = incremental.stream_snapshot(tables, folder, str(tmp_path / "cp"), SYSTEM_A, day(2), files_per_batch=1)
    assert snap.count() == 11 and snap.where("phone = 's'").count() == 2
    assert tables.state("silver/matched").count() == 10
    sync(tables, 3, [record_a("a30", "2024-01-08T00:00:00Z", email="u30@x.y")], [])
    assert tables.state("silver/a_snapshot").count() == 12
    assert {r["a_id"] for r in tables.state("silver/matched").collect()} == {*(f"a{n}" for n in range(10)), "a20", "a30"}
    assert tables.state("silver/unified").where("phone = 's'").count() == 2


def test_a_batch_that_fails_half_way_is_repeated(spark, tables, tmp_path, monkeypatch):
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")
    for n in range(3):
        incremental.land_text(landed(spark, record_a(str(n), "2024-01-01T00:00:00Z"), "junk").coalesce(1), folder)
    write, seen = commits.CommitLog.write, []

    def failing(self, commit):
        seen.append(commit.number)
        if len(seen) == 2:
            raise OSError("lost before the commit")
        write(self, commit)
        if len(seen) == 4:
            raise OSError("lost after the commit")

    monkeypatch.setattr(commits.CommitLog, "write", failing)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            incremental.stream_ingest(tables, folder, checkpoint, SYSTEM_A, day(9), files_per_batch=1)
    done = incremental.stream_ingest(tables, folder, checkpoint, SYSTEM_A, day(9), files_per_batch=1)
    assert sorted(r["a_id"] for r in done.collect()) == ["0", "1", "2"]
    assert tables.log("meta/dead_letter").count() == 3
    tables.verify()


def test_one_scan_per_ingest(spark, tables, tmp_path):
    """Count, rejects and newest time come from the write; the text is read by one job, and bronze by none."""
    landed(spark, record_a("1", "2024-01-05T00:00:00Z"), record_a("2", "2024-01-02T00:00:00Z")).write.text(str(tmp_path / "text"))
    text = spark.read.text(str(tmp_path / "text")).withColumnRenamed("value", "raw")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("ingest"))

    def steps(work):
        spark.sparkContext.setJobGroup("ingest", "")
        found = sync_job.ingest(work, text, SYSTEM_A, day(9), day(1))
        assert (found.records, found.newest, found.letters) == (2, day(5), None)
        spark.sparkContext.setJobGroup("other", "")

    tables.run(steps)
    assert jobs() == 1


def test_times_at_both_ends_do_not_stop_an_ingest(spark, tables):
    bad = [record_a("1", "9999-12-31T23:00:00-05:00"), record_a("2", "0001-01-01T00:00:00+05:00"), record_a("3", "9999-12-31T23:59:59.999999Z")]
    sync(tables, 1, bad, [])
    assert sorted((r["key"], r["reason"]) for r in tables.log("meta/dead_letter").collect()) == [
        ("1", "Unreadable modified time"), ("2", "Unreadable modified time"),
    ]
    assert tables.state("meta/watermarks").first()["watermark_ts"] == datetime.max


def test_batches_of_a_push(spark, tables):
    sync(tables, 1, *people(range(25)))
    batches = sync_job.next_batches(tables, SYSTEM_A, 10)
    assert {r["batch"]: r["count"] for r in batches.groupBy("batch").count().collect()} == {0: 10, 1: 10, 2: 5}
    assert json.loads(outbox.batch_requests(batches, SYSTEM_A).first()["body"])["inputs"][0]["properties"] == {"phone": "2"}
    results = spark.createDataFrame([(0, 200, "ok"), (1, 500, "down"), (2, 400, "bad")], "batch int, http_code int, message string")
    after = sync_job.take_batch_results(tables, results, SYSTEM_A, 2, day(5))
    assert {r["status"]: r["count"] for r in after.groupBy("status").count().collect()} == {"SUCCESS": 10, "PENDING": 10, "FAILED": 5}
    audit = tables.log("meta/audit_log").where("operation = 'push'").collect()
    assert {(r["status"], r["http_code"], r["message"]) for r in audit} == {
        ("SUCCESS", 200, "Pushed 10 records"), ("FAILED", 500, "down"), ("FAILED", 400, "bad"),
    }
    assert tables.log("meta/dead_letter").where("reason = 'bad'").count() == 5
    again = sync_job.next_batches(tables, SYSTEM_A, 10)
    assert again.count() == 10
    # A new run stages every difference anew.
    sync(tables, 3, [record_a("a1", "2024-01-08T00:00:00Z", email="u1@x.y", phone="2")], [])
    assert {r["status"]: r["count"] for r in sync_job.current_outbox(tables, SYSTEM_A).groupBy("status").count().collect()} == {"PENDING": 24}


def test_translated_push(spark, tables):
    a = [record_a("1", "2024-01-01T00:00:00Z", email="x@y.z", firstname="Gold", company="i" * 36)]
    sync(tables, 1, a, [record_b("2", "2024-01-01T00:00:00Z", emailaddress1="x@y.z")])
    dim = spark.createDataFrame([("tier", "Gold", 7)], "option_set string, label string, code bigint")
    how = sync_job.Translation(dim, {"firstname": "tier"}, {"company": "accounts"})
    sent = sync_job.next_push(tables, SYSTEM_B, translation=how).rows.first()["payload"]
    assert json.loads(sent) == {"firstname": 7, "company@odata.bind": f"/accounts({'i' * 36})"}
    assert json.loads(sync_job.next_push(tables, SYSTEM_B).rows.first()["payload"])["firstname"] == "Gold"


def test_pages_through_the_job(spark, tables):
    a, b = people(range(4))
    sync(tables, 1, [{"results": a[:3], "paging": {}}, {"results": a[3:]}, "junk"], [{"value": b, "@odata.nextLink": "x"}], pages=True)
    assert tables.state("silver/matched").where("a_id is not null and b_id is not null").count() == 4
    assert [r["reason"] for r in tables.log("meta/dead_letter").collect()] == [landing.NO_DOCUMENT]


def test_unkeyed_records(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"), keep_unkeyed=True)
    sync(tables, 1, [record_a("1", "2024-01-01T00:00:00Z"), record_a("2", "2024-01-01T00:00:00Z", email="x@y.z")], [])
    assert tables.state("silver/crosswalk").count() == 2
    sync(tables, 2, [record_a("1", "2024-01-03T00:00:00Z", email="x@y.z")], [])
    assert [(r["email"], r["a_id"]) for r in tables.state("silver/crosswalk").collect()] == [("x@y.z", "1")]
