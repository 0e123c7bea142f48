import json

from conftest import day

from twinsync.__main__ import main, read_rules
from twinsync.plans.sync_job import current_outbox
from twinsync.rules import CONTACT_RULES, SYSTEM_A
from twinsync.sources.tables import Tables
from twinsync.streaming.incremental import land_text


def test_read_rules(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([
        {"unified": "phone", "a": "phone", "b": "telephone1"},
        {"unified": "email", "a": "email", "b": "emailaddress1", "direction": "to_b", "strategy": "fill_if_missing"},
        {"unified": "company", "a": "company"},
    ]))
    phone, email, company = read_rules(str(path))
    assert phone == CONTACT_RULES[3]
    assert (email.direction, email.strategy, company.b) == ("to_b", "fill_if_missing", None)


def test_sync_push_results(spark, tmp_path):
    root, a, b, out, told = (str(tmp_path / name) for name in ("tables", "a", "b", "requests", "told"))
    record = {"id": "1", "properties": {"modified": "2024-01-01T00:00:00Z", "email": "x@y.z", "phone": "1"}}
    other = {"id": "2", "modified": "2024-01-01T00:00:00Z", "emailaddress1": "x@y.z", "telephone1": "2"}
    for rows, folder in ((record, a), (other, b)):
        land_text(spark.createDataFrame([(json.dumps(rows),)], "raw string"), folder)

    main(["sync", "--root", root, "--landed-a", a, "--landed-b", b, "--run-id", "1", "--as-of", "2024-01-02"])
    main(["push", "--root", root, "--system", "a", "--out", out])
    assert spark.read.json(out).first()["properties"]["phone"] == "2"

    spark.createDataFrame([("1", 200, "ok")], "a_id string, http_code int, message string").write.parquet(told)
    main(["results", "--root", root, "--system", "a", "--results", told, "--run-id", "2", "--as-of", "2024-01-03"])
    row = current_outbox(Tables(spark, root), SYSTEM_A).first()
    assert (row["status"], row["attempt"], row["last_attempt_ts"]) == ("SUCCESS", 1, day(3))


def test_redact(spark, tmp_path):
    texts, out = str(tmp_path / "texts"), str(tmp_path / "out")
    spark.createDataFrame([(1, "no 4111 1111 1111 1111")], "id int, body string").write.parquet(texts)
    main(["redact", "--text", texts, "--column", "body", "--out", out])
    assert spark.read.parquet(out).first()["body"] == "no [REDACTED]"
