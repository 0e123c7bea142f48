from datetime import datetime

from conftest import as_dicts, day
from pyspark.sql import Window
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.operators import history
from twinsync.rules import CONTACTS


def current(spark, **names):
    rows = [(key, *([value] + [None] * (len(CONTACTS.fields) - 1))) for key, value in names.items()]
    return spark.createDataFrame(rows, schemas.UNIFIED)


def run(spark, past, as_of, close_missing=False, **names):
    after = history.scd2_apply(current(spark, **names), past, as_of, close_missing=close_missing)
    # Read back, as a job would.
    return spark.createDataFrame(after.collect(), schemas.HISTORY)


def versions(df):
    rows = as_dicts(df, "unified_contact_id", "valid_from")
    return [(r["unified_contact_id"], r["email"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["is_current"]) for r in rows]


def test_three_runs(spark):
    past = run(spark, schemas.empty(spark, schemas.HISTORY), day(1), k1="a", k2="b", k3="c")
    past = run(spark, past, day(2), k1="a2", k2="b", k4="d")
    past = run(spark, past, day(3), k1="a3", k2=None, k3="c", k4="d")
    assert versions(past) == [
        ("k1", "a", 1, 2, False), ("k1", "a2", 2, 3, False), ("k1", "a3", 3, None, True),
        ("k2", "b", 1, 3, False), ("k2", None, 3, None, True),
        ("k3", "c", 1, None, True),  # gone in run two, yet left open
        ("k4", "d", 2, None, True),
    ]
    again = run(spark, past, day(4), k1="a3", k2=None, k3="c", k4="d")
    assert versions(again) == versions(past)


def test_invariants(spark):
    past = schemas.empty(spark, schemas.HISTORY)
    count = 0
    for number in range(1, 5):
        past = run(spark, past, day(number), **{f"k{i}": str(i * number % (i + 2)) for i in range(12)})
        assert past.count() >= count
        count = past.count()
    assert past.where("is_current").groupBy("unified_contact_id").count().where("count > 1").isEmpty()
    order = Window.partitionBy("unified_contact_id").orderBy("valid_from")
    gaps = past.withColumn("next", F.lead("valid_from").over(order))
    assert gaps.where("not (valid_to <=> next)").isEmpty()


def test_close_missing(spark):
    past = run(spark, schemas.empty(spark, schemas.HISTORY), day(1), k1="a", k2="b")
    past = run(spark, past, day(2), close_missing=True, k1="a")
    assert versions(past) == [("k1", "a", 1, None, True), ("k2", "b", 1, 2, False)]
    past = run(spark, past, day(3), close_missing=True, k1="a", k2="b")
    assert versions(past)[1:] == [("k2", "b", 1, 2, False), ("k2", "b", 3, None, True)]


def test_parts_make_up_the_whole(spark):
    past = run(spark, schemas.empty(spark, schemas.HISTORY), day(1), k1="a", k2="b", k3="c")
    past = run(spark, past, day(2), k1="a2", k2="b", k3="c")
    now = current(spark, k1="a3", k2="b", k4="d")
    changes = history.scd2_changes(now, past, day(3))
    closed = history.scd2_close(past, changes, day(3))
    untouched = history.scd2_untouched(past, changes)
    older = past.where("not is_current").join(changes, ["unified_contact_id"], "left_semi").select(*past.columns)
    parts = untouched.unionByName(older).unionByName(closed).unionByName(changes)
    assert versions(parts) == versions(history.scd2_apply(now, past, day(3)))


def test_closed_versions_are_not_shuffled(spark, tmp_path):
    past = run(spark, schemas.empty(spark, schemas.HISTORY), datetime(2024, 1, 1), k1="a")
    past.write.partitionBy("is_current").parquet(str(tmp_path / "h"))
    stored = spark.read.schema(schemas.HISTORY).parquet(str(tmp_path / "h"))
    plan = history.scd2_apply(current(spark, k1="b"), stored, day(2))._jdf.queryExecution().executedPlan().toString()
    closed_branch = plan[plan.index("Union"):plan.index("Generate")]
    assert "Exchange" not in closed_branch and "FileScan" in closed_branch
