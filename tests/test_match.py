from hashlib import sha256

import pytest
from conftest import a_rows, as_dicts, b_rows, day
from pyspark.sql import functions as F

from twinsync import schemas
from twinsync.operators import changes, match, snapshot
from twinsync.rules import SYSTEM_A, SYSTEM_B, FieldRule


def uid(text):
    return sha256(text.encode()).hexdigest()


@pytest.fixture
def sides(spark):
    a = a_rows(
        spark,
        {"id": "a1", "modified": day(1), "email": " X@Y.z ", "firstname": "Ann", "phone": None},
        {"id": "a2", "modified": day(2), "email": "dup@y.z"},
        {"id": "a3", "modified": day(3), "email": "DUP@y.z", "company": "new"},
        {"id": "a4", "modified": day(3), "email": "dup@y.z"},
        {"id": "a5", "modified": day(1), "email": "only-a@y.z"},
        {"id": "a6", "modified": day(1), "email": None},
        {"id": "a7", "modified": day(1), "email": "broken"},
    )
    b = b_rows(
        spark,
        {"id": "b1", "modified": day(1), "email": "x@y.z", "firstname": "Bob", "telephone1": "12"},
        {"id": "b2", "modified": day(1), "email": "only-b@y.z"},
        {"id": "b3", "modified": day(1), "email": None},
    )
    return a, b


def test_crosswalk(sides):
    rows = as_dicts(match.crosswalk(match.match_records(*sides)), "email")
    assert [(r["email"], r["a_id"], r["b_id"]) for r in rows] == [
        ("dup@y.z", "a3", None),  # newest, then smallest id
        ("only-a@y.z", "a5", None),
        ("only-b@y.z", None, "b2"),
        ("x@y.z", "a1", "b1"),
    ]
    assert all(r["unified_contact_id"] == uid(r["email"]) for r in rows)


def test_keep_unkeyed(sides):
    rows = as_dicts(match.crosswalk(match.match_records(*sides, keep_unkeyed=True)), "a_id", "b_id")
    unkeyed = {(r["a_id"], r["b_id"]): r["unified_contact_id"] for r in rows if r["email"] is None}
    assert unkeyed == {("a6", None): uid("a|a6"), ("a7", None): uid("a|a7"), (None, "b3"): uid("b|b3")}
    assert len(rows) == 7


def test_unify_prefers_a_and_keeps_the_raw_email(sides):
    unified = {r["unified_contact_id"]: r for r in as_dicts(match.unify(match.match_records(*sides)))}
    both = unified[uid("x@y.z")]
    assert (both["email"], both["firstname"], both["phone"]) == (" X@Y.z ", "Ann", "12")
    assert unified[uid("only-b@y.z")]["email"] == "only-b@y.z"


def test_attach_snapshots_gives_the_matched_frame(sides):
    matched = match.match_records(*sides)
    rebuilt = match.attach_snapshots(match.crosswalk(matched), *sides)
    assert rebuilt.columns == matched.columns
    assert as_dicts(rebuilt, "unified_contact_id") == as_dicts(matched, "unified_contact_id")


def test_matched_columns_fit_their_table(sides):
    assert match.match_records(*sides).columns == schemas.MATCHED.names


def test_rule_checks():
    with pytest.raises(ValueError):
        FieldRule("x", "x", "x", direction="sideways")
    with pytest.raises(ValueError):
        FieldRule("x", "x", "x", strategy="merge")


def test_snapshot_order_ties_and_null_ids(spark):
    changes = a_rows(
        spark,
        {"id": "a1", "modified": day(1), "firstname": "old"},
        {"id": "a1", "modified": day(2), "firstname": "m"},
        {"id": "a1", "modified": day(2), "firstname": "n"},
        {"id": "a1", "modified": None, "firstname": "z"},
        {"id": "a2", "modified": None, "firstname": "kept"},
        {"id": None, "modified": day(9), "firstname": "lost"},
    )
    got = as_dicts(snapshot.snapshot(changes, SYSTEM_A), "a_id")
    assert [(r["a_id"], r["firstname"]) for r in got] == [("a1", "n"), ("a2", "kept")]


def test_hot_keys_are_cut_down_before_the_shuffle(spark):
    """A third of all rows share one id, and one email: one row per map task is shuffled for it."""
    ids = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("t")
    )
    latest = snapshot.latest_by_ts(ids, ["k"], "t")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[partial:partial + 200]
    assert latest.count() == 20_001
    assert latest.where("k = 'hot'").first()["t"] == 29_997


def change_rows(*numbers):
    return [
        {
            "id": f"a{n % 17}", "modified": None if n % 11 == 0 else day(1 + n * 7 % 13), "firstname": str(n % 5),
            "phone": None if n % 3 else str(n), "email": None if n % 13 == 0 else f"u{n % 23}@x.y",
        }
        for n in numbers
    ]


@pytest.mark.parametrize("keep_unkeyed", [False, True])
def test_changes_lead_to_the_snapshot_and_the_keys_of_all(spark, keep_unkeyed):
    """Over ties, null times, new ids, ids that come in late, and addresses that move; two batches of changes at once."""
    batches = [change_rows(*range(60)), change_rows(*range(40, 120, 3)), change_rows(*range(100, 150, 7))]
    batches[1] += [{"id": "new", "modified": day(1)}, {"id": None, "modified": day(2)}]
    snap = a_rows(spark).where("false")
    keyed = match.key_of(snap, SYSTEM_A, keep_unkeyed)
    found = []
    for batch in batches:
        change = changes.changed_records(a_rows(spark, *batch), snap, SYSTEM_A, keep_unkeyed).cache()
        assert change.schema.names == schemas.changes(SYSTEM_A).names
        snap = changes.apply_to_snapshot(snap, change, SYSTEM_A).cache()
        found.append(change)
    everything = [row for batch in batches for row in batch]
    expected = snapshot.snapshot(a_rows(spark, *everything), SYSTEM_A)
    assert as_dicts(snap, "a_id") == as_dicts(expected, "a_id")

    keyed = changes.apply_to_keyed(keyed, found[0], SYSTEM_A)
    keyed = changes.apply_to_keyed(keyed, found[1].unionByName(found[2]), SYSTEM_A)
    whole = match.key_of(expected, SYSTEM_A, keep_unkeyed).where("unified_contact_id is not null")
    assert as_dicts(keyed, "a_id") == as_dicts(whole, "a_id")
    assert (keyed.count() < expected.count()) != keep_unkeyed

    # The same batch again changes nothing; a record that moves names the key it had.
    assert changes.changed_records(a_rows(spark, *batches[2]), snap, SYSTEM_A).isEmpty()
    one = snap.where("email is not null").first()
    moved = a_rows(spark, {"id": one["a_id"], "modified": day(30), "email": "else@x.y"})
    row = changes.changed_records(moved, snap, SYSTEM_A).first()
    assert row["old_uid"] == whole.where(F.col("a_id") == one["a_id"]).first()["unified_contact_id"] != row["unified_contact_id"]


def test_match_by_key_equals_match_by_address(spark):
    a = a_rows(spark, *change_rows(*range(40)))
    a = snapshot.snapshot(a, SYSTEM_A)
    b = b_rows(spark, {"id": "b1", "email": "U1@x.y "}, {"id": "b2", "email": "u1@x.y"}, {"id": "b3", "email": "z@z.z"}, {"id": "b4"})
    for keep in (False, True):
        keyed = [match.key_of(s, system, keep).where("unified_contact_id is not null") for s, system in ((a, SYSTEM_A), (b, SYSTEM_B))]
        got, expected = match.match_keyed(*keyed), match.match_records(a, b, keep)
        assert got.columns == expected.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
