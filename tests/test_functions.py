import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinsync.functions import keys, text, times


def apply(spark, function, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize("raw, expected", [
    (None, None), ("", None), ("   ", None), ("no-at-sign", None), ("A@B.C", "a@b.c"), ("\t a@b.c \n", "a@b.c"),
    ("  A@b.c　", "a@b.c"), ("a b@c", "a b@c"), ("@", "@"), ("É@X", "é@x"),
])
def test_normalize_email(spark, raw, expected):
    assert apply(spark, keys.normalize_email, [raw]) == [expected]


def test_checksum_separator_and_null(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None)], "x string, y string")
    plain = [r[0] for r in rows.select(keys.row_checksum(["x", "y"])).collect()]
    prefixed = [r[0] for r in rows.select(keys.row_checksum(["x", "y"], length_prefixed=True)).collect()]
    assert plain[0] == plain[1] and plain[2] == plain[3]
    assert len(set(prefixed)) == 4


DIGIT_CASES = [
    ("one two", "1 2"), ("ONE One oNe", "1 1 oNe"), ("someone phone1 one_ two2", "someone phone1 one_ two2"),
    ("(seven),eight.", "(7),8."), ("zero\nnine", "0\n9"), ("éone oneé one", "éone oneé 1"),
    ("²one three½ four", "²one three½ 4"), ("éone", "é1"),
    ("", ""), (None, None), ("Four-five six", "4-5 6"),
]


@pytest.mark.parametrize("raw, expected", DIGIT_CASES)
def test_digit_words(spark, raw, expected):
    assert apply(spark, text.digit_words, [raw]) == [expected]


M = text.MASK
CARD_CASES = [
    ("pay 4111111111111 now", f"pay {M} now"),
    ("123456789012", "123456789012"),
    ("1234567890123", M),
    ("1234 5678 9012 3456, x", f"{M}, x"),
    ("1234-5678-9012-3456", M),
    ("12345678901234567", "12345678901234567"),
    ("41111111111111111 4111111111111111111", f"{M} {M}"),
    ("41111111111111111111", "41111111111111111111"),
    ("123456789012345678901234", M),
    ("1234 5678 9012 3456 7890 1234", f"{M} 7890 1234"),
    ("1234-567890123456-78901234", f"{M}-78901234"),
    ("1234 5678901234567890 1234", M),
    ("x1234567890123", "x1234567890123"),
    ("1234567890123x", "1234567890123x"),
    ("١٢٣٤٥٦٧٨٩٠١٢٣", M),
    ("1 2 3 4 5 6 7 8 9 0 1 2 3", M),
    ("12-34", "12-34"),
    (None, None),
]


@pytest.mark.parametrize("raw, expected", CARD_CASES)
def test_redact_cards(spark, raw, expected):
    assert apply(spark, text.redact_cards, [raw]) == [expected]


def test_redact_text_masks_spelled_numbers(spark):
    spelled = "card one two three four five six seven eight nine zero one two three end"
    assert apply(spark, text.redact_text, [spelled]) == [f"card {M} end"]


def plain_digit_words(value):
    spellings = {s: str(d) for d, w in enumerate(text.DIGIT_WORDS) for s in (w, w.upper(), w.capitalize())}
    return re.sub(rf"\b(?:{'|'.join(spellings)})\b", lambda m: spellings[m.group()], value)


# All seven card formats in the order they are tried.
ALL_FORMATS = "|".join((
    r"\b(?:\d[ -]*?){13,16}\b", r"\b4\d{12,18}\b", r"\b(?:5[1-5]\d{14}|2[2-7][0-9]{14})\b", r"\b3[47]\d{13}\b",
    r"\b(?:6011|65|64[4-9])\d{12}\b", r"\b35\d{14}\b", r"\b(?:\d{4}[- ]?){3}\d{4}[- ]?\d{4}[- ]?\d{4}\b",
))


def plain_redact(value):
    return re.sub(ALL_FORMATS, text.MASK, value)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.lists(st.sampled_from([
        "4", "5", "35", "1234", "12345678", "6011", " ", "-", "--", "  ", "x", "_", "one", "Nine", "SIX", "tWo",
        "é", "٣", "²", ".", "\n",
    ]), max_size=24).map("".join),
    min_size=40, max_size=40,
))
def test_text_equals_python(spark, values):
    assert apply(spark, text.digit_words, values) == [plain_digit_words(v) for v in values]
    assert apply(spark, text.redact_cards, values) == [plain_redact(v) for v in values]
    assert apply(spark, text.redact_text, values) == [plain_redact(plain_digit_words(v)) for v in values]


ISO_CASES = [
    ("2024-02-03T04:05:06Z", datetime(2024, 2, 3, 4, 5, 6)),
    ("2024-02-03T04:05:06.789Z", datetime(2024, 2, 3, 4, 5, 6, 789000)),
    ("2024-02-03T04:05:06.123456+00:00", datetime(2024, 2, 3, 4, 5, 6, 123456)),
    ("2024-02-03T04:05:06+05:30", datetime(2024, 2, 2, 22, 35, 6)),
    ("2024-02-03T04:05:06-08:00", datetime(2024, 2, 3, 12, 5, 6)),
    ("2024-02-03T04:05:06", datetime(2024, 2, 3, 4, 5, 6)),
    ("2024-02-03", datetime(2024, 2, 3)),
    ("1969-12-31T23:59:59.5Z", datetime(1969, 12, 31, 23, 59, 59, 500000)),
    ("yesterday", None), ("", None), (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_iso_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(spark, times.parse_iso, [raw for raw, _ in ISO_CASES])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [expected for _, expected in ISO_CASES]


def test_format_iso(spark):
    values = [datetime(2024, 2, 3, 4, 5, 6), datetime(2024, 2, 3, 4, 5, 6, 70), None]
    assert apply(spark, times.format_iso, values, "timestamp_ntz") == [
        "2024-02-03T04:05:06Z", "2024-02-03T04:05:06.000070Z", None,
    ]


def test_request_id(spark):
    stamp = times.request_id("push", times.at(datetime(2001, 9, 1)))
    assert spark.range(1).select(stamp).first()[0] == "push-999302400"


def test_only_dates_of_four_digit_years_are_times(spark):
    raw = ["12:30:00", "T12:30:00Z", "99999-01-01T00:00:00Z", "+33000-01-01T00:00:00Z", "0000-01-01", "9999-12-31T23:59:59Z"]
    assert apply(spark, times.parse_iso, raw) == [None] * 5 + [datetime(9999, 12, 31, 23, 59, 59)]
