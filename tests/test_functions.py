"""Edge values of the column functions, expected results written by hand."""

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from edmart.functions import cip, messages, text, times


def apply(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


NAMES = {
    "Foo_Undergraduate SRC_12": "foo",
    "Foo src_abc": "foo",
    "Graduate": "",
    " src_1": "",
    "A_graduate_B": "a  b",
    "Foo": "foo",
    "a src_1 src_2": "a",
    "__Bar College__": "bar college",
    None: None,
}


def test_cleaned_name(spark):
    assert apply(spark, text.cleaned_name, list(NAMES)) == list(NAMES.values())


HOSTS = {
    "https://www.Foo.EDU/x/y": "foo.edu/",
    "HTTP://foo.edu": "http:/",
    "": "/",
    "foo.edu": "foo.edu/",
    "http://cs.foo.edu": "cs.foo.edu/",
    None: None,
}


def test_host_key(spark):
    assert apply(spark, text.src_host, list(HOSTS)) == list(HOSTS.values())
    assert apply(spark, text.uni_host, list(HOSTS)) == list(HOSTS.values())


COUNTS = {
    "125 records scraped": 125,
    "125 Records SCRAPED in total": 125,
    "site: 125 records scraped": None,
    " records scraped": 0,
    "12.5 records scraped": None,
    "-3 records scraped": -3,
    "99999999999 records scraped": None,
    "records scraped": None,
    "nothing": None,
    None: None,
}


def test_extracted_count(spark):
    assert apply(spark, messages.extracted_count, list(COUNTS)) == list(COUNTS.values())


SLOTS = {
    "scrape (slots left: 7 )": 7,
    "scrape (SLOTS left:12) then (x)": 12,
    "scrape (slots left:)": 0,
    "scrape (slots left: 7": 0,
    ") scrape (slots left: 4)": 4,
    "scrape (slots left: many)": None,
    "no slots": 0,
    "": 0,
    None: None,
}


def test_slots_left(spark):
    assert apply(spark, messages.slots_left, list(SLOTS)) == list(SLOTS.values())


def test_message_predicates(spark):
    values = ["5 Records scraped", "5 records scraped", "writing records scraped", None]
    assert apply(spark, messages.is_scraped, values) == [False, True, True, None]
    assert apply(spark, lambda c: messages.is_scraped(c, True), values) == [True, True, True, None]
    assert apply(spark, messages.is_not_writing, values) == [True, True, False, None]


def test_cip(spark):
    codes = ['="11.0101"', "11.0101", '="x"', "", None]
    assert apply(spark, cip.clean_cip, codes) == [Decimal("11.0101"), Decimal("11.0101"), None, None, None]
    assert apply(spark, cip.repaired_cip, ['="1.5"', "2.25", 'x"3"', None]) == [
        Decimal("1.5000"), Decimal("2.2500"), None, None,
    ]
    # a fifth decimal rounds in the table type but not in the comparison type
    assert apply(spark, cip.clean_cip, ["11.01015"]) == [Decimal("11.0102")]
    assert apply(spark, cip.exact_cip, ["11.01015"])[0] == Decimal("11.01015")


def test_duration(spark):
    t = lambda s: datetime.fromisoformat(s)
    cases = [
        ("2025-06-05 10:00:00.900", "2025-06-05 10:00:01.100", "00:00:01"),
        ("2025-06-05 10:00:00", "2025-06-06 11:00:00", "01:00:00"),
        ("2025-06-05 10:00:01", "2025-06-05 10:00:00", "23:59:59"),
        ("2025-06-05 10:00:00", "2025-06-05 13:04:09", "03:04:09"),
    ]
    df = spark.createDataFrame([(t(a), t(b)) for a, b, _ in cases] + [(None, t(cases[0][1]))], "a timestamp, b timestamp")
    assert [r[0] for r in df.select(times.clock_duration("a", "b")).collect()] == [c[2] for c in cases] + [None]


def test_time_texts(spark):
    values = [datetime(2025, 6, 5, 15, 7, 9), datetime(2025, 12, 25, 0, 30), datetime(2025, 1, 1, 12, 0), None]
    assert apply(spark, times.server_datetime_text, values, "v timestamp_ntz") == [
        "Jun  5 2025  3:07PM", "Dec 25 2025 12:30AM", "Jan  1 2025 12:00PM", None,
    ]
    assert apply(spark, times.minute_text, values, "v timestamp_ntz") == [
        "2025-06-05 15:07", "2025-12-25 00:30", "2025-01-01 12:00", "0",
    ]
    assert apply(spark, times.hyphen_minute_text, values, "v timestamp_ntz") == [
        "2025-06-05 15-07", "2025-12-25 00-30", "2025-01-01 12-00", None,
    ]


def test_text_comparison(spark):
    df = spark.createDataFrame([("Abc", "bc"), ("Abc", "BC"), ("a%c", "%"), ("abc", "%"), ("x", ""), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(text.text_contains("a", "b")).collect()] == [True, False, True, False, True, None]
    assert [r[0] for r in df.select(text.text_contains("a", "b", True)).collect()] == [True, True, True, False, True, None]
    df = spark.createDataFrame([("A", "a")], "a string, b string")
    assert df.select(text.text_eq("a", "b"), text.text_eq("a", "b", True)).first() == (False, True)


def test_concat_nulls_empty(spark):
    df = spark.createDataFrame([("1.3", None), ("1.3", "T"), (None, None)], "a string, b string")
    out = [r[0] for r in df.select(text.concat_nulls_empty("a", "b", sep="-")).collect()]
    assert out == ["1.3-", "1.3-T", "-"]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | st.text("ab:1-", max_size=4), st.none() | st.text("ab:1-", max_size=4)), min_size=1, max_size=12))
def test_row_digest_keeps_rows_apart(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.select(text.row_digest("a", "b")).distinct().count() == len(set(pairs))


@pytest.mark.parametrize("name", ["abcGraduate src_7", "Undergraduate_x", "undergraduategraduate"])
def test_cleaned_name_is_stable(spark, name):
    once = apply(spark, text.cleaned_name, [name])
    assert apply(spark, text.cleaned_name, once) == once
