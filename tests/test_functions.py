from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeops.functions import business as B
from lakeops.functions import dates as D
from lakeops.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(value):
    return F.lit(value).cast("string") if value is None else F.lit(value)


@pytest.mark.parametrize("value, expected", [
    (None, None), ("", None), ("soon", None), (86_399, "1970-01-01 23:59:59"), ("0000086400", "1970-01-02 00:00:00"), (951_827_696, "2000-02-29 12:34:56"),
    ("4102444800", "2100-01-01 00:00:00"), ("1999-12-31T23:59:59.5Z", "1999-12-31 23:59:59.5"), ("2020-02-29T06:00:00-05:30", "2020-02-29 11:30:00"),
    ("2020-02-29 06:00:00", "2020-02-29 06:00:00"), ("2021-02-29T06:00:00Z", None), ("-5", None),
])
def test_epoch_or_iso(spark, value, expected):
    assert one(spark, D.epoch_or_iso_to_ts(lit(value)).cast("string")) == expected


@pytest.mark.parametrize("value, expected", [
    (None, None), ("a%20b", "a b"), ("a+b", "a+b"), ("%E2%82%AC", "€"), ("%zz", None), ("%", None), ("%E2%82", None), ("%FF", None),
    ("%EF%BF%BD", "�"), ("�", "�"), ("", ""), ("plain", "plain"), ("%2B", "+"),
])
def test_uri_percent_decode(spark, value, expected):
    assert one(spark, T.uri_percent_decode(lit(value))) == expected


@pytest.mark.parametrize("value, expected", [
    (None, None), ("", None), ("   ", None), ("undefined", None), (" NULL ", None), ("data%20engineering", "data engineering"),
    ("  Analytics  ", "analytics"), ("A%20%20%20B", "a b"), ("broken%zz+term%20x", "broken%zz term x"), ("a%0Ab", "a b"),
])
def test_clean_utm_term(spark, value, expected):
    assert one(spark, T.clean_utm_term(lit(value))) == expected


@pytest.mark.parametrize("value, expected", [
    ("https://shop.example.org/path", "shop.example.org"), ("https://www.example.org", "example.org"), ("HTTP://WWW.Example.org?x=1", "Example.org"),
    ("android-app://com.example.android/", "com.example.android"), (None, None),
])
def test_website_domain(spark, value, expected):
    assert one(spark, T.website_domain(lit(value))) == expected


@pytest.mark.parametrize("function, value, expected", [
    (T.clean_trailing_path, "/", "/"), (T.clean_trailing_path, "/a//", "/a"), (T.clean_trailing_path, None, None),
    (T.email_cleaner, " A@B.org ", "a@b.org"), (T.email_cleaner, "NULL", None),
    (T.is_valid_email, "o'neil+x@a-b.co", True), (T.is_valid_email, "a@b", False), (T.is_valid_email, None, False),
    (T.email_domain, "a@b.org", "b.org"), (T.email_domain, "ab", ""), (T.email_domain, None, None),
    (T.html_clean, "<p>a&amp;lt;b</p>\n <i>c</i>", "a<b c"), (T.html_clean, "", None), (T.html_clean, "<p></p>", ""),
    (T.name_clean, "A <b>", "unknown"), (T.name_clean, 'Ann “B” "C" (old)', "Ann B C"), (T.name_clean, None, None),
    (T.snake_key, " Job - Posting  x ", "job_posting_x"), (T.text_tail, "", "(no log output)"), (T.text_tail, None, "(no log output)"),
])
def test_text(spark, function, value, expected):
    assert one(spark, function(lit(value))) == expected


def test_long_texts_keep_their_end(spark):
    assert one(spark, F.length(T.text_tail(F.repeat(F.lit("x"), 9000)))) == 4000


@pytest.mark.parametrize("start, end, months", [
    ("2026-01-23", "2027-01-22", 12), ("2026-01-01", "2026-12-31", 12), ("2026-01-01", "2026-01-30", 0), ("2026-01-31", "2026-03-01", 1), ("2024-01-01", "2026-12-31", 36),
])
def test_term_months(spark, start, end, months):
    assert one(spark, B.term_months(F.lit(start), F.lit(end))) == months


def reason(spark, **changes):
    row = dict(id=1, item=9428, amount="1200.00", arr="1200.00", mrr="100.00", start="2026-01-23", end="2027-01-22") | changes
    c = {k: lit(v) for k, v in row.items()}
    return one(spark, B.arr_skip_reason(c["id"], c["item"], c["amount"], c["arr"], c["mrr"], c["start"], c["end"], [9428, 9431], [61482, 61483]))


def test_arr_verdicts(spark):
    assert reason(spark) == "already right"
    assert reason(spark, id=61482) == "excluded"
    assert reason(spark, item=1) == "other item"
    assert reason(spark, amount=None) == "no amount"
    assert reason(spark, end=None) == "no dates"
    assert reason(spark, end="2027-02-22") == "long term"
    assert reason(spark, arr=None) is None
    assert reason(spark, mrr="99.99") is None


def test_money_rounds_half_to_even(spark):
    assert str(one(spark, B.correct_arr(F.lit("0.125")))) == "0.12"
    assert str(one(spark, B.correct_arr(F.lit("0.135")))) == "0.14"
    assert str(one(spark, B.correct_mrr(F.lit("43683.06")))) == "3640.26"


def test_new_arr_branches(spark):
    def value(kind, prorated, non_prorated, term):
        return one(spark, B.new_arr(F.lit(kind), F.lit(prorated), F.lit(non_prorated), F.lit(70.0), F.lit(100.0), F.lit(10.0), F.lit(term)))

    assert value("Upsell", 1, 1, 12) == 60
    assert value("Upsell", 0, 1, 7) == 90
    assert value("New Business", 0, 0, 7) == 100
    assert value("Renewal", 0, 0, 24) == 90
    assert value("Renewal", 0, 0, 18) == 190


def test_padded_window():
    start, end = D.daily_window(date(2026, 1, 2))
    assert D.padded_window(start, end) == (datetime(2026, 1, 1, 21), datetime(2026, 1, 4))
    assert D.padded_window(start, end, full_refresh=True) == (None, None)


def test_calendar_windows():
    assert D.previous_and_current_month(date(2026, 1, 15)) == (datetime(2025, 12, 1), datetime(2026, 2, 1))
    assert D.previous_and_current_month(date(2025, 12, 31)) == (datetime(2025, 11, 1), datetime(2026, 1, 1))
    assert D.weekly_window(date(2026, 1, 4), starts_on_sunday=True)[0] == datetime(2026, 1, 4)
    assert D.last_full_week(date(2026, 1, 7)) == (datetime(2025, 12, 29), datetime(2026, 1, 5))
    assert D.trailing_hours(datetime(2026, 1, 7, 5, 59)) == (datetime(2026, 1, 6, 5), datetime(2026, 1, 7, 5))
    assert D.backfill_window(date(2026, 2, 1))[0] == datetime(2026, 1, 1)


def test_seconds_count_boundaries(spark):
    at = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, D.seconds_between(at("2024-01-01 00:00:00.9"), at("2024-01-01 00:30:01.1"))) == 1801


def test_window_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = events.filter(D.in_window(F.col("ts"), D.daily_window(date(2024, 1, 5))))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("text", ["", "abc", "Grüße", "a" * 200, None])
def test_hash_string(spark, text):
    """SHA-512 of the UTF-8 bytes in lowercase hex; the digest of 'abc' is the published one."""
    import hashlib

    from lakeops.functions import text as T

    got = one(spark, T.hash_string(lit(text)))
    assert got == (None if text is None else hashlib.sha512(text.encode()).hexdigest())
    if text == "abc":
        assert got.startswith("ddaf35a193617abacc417349ae204131")
