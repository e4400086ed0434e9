"""Golden cases: the sample inputs shipped with (or documented in) the source jobs."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from strata.functions.parse import url_last_segment
from strata.operators import logs as L
from strata.operators.incremental import append_new, high_water_mark
from strata.plans.api import flatten_users
from strata.plans.medallion import users_silver
from strata.plans.sales import clean_with_tax, daily_revenue, quality_counts
from strata.session import scratch_path


def _strings(spark, cols, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in cols))


def test_raw_sales_clean_and_rejects(spark):
    raw = _strings(spark, ["id", "date", "amount", "item"], [
        ("1", "2026-03-01", "100.50", "Laptop"), ("2", "2026-03-01", None, "Mouse"),
        ("3", "INVALID_DATE", "50.00", "Keyboard"), ("4", "2026-03-02", "not_a_number", "Monitor"),
        ("5", "2026-03-02", "200.00", "Headphones")])
    clean, rejects = clean_with_tax(raw)
    got = {r.id: (r.date, r.total_with_tax) for r in clean.collect()}
    assert got == {"1": (dt.date(2026, 3, 1), 118.59), "5": (dt.date(2026, 3, 2), 236.0)}
    assert {(r.id, r.reason) for r in rejects.collect()} == {
        ("2", "bad_amount"), ("3", "bad_date"), ("4", "bad_amount")}


def test_sales_daily_revenue(spark):
    raw = _strings(spark, ["id", "date", "price", "quantity", "item", "amount"], [
        ("1", "2026-03-03", "100.50", "2", "Laptop", "1"), ("2", "2026-03-03", "invalid", "1", "Mouse", "1"),
        ("3", "2026-03-03", "50.00", "4", "Keyboard", "1"), ("4", "2026-03-04", "200.00", "1", "Monitor", "1"),
        ("5", "2026-03-04", None, "5", "Cables", "1"), ("6", "2026-03-04", "10.00", "10", "USB-Hub", "1")])
    assert [tuple(r) for r in daily_revenue(raw).collect()] == [("2026-03-03", 401.0), ("2026-03-04", 300.0)]
    counts = quality_counts(raw).first()
    assert (counts.total_rows, counts.revenue_valid_rows) == (6, 4)


def test_quantity_must_be_an_integer_literal(spark):
    raw = _strings(spark, ["id", "date", "price", "quantity"], [("1", "d", "1.00", "2.0"), ("2", "d", "1.00", "2")])
    assert [tuple(r) for r in daily_revenue(raw).collect()] == [("d", 2.0)]


LOG = """2026-03-03 10:15:22 | ERROR | Connection Timeout
2026-03-03 10:45:10 | INFO | User 101 Logged In
2026-03-03 11:20:05 | ERROR | 404 Page Not Found
2026-03-03 11:55:30 | ERROR | Database Unreachable
2026-03-04 09:10:12 | ERROR | Authentication Failure
2026-03-04 09:45:00 | INFO | System Health Check
2026-03-04 14:30:45 | ERROR | Memory Limit Exceeded"""


def _lines(spark, text):
    return spark.createDataFrame([(x,) for x in text.splitlines()], "value STRING")


def test_log_analysis(spark):
    lines = _lines(spark, LOG)
    parsed = L.parsed_errors(lines)
    assert [tuple(r) for r in L.errors_daily(parsed).collect()] == [(dt.date(2026, 3, 3), 3), (dt.date(2026, 3, 4), 2)]
    s = L.summary(lines).first()
    assert (s.total_errors, s.peak_hour, s.peak_count, s.rejected_lines) == (5, 11, 2, 0)


def test_log_marker_anywhere_and_bad_timestamps(spark):
    lines = _lines(spark, "2026-03-03 10:15:22 | INFO | retry after ERROR\nbad | ERROR | x\n2026-3-3 9:5:1 | ERROR | y")
    assert L.parsed_errors(lines).count() == 2
    assert L.rejected_lines(lines).count() == 1


def test_incremental_sync_runs(spark):
    src = spark.createDataFrame([
        (101, "Login Event", "2026-03-01 10:00:00"), (102, "Purchase", "2026-03-01 12:30:00"),
        (103, "Logout", "2026-03-02 08:15:00"), (104, "Update Profile", "2026-03-03 14:00:00"),
        (105, "New Post", "2026-03-03 16:45:00")], "id INT, data STRING, updated_at STRING") \
        .withColumn("updated_at", F.to_timestamp_ntz("updated_at"))
    target = scratch_path(spark, "golden_incr")
    append_new(spark, src, target, "updated_at")
    assert spark.read.parquet(target).count() == 5
    assert str(high_water_mark(spark.read.parquet(target), "updated_at")) == "2026-03-03 16:45:00"
    append_new(spark, src, target, "updated_at")
    assert spark.read.parquet(target).count() == 5


API = [
    {"id": 101, "user": {"name": "Alice Johnson", "contact": {"email": "alice@example.com", "phone": "555-0101"},
                         "meta": {"city": "Hyderabad", "signup_date": "2026-01-15"}}},
    {"id": 102, "user": {"name": "Bob Smith", "contact": {"email": "bob@example.com", "phone": None}, "meta": None}},
    {"id": 103, "user": {"name": "Charlie Brown", "contact": {"email": "charlie@example.com"},
                         "meta": {"city": "Bangalore"}}},
]


def test_api_flatten_defaults(spark):
    df = spark.createDataFrame([(json.dumps(r),) for r in API] + [('{"id": 104, "user": null}',)], "json STRING")
    flat, rejects = flatten_users(df)
    assert sorted(tuple(r) for r in flat.collect()) == [
        (101, "Alice Johnson", "alice@example.com", "Hyderabad", "2026-01-15"),
        (102, "Bob Smith", "bob@example.com", "Remote", "2026-01-01"),
        (103, "Charlie Brown", "charlie@example.com", "Bangalore", "2026-01-01")]
    assert rejects.count() == 1


def test_api_null_is_not_missing(spark):
    df = spark.createDataFrame([('{"id": 1, "user": {"contact": {"email": null}, "meta": {"city": null}}}',)],
                               "json STRING")
    r = flatten_users(df)[0].first()
    assert (r.full_name, r.email, r.city, r.signup_date) == ("N/A", None, None, "2026-01-01")


def test_url_last_segment(spark):
    df = spark.createDataFrame([("https://x/a/b/25?x=1",), ("https://x/a/25#top",), ("https://x/a/",)], "url STRING")
    assert [r[0] for r in df.select(url_last_segment("url")).collect()] == ["25", "25#top", ""]


def test_users_rule_order(spark):
    df = spark.createDataFrame(
        [("Nation_1", "fr", "EN", "MACHINERY", "Mrs", None, 364, "True", "True", "True", "True", "7", "3",
          "0.125", 1.0, 1.0, 1, 1),
         ("Nation_1", "fr", None, None, "Msx Miss", 10, 1200, "x", "x", "x", "x", "bad", "3", "1", 1.0, 1.0, 1, 1)],
        "country STRING, countrycode STRING, language STRING, gender STRING, civilitytitle STRING, "
        "dayssincelastlogin BIGINT, seniority BIGINT, hasanyapp STRING, hasandroidapp STRING, hasiosapp STRING, "
        "hasprofilepicture STRING, socialnbfollowers STRING, socialnbfollows STRING, productspassrate STRING, "
        "seniorityasmonths DOUBLE, seniorityasyears DOUBLE, productsSold INT, productsWished INT")
    a, b = users_silver(df).orderBy("seniority").collect()
    assert (a.account_age_years, a.account_age_group) == (1.0, "Intermediate")   # 364 days rounds to 1.00
    assert a.years_since_last_login is None and a.dayssincelastlogin == 0      # ratio before the 0-fill
    assert a.user_descriptor == "Male_FR_Ms_English" and a.civilitytitle_clean == "Ms"
    assert a.productspassrate is not None and float(a.productspassrate) == 0.13
    assert b.civilitytitle_clean == "Msx Miss" and b.flag_long_title is False
    assert (b.gender, b.language_full, b.user_descriptor) == ("Other", "Other", "Other_FR_Msx_Other")
    assert b.socialnbfollowers is None and b.hasanyapp is None


def test_bad_timestamp_fails_or_rejects(spark):
    import pytest

    from strata.operators.incremental import typed_source

    src = spark.createDataFrame([(1, "2026-03-01 10:00:00"), (2, "yesterday")], "id INT, updated_at STRING")
    good, bad = typed_source(src, "updated_at", on_bad="reject")
    assert [r.id for r in good.collect()] == [1] and [r.id for r in bad.collect()] == [2]
    strict, _ = typed_source(src, "updated_at", on_bad="fail")
    with pytest.raises(Exception):
        strict.collect()


def test_json_array_file(spark, tmp_path):
    from strata.plans.api import flatten_records
    from strata.sources.readers import read_json_records

    p = tmp_path / "api_response.json"
    p.write_text(json.dumps(API, indent=2))
    flat, _ = flatten_records(read_json_records(spark, str(p), multi_line=True))
    assert sorted(r.user_id for r in flat.collect()) == [101, 102, 103]


def test_missing_column_rejects_rows_in_tax_job_but_fails_revenue_job(spark):
    import pytest

    raw = _strings(spark, ["id", "date", "item"], [("1", "2026-03-01", "Laptop")])
    clean, rejects = clean_with_tax(raw)
    assert clean.count() == 0 and [r.reason for r in rejects.collect()] == ["bad_amount"]
    with pytest.raises(Exception):
        daily_revenue(raw).collect()


def test_parsing_does_not_depend_on_the_session_time_zone(spark):
    from strata.functions.parse import iso_date, parse_date, parse_date_lenient, parse_ts

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00", "2026-3-1", "2000-04-04T00:00:00Z", "1998-05")],
                                   "a STRING, b STRING, c STRING, d STRING")
        r = df.select(parse_ts("a"), parse_date("b"), iso_date("c"), parse_date_lenient("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(r) == (dt.datetime(2024, 3, 10, 2, 30), dt.date(2026, 3, 1), dt.date(2000, 4, 4), dt.date(1998, 5, 1))


def test_top_gold_and_gender_shares(spark):
    from strata.plans.olympics import gender_shares, top_gold

    medals = spark.createDataFrame([("B", 3), ("A", 3), ("C", 9), ("D", 1)], "TeamCountry STRING, Gold BIGINT")
    assert [tuple(r) for r in top_gold(medals, k=3).collect()] == [("C", 9), ("A", 3), ("B", 3)]
    entries = spark.createDataFrame([("x", "1", "3", "4"), ("y", "0", "0", "0"), ("z", "2", "2", "n/a")],
                                    "Discipline STRING, Female STRING, Male STRING, Total STRING")
    got = {r.Discipline: (r.Avg_Female, r.Avg_Male) for r in gender_shares(entries).collect()}
    assert got == {"x": (0.25, 0.75), "y": (None, None), "z": (None, None)}


def test_rental_rules(spark):
    from strata.plans.rentals import bookings_silver, hosts_silver, listings_silver

    hosts = spark.createDataFrame([(1, "Ann Lee Jr", 96), (2, "Bo", 80), (3, "Cy", 59), (4, "Di", None)],
                                  "host_id INT, host_name STRING, response_rate INT") \
        .selectExpr("*", "DATE'2020-01-01' AS host_since", "true AS is_superhost",
                    "TIMESTAMP_NTZ'2020-01-01 00:00:00' AS created_at")
    got = {r.host_id: (r.host_name, r.response_rate_quality) for r in hosts_silver(hosts).collect()}
    assert got == {1: ("Ann_Lee_Jr", "VERY GOOD"), 2: ("Bo", "GOOD"), 3: ("Cy", "POOR"), 4: ("Di", "POOR")}
    listings = spark.createDataFrame([(1, 99.99), (2, 100.0), (3, 250.5)], "listing_id INT, p DOUBLE").selectExpr(
        "listing_id", "1 AS host_id", "'t' AS property_type", "'r' AS room_type", "'c' AS city", "'k' AS country",
        "1 AS accommodates", "1 AS bedrooms", "1 AS bathrooms", "CAST(p AS DECIMAL(10,2)) AS price_per_night",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' AS created_at")
    assert [r.price_per_night_tag for r in listings_silver(listings).orderBy("listing_id").collect()] == \
        ["low", "medium", "high"]
    bookings = spark.createDataFrame([(1, 3, "33.335", "10.00", "5.00")],
                                     "booking_id INT, nights_booked INT, a STRING, c STRING, s STRING").selectExpr(
        "booking_id", "7 AS listing_id", "DATE'2020-01-01' AS booking_date", "nights_booked",
        "CAST(a AS DECIMAL(12,4)) AS booking_amount", "CAST(c AS DECIMAL(10,2)) AS cleaning_fee",
        "CAST(s AS DECIMAL(10,2)) AS service_fee", "'confirmed' AS booking_status",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' AS created_at")
    assert bookings_silver(bookings).first().total_amount == 115.01   # round(3 * 33.335, 2) + 10 + 5
