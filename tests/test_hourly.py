"""Event-time counts: each hour once, late rows listed, a run that died between its streams is made up for."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.functions.parse import parse_ts
from strata.streaming import hourly
from strata.streaming.hourly import DAY, LATE, NO_TIME, REASON, count_windows, cutoff, late_rows
from strata.streaming.ingest import read_ingested


def parse(lines):
    return lines.withColumn("ts", parse_ts("value"))


@pytest.fixture
def run(spark, tmp_path):
    inbox, taken, counts, checkpoint = (str(tmp_path / n) for n in ("in", "taken", "counts", "ckpt"))

    def arrive(*times):
        spark.createDataFrame([(t,) for t in times], "value string").coalesce(1).write.mode("append").text(inbox)
        return again()

    def again():
        count_windows(spark, inbox, taken, counts, checkpoint, parse)
        closed = {r.window_start.hour: r.n for r in read_ingested(spark, counts).collect()}
        return closed, sorted(r.value[11:16] for r in late_rows(spark, taken).collect())

    arrive.again, arrive.taken = again, taken
    return arrive


def at(*times):
    return [f"2024-01-05 {t}:00" for t in times]


def test_an_hour_is_counted_once_and_what_comes_later_is_listed(spark, run):
    assert run(*at("08:10", "08:50", "09:30"), "no time") == ({}, [])
    # the mark is 09:30 - 2 h: nothing is late, and 12:05 closes the hours before ten
    assert run(*at("08:20", "07:00", "12:05")) == ({7: 1, 8: 3, 9: 1}, [])
    # 10:05 is the mark: what is before ten is late, 10:01 is not
    assert run(*at("09:59", "10:01", "10:00", "08:00", "13:00")) == ({7: 1, 8: 3, 9: 1, 10: 2}, ["08:00", "09:59"])
    assert run.again() == ({7: 1, 8: 3, 9: 1, 10: 2}, ["08:00", "09:59"])
    reasons = {(r[REASON], r["count"]) for r in read_ingested(spark, run.taken).groupBy(REASON).count().collect()}
    assert reasons == {(None, 9), (LATE, 2), (NO_TIME, 1)}
    assert read_ingested(spark, run.taken).where(F.col(DAY).isNull()).count() == 1


@pytest.fixture
def far_zone(spark):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    yield
    spark.conf.set("spark.sql.session.timeZone", was)


def test_a_run_that_dies_before_it_counts(run, monkeypatch, far_zone):
    """In a session whose hours begin at half past in UTC: times are read as written."""
    run(*at("08:10", "09:30"))
    real = hourly.ingest
    calls = []

    def dies(*a, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*a, **kw)

    monkeypatch.setattr(hourly, "ingest", dies)
    with pytest.raises(RuntimeError):
        run(*at("08:40", "11:10"))
    monkeypatch.setattr(hourly, "ingest", real)
    # 11:10 was taken in, so 08:45 is late by the mark; 08:40 came in time and is counted
    assert run(*at("08:45", "09:10", "12:00")) == ({8: 2, 9: 2}, ["08:45"])


def test_cutoff():
    hour = timedelta(hours=1)
    assert cutoff(None, hour, hour) is None
    assert cutoff(datetime(2024, 1, 5, 10, 5), hour, 2 * hour) == datetime(2024, 1, 5, 8)
    assert cutoff(datetime(2024, 1, 5, 10), hour, 2 * hour) == datetime(2024, 1, 5, 8)
    assert cutoff(datetime(1969, 12, 31, 23, 59), hour, 0 * hour) == datetime(1969, 12, 31, 23)
