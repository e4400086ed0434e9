"""Algebraic properties of the operators on driver data."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.dedup import keep_one
from strata.operators.incremental import new_rows, upsert_latest
from strata.operators.validate import split_valid
from strata.operators.windows import neighbours, running_sum
from strata.plans import medallion as M
from strata.plans.rentals import bookings_silver, with_part
from strata.plans.sales import tax_checks
from strata.plans.views import table, view
from strata.session import scratch_path
from strata.sources.sinks import write_overwrite
from tests.conftest import SF_CHECK, SF_SMALL


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_idempotent_and_order_free(spark):
    b = bookings_silver(view(spark, SF_CHECK, "v_bookings"))
    once = keep_one(b, ["booking_id"], ["created_at"])
    assert same(keep_one(once, ["booking_id"], ["created_at"]), once)
    assert same(keep_one(b.repartition(7, "created_at"), ["booking_id"], ["created_at"]), once)
    assert once.count() == b.select("booking_id").distinct().count()


def test_upsert_idempotent(spark):
    b = bookings_silver(view(spark, SF_SMALL, "v_bookings"))
    first = upsert_latest(None, b, ["booking_id"], ["created_at"])
    assert same(first, upsert_latest(first, b, ["booking_id"], ["created_at"]))


def test_clean_and_rejects_partition_the_input(spark):
    raw = view(spark, SF_SMALL, "v_raw_sales")
    clean, rejects = split_valid(raw, tax_checks(raw))
    assert clean.count() + rejects.count() == raw.count()
    assert same(clean.unionByName(rejects.drop("_reject_reason")), raw)


def test_high_water_mark_rerun_is_empty(spark):
    src = view(spark, SF_SMALL, "v_source")
    assert new_rows(src, src, "updated_at").count() == 0


def test_outer_chain_rewrite_equals_plain_chain(spark):
    tables = M.silver_tables(spark, SF_CHECK)
    plain = M.gold_user_obt(*tables, force="plain")
    assert same(M.gold_user_obt(*tables), plain)


def _hot_orders(spark):
    """A third of the orders moved onto one customer (a hot key)."""
    o = table(spark, SF_CHECK, "orders")
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))


def test_bucketed_running_sum_equals_plain(spark):
    o = _hot_orders(spark).select("o_custkey", "o_orderkey", "o_orderdate",
                                  F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    order = ["o_orderdate", "o_orderkey"]
    plain = running_sum(o, ["o_custkey"], order, "v", "rt")
    split = running_sum(o, ["o_custkey"], order, "v", "rt", bucket=F.date_trunc("month", "o_orderdate"))
    assert same(plain, split)


def test_bucketed_neighbours_equal_plain(spark):
    o = _hot_orders(spark).select("o_custkey", "o_orderkey", "o_orderdate")
    order = ["o_orderdate", "o_orderkey"]
    plain = neighbours(o, ["o_custkey"], order, "o_orderkey", "p", "n")
    split = neighbours(o, ["o_custkey"], order, "o_orderkey", "p", "n", bucket=F.year("o_orderdate"))
    assert same(plain, split)


def test_outer_chain_with_a_hot_key(spark):
    """A third of the users in one country: the broadcast rewrite still equals the plain chain."""
    users, countries, buyers, sellers = M.silver_tables(spark, SF_CHECK)
    hot = users.withColumn("country", F.when(F.col("user_id") % 3 == 0, F.lit("Nation_1"))
                           .otherwise(F.col("country")))
    plain = M.gold_user_obt(hot, countries, buyers, sellers, force="plain")
    assert same(M.gold_user_obt(hot, countries, buyers, sellers), plain)


def test_upsert_merges_only_touched_partitions(spark):
    b = with_part(bookings_silver(view(spark, SF_SMALL, "v_bookings")), "booking_id") \
        .withColumn("part", F.pmod(F.col("booking_id"), F.lit(16)).cast("int"))
    path = scratch_path(spark, "merged")
    write_overwrite(upsert_latest(None, b, ["booking_id"], ["created_at"], "part"), path, partition_by=["part"])
    one = b.orderBy("booking_id").limit(1).withColumn("booking_status", F.lit("changed")) \
        .withColumn("created_at", F.expr("TIMESTAMP_NTZ'2100-01-01 00:00:00'"))
    after = upsert_latest(spark.read.parquet(path), one, ["booking_id"], ["created_at"], "part")
    text = after._jdf.queryExecution().executedPlan().toString()
    value = one.first()["part"]
    assert f"PartitionFilters: [coalesce((part#" in text or f"(part#" in text and f"= {value})" in text
    assert after.where(F.col("booking_status") == "changed").count() == 1
    assert after.count() == b.select("booking_id").distinct().count()


def test_unreadable_target_is_not_a_first_run(spark):
    import os

    import pytest

    from strata.operators.incremental import append_new
    from strata.session import local_path

    path = scratch_path(spark, "broken")
    src = spark.range(5).selectExpr("id", "timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00') AS at")
    append_new(spark, src, path, "at")
    for f in os.listdir(local_path(path)):
        if f.endswith(".parquet"):
            with open(os.path.join(local_path(path), f), "wb") as out:
                out.write(b"not parquet")
    files = sorted(os.listdir(local_path(path)))
    with pytest.raises(Exception):
        append_new(spark, src, path, "at")
    assert sorted(os.listdir(local_path(path))) == files


def test_split_write_twice_keeps_the_second_run_only(spark):
    from strata.operators.validate import tag_rejects, write_split

    df = spark.range(10)
    path = scratch_path(spark, "split_twice")
    write_split(tag_rejects(df, [("odd", F.col("id") % 2 == 1)]), path)
    write_split(tag_rejects(df, [("none", F.lit(False))]), path)
    assert spark.read.parquet(path).where("status = 'reject'").count() == 0


def test_big_values_survive_rounding(spark):
    from strata.functions.rules import money, ratio

    row = spark.sql("SELECT 3e12 AS a, 2.0D AS b, '12345678901234567890.25' AS m").select(
        ratio("a", "b").alias("r"), money("m").cast("string").alias("m")).first()
    assert row.r == 1.5e12 and row.m.startswith("12345678901234567890.25")


def test_tax_is_rounded_once(spark):
    from strata.plans.sales import clean_with_tax

    raw = spark.createDataFrame([("1", "1.0049", "2024-01-01")], "id STRING, amount STRING, date STRING")
    assert clean_with_tax(raw)[0].first()["total_with_tax"] == 1.19


def test_timestamp_parts_are_bounded_the_same_in_both_modes(spark):
    import pytest

    from strata.functions.parse import parse_ts, parse_ts_strict

    bad = ["2024-01-01 10:00:60", "0000-01-01 00:00:00", "2024-02-30 00:00:00", "2024-1-1 24:0:0"]
    df = spark.createDataFrame([(b,) for b in bad], "t STRING")
    assert [r[0] for r in df.select(parse_ts("t")).collect()] == [None] * 4
    for b in bad:
        with pytest.raises(Exception):
            df.where(F.col("t") == b).select(parse_ts_strict("t")).collect()
    assert str(spark.sql("SELECT '2024-1-2 3:4:5' AS t").select(parse_ts_strict("t")).first()[0]) == "2024-01-02 03:04:05"


def test_split_trim_strips_tabs(spark):
    from strata.functions.parse import split_trim

    assert spark.sql("SELECT 'a\t| b \t|\tc' AS v").select(split_trim("v")).first()[0] == ["a", "b", "c"]


def test_scd2_with_unknown_start_has_one_current_row(spark):
    from strata.operators.incremental import scd2

    df = spark.sql("SELECT 1 AS k, CAST(NULL AS TIMESTAMP_NTZ) AS at, 'a' AS v UNION ALL SELECT 1, NULL, 'b' "
                   "UNION ALL SELECT 1, TIMESTAMP_NTZ'2024-01-01 00:00:00', 'c' UNION ALL SELECT 2, NULL, 'd'")
    for bucket in (None, F.date_trunc("month", "at")):
        rows = scd2(df, ["k"], "at", bucket=bucket).where("is_current").collect()
        assert sorted((r.k, r.v) for r in rows) == [(1, "c"), (2, "d")]


def test_ranges_split_a_hot_month(spark):
    from strata.operators.windows import ranges

    o = _hot_orders(spark).select("o_custkey", "o_orderkey", F.expr(
        "CASE WHEN o_custkey = 7 THEN timestampadd(MINUTE, CAST(o_orderkey % 40000 AS INT), TIMESTAMP_NTZ'1997-03-01 00:00:00') "
        "ELSE o_orderdate END").alias("o_orderdate"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    bucket = ranges(o, "o_orderdate", 1000)
    hot = o.where("o_custkey = 7").groupBy(bucket.alias("b")).count().collect()
    assert len(hot) > 3 and max(r["count"] for r in hot) < 3000
    order = ["o_orderdate", "o_orderkey"]
    assert same(running_sum(o, ["o_custkey"], order, "v", "rt"), running_sum(o, ["o_custkey"], order, "v", "rt", bucket=bucket))
    assert same(neighbours(o, ["o_custkey"], order, "o_orderkey", "p", "n"),
                neighbours(o, ["o_custkey"], order, "o_orderkey", "p", "n", bucket=bucket))


def test_split_write_observes_counts_in_the_same_job(spark):
    from strata.operators.validate import tag_rejects, write_split

    raw = view(spark, SF_SMALL, "v_raw_sales")
    path = scratch_path(spark, "split")
    counts = write_split(tag_rejects(raw, tax_checks(raw)), path)
    assert counts["total_rows"] == raw.count() == counts["valid_rows"] + counts["rejected_rows"]
    assert spark.read.parquet(path).where("status = 'reject'").count() == counts["rejected_rows"]


def test_outer_chain_has_no_limit_on_rows_per_key(spark):
    from strata.operators.obt import outer_chain

    base = spark.range(4).selectExpr("id % 2 AS k", "id AS b")
    dim = spark.range(1000).selectExpr("id % 3 AS k", "id AS d")
    assert same(outer_chain(base, [dim], "k").select("k", "b", "d"),
                outer_chain(base, [dim], "k", force="plain").select("k", "b", "d"))


def test_pre_aggregated_sellers_keep_the_grain(spark):
    users, countries, buyers, sellers = M.silver_tables(spark, SF_CHECK)
    per_seller = sellers.unionByName(sellers)            # twice as many rows per (country, sex)
    gold = M.gold_user_obt(users, countries, buyers, per_seller, pre_aggregate=True)
    assert gold.count() == M.gold_user_obt(users, countries, buyers, sellers).count()


def test_normalized_country_key_matches_more_users(spark):
    tables = M.silver_tables(spark, SF_CHECK)
    unmatched = lambda df: df.where(F.col("Country").isNotNull() & F.col("Countries_Sellers").isNull() &
                                    F.col("Buyers_Total").isNull() & F.col("Sellers_Total").isNull()).count()
    assert unmatched(M.gold_user_obt(*tables, normalize_key=True)) < unmatched(M.gold_user_obt(*tables))


def test_bucketed_windows_keep_null_keys_as_a_group(spark):
    o = table(spark, SF_SMALL, "orders").select(
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("k"),
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    order = ["o_orderdate", "o_orderkey"]
    month = F.date_trunc("month", "o_orderdate")
    assert same(running_sum(o, ["k"], order, "v", "rt"), running_sum(o, ["k"], order, "v", "rt", bucket=month))
    assert same(neighbours(o, ["k"], order, "o_orderkey", "p", "n"),
                neighbours(o, ["k"], order, "o_orderkey", "p", "n", bucket=month))
