"""SQL-curriculum capabilities over the TPC-H tables: joins, set operations, KPI
rollups, window functions, recursive hierarchies, data-quality audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.parse import iso_date
from strata.functions.rules import round_half_up
from strata.operators.sketches import merged_count, sketches_by
from strata.operators.validate import audit
from strata.operators.windows import hot_ranges, moving_avg, neighbours, ranges, row_number, running_sum, top_k_per_group
from strata.plans.registry import query
from strata.plans.views import DUCK, VIEWS, register_tables, table, view, with_views
from strata.session import staged

@query("curr_join_inner", """
SELECT o.o_orderkey, c.c_name, c.c_mktsegment, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_curr_join_inner(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select("o_orderkey", "c_name", "c_mktsegment",
                                                                   "o_totalprice")


@query("curr_union", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT'
UNION
SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_totalprice > 300000
""")
def q_curr_union(spark, sf):
    o = table(spark, sf, "orders")
    cols = ["o_orderkey", "o_custkey", "o_orderdate"]
    urgent = o.where(F.col("o_orderpriority") == "1-URGENT").select(*cols)
    big = o.where(F.col("o_totalprice") > 300000).select(*cols)
    return urgent.unionByName(big).distinct()


@query("curr_kpi_rollup", """
SELECT c.c_mktsegment, count(*) AS orders,
  CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(round(CAST(CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS DECIMAL(38,8)), 2) AS DOUBLE) AS avg_order,
  count(DISTINCT o.o_custkey) AS customers
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment
""")
def q_curr_kpi_rollup(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum(amount).alias("_rev"),
                 F.count_distinct("o_custkey").alias("customers"))
            .select("c_mktsegment", "orders", F.col("_rev").cast("double").alias("revenue"),
                    round_half_up(F.col("_rev").cast("double") / F.col("orders")).alias("avg_order"),
                    "customers"))


@query("kpi_rollup_sets", """
SELECT c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER) AS order_year,
  CAST(grouping(c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER)) AS INTEGER) AS level, count(*) AS orders,
  CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY ROLLUP (c.c_mktsegment, CAST(year(o.o_orderdate) AS INTEGER))
""")
def q_kpi_rollup_sets(spark, sf):
    """Orders and revenue by segment and year, by segment, and in all: one scan, every row expanded to its three sets."""
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("order_year"),
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey).rollup("c_mktsegment", "order_year").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("double").alias("revenue"))


@query("kpi_distinct_merge")
def q_kpi_distinct_merge(spark, sf):
    """Customers with orders, a year: sketches of every day are stored, then united by year (an estimate, so without an oracle)."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey")
    stored = staged(sketches_by(days, ["day"], "o_custkey"), "daily-sketches")
    return merged_count(stored, [F.year("day").alias("order_year")], "customers")


@query("curr_running_total", """
SELECT o_custkey, o_orderkey, o_orderdate,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM orders
""")
def q_curr_running_total(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate",
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    out = running_sum(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "amount", "running_total",
                      bucket=hot_ranges(o, ["o_custkey"], "o_orderdate"))
    return out.select("o_custkey", "o_orderkey", "o_orderdate", F.col("running_total").cast("double"))


@query("curr_lag_lead", """
SELECT o_custkey, o_orderkey, o_orderdate,
  lag(o_orderdate) OVER w AS prev_order_date, lead(o_orderdate) OVER w AS next_order_date
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def q_curr_lag_lead(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return neighbours(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate",
                      "prev_order_date", "next_order_date", bucket=hot_ranges(o, ["o_custkey"], "o_orderdate"))


@query("curr_moving_avg", """
SELECT o_custkey, o_orderkey, o_orderdate,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(o_totalprice) OVER w AS moving_avg
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def q_curr_moving_avg(spark, sf):
    """Mean of a customer's last seven orders."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate",
                                          F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return moving_avg(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "amount", 7, "moving_avg",
                      bucket=hot_ranges(o, ["o_custkey"], "o_orderdate")).drop("amount")


@query("curr_row_number", """
SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS n
FROM orders
""")
def q_curr_row_number(spark, sf):
    """Orders of a priority (few, large groups) numbered by date."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_orderdate")
    return row_number(o, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "n", bucket=ranges(o, "o_orderdate")).drop("o_orderdate")


@query("curr_join_right", """
SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_name FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_curr_join_right(spark, sf):
    """Every customer, also one without orders."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey, "right").select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


@query("events_by_iso_day", """
SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1
""")
def q_events_by_iso_day(spark, sf):
    """Events a day, from their time as ISO-8601 text."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf, "events").select(iso_date(text).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("events"))


@query("curr_rank", """
SELECT * FROM (
  SELECT c_nationkey, c_custkey, c_acctbal,
         CAST(rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS INTEGER) AS rnk
  FROM customer) r
WHERE rnk <= 3
""")
def q_curr_rank(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return top_k_per_group(c, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], 3)


_RECURSIVE = """
WITH RECURSIVE walk(node, root_nation, depth) AS (
  SELECT node, nationkey, 0 FROM v_tree WHERE parent IS NULL
  UNION ALL
  SELECT t.node, w.root_nation, w.depth + 1 FROM v_tree t JOIN walk w ON t.parent = w.node
)
SELECT node, root_nation, depth FROM walk
"""


_RECURSIVE_ORACLE = ("WITH RECURSIVE v_tree AS (" + VIEWS["v_tree"](DUCK) + "), "
                     + _RECURSIVE.split("WITH RECURSIVE", 1)[1])


@query("curr_recursive_cte", _RECURSIVE_ORACLE)
def q_curr_recursive_cte(spark, sf):
    """Depth of every customer in the referral tree (iterative join, one level per step).

    Spark's default limits on rows and levels are lifted for this query only.
    """
    register_tables(spark, sf, ["customer"])
    view(spark, sf, "v_tree").createOrReplaceTempView("v_tree")
    lifted = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "-1"}
    before = {k: spark.conf.get(k) for k in lifted}
    try:
        for k, v in lifted.items():
            spark.conf.set(k, v)
        return staged(spark.sql(_RECURSIVE), "walk")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_AUDIT_RULES = {
    "null_created_at": "created_at IS NULL",
    "negative_amount": "total_amount < 0",
    "unknown_status": "booking_status NOT IN ('confirmed', 'cancelled', 'pending')",
    "long_stay": "nights_booked > 10",
}


@query("quality_audit", with_views(f"""
SELECT rule, violations, checked_rows FROM (
  {" UNION ALL ".join(f"SELECT '{k}' AS rule, CAST(count_if(coalesce({v}, false)) AS BIGINT) AS violations, count(*) AS checked_rows FROM a"
                      for k, v in _AUDIT_RULES.items())}
  UNION ALL SELECT 'duplicate_key', count(*) - count(DISTINCT booking_id), count(*) FROM a) r
""", "v_bookings", extra={"a": "SELECT *, CAST(round(nights_booked * booking_amount, 2) + cleaning_fee + service_fee AS DOUBLE) AS total_amount FROM v_bookings"}))
def q_quality_audit(spark, sf):
    """One pass over the bookings: NULLs, out-of-range values, unknown codes, duplicate keys."""
    bronze = view(spark, sf, "v_bookings")
    df = bronze.withColumn("total_amount", (F.round(F.col("nights_booked") * F.col("booking_amount"), 2)
                                            + F.col("cleaning_fee") + F.col("service_fee")).cast("double"))
    return audit(df, {k: F.expr(v) for k, v in _AUDIT_RULES.items()}, key=["booking_id"])
