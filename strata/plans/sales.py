"""Sales cleaning with tax, daily revenue and quality counters.

Row-wise Python loops of the source jobs become one projection + one partial
aggregate.  Rejects are a table, not log lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.parse import parse_date
from strata.functions.rules import money, strict_int
from strata.operators.validate import REASON, split_valid, tag_rejects, write_split
from strata.plans.registry import query
from strata.plans.views import view, with_views
from strata.session import scratch_path
from strata.sources.readers import read_csv_typed
from strata.sources.sinks import publish_sorted_csv

# fixed values of the source jobs
TAX_RATE = "1.18"


def tax_checks(raw: DataFrame):
    """Amount is parsed before the date, so a row bad in both is a ``bad_amount``."""
    return [("bad_amount", money("amount").isNull()), ("bad_date", parse_date("date").isNull())]


def clean_with_tax(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows with ``date`` as a date and ``total_with_tax``, rejects with a reason).

    A missing ``amount`` or ``date`` column rejects every row (the tax job reads
    fields with defaults); the revenue job, in contrast, fails on a missing column.
    """
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in ("id", "amount", "date") if c not in raw.columns})
    clean, rejects = split_valid(raw, tax_checks(raw))
    clean = clean.withColumns({
        "date": parse_date("date"),
        "total_with_tax": F.round(money("amount", 34, 6) * F.lit(TAX_RATE).cast("decimal(3,2)"), 2).cast("double"),
    })
    return clean, rejects.select("id", F.col(REASON).alias("reason"))


def line_total(raw: DataFrame) -> DataFrame:
    """price (any decimal text) x quantity (integer text only); NULL when either is bad."""
    return raw.withColumn("line_total", F.col("price").try_cast("decimal(27,6)") * strict_int("quantity"))


def daily_revenue(raw: DataFrame) -> DataFrame:
    """Sum of valid line totals per raw date text, rounded after summing, sorted by date."""
    return (line_total(raw).where(F.col("line_total").isNotNull())
            .groupBy(F.col("date").alias("Date"))
            .agg(F.round(F.sum("line_total"), 2).cast("double").alias("Total_Daily_Revenue"))
            .orderBy("Date"))


def quality_counts(raw: DataFrame) -> DataFrame:
    """Both jobs' valid/total counters in one aggregate pass (partial per task)."""
    line_ok = (F.col("price").try_cast("decimal(27,6)") * strict_int("quantity")).isNotNull()
    tax_ok = money("amount").isNotNull() & parse_date("date").isNotNull()
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(line_ok).alias("revenue_valid_rows"),
        F.count_if(~line_ok).alias("revenue_rejected_rows"),
        F.count_if(tax_ok).alias("tax_valid_rows"),
        F.count_if(~tax_ok).alias("tax_rejected_rows"),
    )


# ---------------------------------------------------------------- oracles

_AMOUNT = "TRY_CAST(amount AS DECIMAL(30,6))"
# the tax is reckoned apart from the amount: 18 hundredths of it, and rounded once by whole ten-thousandths
_TAXED = f"(CAST({_AMOUNT} * 1000000 AS HUGEINT) * 118 + 500000) // 1000000"
_DATE = "TRY_STRPTIME(date, '%Y-%m-%d')"
_QTY = "CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+') THEN TRY_CAST(quantity AS INTEGER) END"
_LINE = f"TRY_CAST(price AS DECIMAL(27,6)) * ({_QTY})"

SQL_SALES_CLEAN = with_views(f"""
SELECT id, CAST({_DATE} AS DATE) AS date, amount, price, quantity, item,
       CAST({_TAXED} AS DOUBLE) / 100 AS total_with_tax
FROM v_raw_sales WHERE {_AMOUNT} IS NOT NULL AND {_DATE} IS NOT NULL
""", "v_raw_sales")

SQL_SALES_REJECTS = with_views(f"""
SELECT id, CASE WHEN {_AMOUNT} IS NULL THEN 'bad_amount' ELSE 'bad_date' END AS reason
FROM v_raw_sales WHERE {_AMOUNT} IS NULL OR {_DATE} IS NULL
""", "v_raw_sales")

SQL_DAILY_REVENUE = with_views(f"""
SELECT date AS Date, CAST(round(sum({_LINE}), 2) AS DOUBLE) AS Total_Daily_Revenue
FROM v_raw_sales WHERE {_LINE} IS NOT NULL GROUP BY date ORDER BY date
""", "v_raw_sales")

SQL_QUALITY = with_views(f"""
SELECT count(*) AS total_rows,
       CAST(count_if({_LINE} IS NOT NULL) AS BIGINT) AS revenue_valid_rows,
       CAST(count_if({_LINE} IS NULL) AS BIGINT) AS revenue_rejected_rows,
       CAST(count_if({_AMOUNT} IS NOT NULL AND {_DATE} IS NOT NULL) AS BIGINT) AS tax_valid_rows,
       CAST(count_if({_AMOUNT} IS NULL OR {_DATE} IS NULL) AS BIGINT) AS tax_rejected_rows
FROM v_raw_sales
""", "v_raw_sales")


@query("sales_clean", SQL_SALES_CLEAN)
def q_sales_clean(spark, sf):
    return clean_with_tax(view(spark, sf, "v_raw_sales"))[0]


@query("sales_rejects", SQL_SALES_REJECTS)
def q_sales_rejects(spark, sf):
    return clean_with_tax(view(spark, sf, "v_raw_sales"))[1]


@query("daily_revenue", SQL_DAILY_REVENUE)
def q_daily_revenue(spark, sf):
    return daily_revenue(view(spark, sf, "v_raw_sales"))


@query("sales_quality_counts", SQL_QUALITY)
def q_sales_quality_counts(spark, sf):
    return quality_counts(view(spark, sf, "v_raw_sales"))


@query("daily_revenue_csv", SQL_DAILY_REVENUE)
def q_daily_revenue_csv(spark, sf):
    """The daily revenue as a two-column CSV sorted by date, read back."""
    path = scratch_path(spark, "daily_revenue")
    publish_sorted_csv(daily_revenue(view(spark, sf, "v_raw_sales")), path, ["Date"])
    return read_csv_typed(spark, path, "Date STRING, Total_Daily_Revenue DOUBLE")


@query("sales_split_written", with_views(f"""
SELECT CASE WHEN reason IS NULL THEN 'clean' ELSE 'reject' END AS status, reason, count(*) AS row_count FROM (
  SELECT CASE WHEN {_AMOUNT} IS NULL THEN 'bad_amount' WHEN {_DATE} IS NULL THEN 'bad_date' END AS reason FROM v_raw_sales) t
GROUP BY ALL
""", "v_raw_sales"))
def q_sales_split_written(spark, sf):
    """Clean rows and rejects written in one pass, partitioned by status; a second run replaces both."""
    raw = view(spark, sf, "v_raw_sales")
    path = scratch_path(spark, "sales_split")
    for _ in range(2):
        write_split(tag_rejects(raw, tax_checks(raw)), path)
    return spark.read.parquet(path).groupBy("status", F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))
