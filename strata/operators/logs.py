"""Server-log analytics over ``ts | LEVEL | message`` text lines.

A line counts when ``ERROR`` appears anywhere in it (so an INFO line whose
message mentions ERROR is counted, as in the source job).  Its first ``|``
field must parse as ``yyyy-M-d H:m:s`` (padded or not); otherwise it goes to
the rejects.  Aggregates are partial-then-final hash aggregates: a day or hour
holding a third of all lines costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.parse import parse_ts, split_trim

MARKER = "ERROR"


def error_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines mentioning ERROR, split into trimmed fields, with the parsed timestamp."""
    parts = split_trim(col, "|")
    return (lines.where(F.col(col).contains(MARKER))
            .withColumn("_parts", parts)
            .withColumns({"ts": parse_ts(F.get("_parts", 0)),
                          "level": F.get("_parts", 1),
                          "message": F.get("_parts", 2)})
            .drop("_parts"))


def parsed_errors(lines: DataFrame, col: str = "value") -> DataFrame:
    return error_lines(lines, col).where(F.col("ts").isNotNull())


def rejected_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    return (error_lines(lines, col).where(F.col("ts").isNull())
            .drop("ts", "level", "message")
            .withColumn("reason", F.lit("malformed_timestamp")))


def errors_daily(parsed: DataFrame) -> DataFrame:
    return (parsed.groupBy(F.to_date("ts").alias("Date"))
            .agg(F.count(F.lit(1)).alias("Total_Errors")).orderBy("Date"))


def errors_hourly(parsed: DataFrame) -> DataFrame:
    """Errors per hour of day (0-23) across all days, with the first time each hour was seen."""
    return (parsed.groupBy(F.hour("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("errors"), F.min("ts").alias("first_seen")))


def peak_hour(parsed: DataFrame) -> DataFrame:
    """Arg-max hour; ties go to the hour seen first (top-1, no global sort)."""
    return (errors_hourly(parsed)
            .orderBy(F.desc("errors"), F.asc("first_seen"), F.asc("hour")).limit(1)
            .select(F.col("hour").alias("peak_hour"), F.col("errors").alias("peak_count")))


def summary(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row: total errors, days with errors, rejected lines, peak hour and its count.

    One scan: the lines are aggregated per (day, hour) (rejects form the NULL
    slot); per-hour totals are a window over that small aggregate (at most
    days x 24 rows), and a single global aggregate derives every figure; the
    peak hour is the ``max_by`` of (errors, earliest first sighting, lowest hour).
    """
    by_slot = (error_lines(lines, col)
               .groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_seen")))
    w = Window.partitionBy("hour")
    slots = by_slot.withColumns({"hour_n": F.sum("n").over(w), "hour_first": F.min("first_seen").over(w)})
    ok = F.col("day").isNotNull()
    rank_key = F.when(ok, F.struct(F.col("hour_n"), -F.unix_micros(F.col("hour_first").cast("timestamp")),
                                   -F.col("hour")))
    return slots.agg(
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("total_errors"),
        F.count_distinct(F.col("day")).alias("error_days"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("rejected_lines"),
        F.max_by(F.col("hour"), rank_key).alias("peak_hour"),
        F.max(F.when(ok, F.col("hour_n"))).alias("peak_count"),
    )
