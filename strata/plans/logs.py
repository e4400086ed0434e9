"""Log error analysis over the stand-in log lines (``events`` rendered as text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import logs as L
from strata.plans.registry import query
from strata.plans.views import view, with_views
from strata.session import scratch_path
from strata.sources.readers import read_csv_typed, read_numbered_lines, read_text_lines
from strata.sources.sinks import publish_sorted_csv
from strata.streaming import hourly as H
from strata.streaming.ingest import read_ingested

_STRIP = "' ' || chr(9)"  # the white space in the stand-in lines


def _field(i: int) -> str:
    return f"trim(split_part(value, '|', {i}), {_STRIP})"


_TS = f"CASE WHEN NOT regexp_matches({_field(1)}, ':60$') THEN try_strptime({_field(1)}, '%Y-%m-%d %H:%M:%S') END"
_ERR = f"SELECT value, line_no, {_TS} AS ts FROM v_logs WHERE contains(value, 'ERROR')"
_EXTRA = {"err": _ERR, "ok": "SELECT * FROM err WHERE ts IS NOT NULL"}
_HOURLY = "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS errors, min(ts) AS first_seen FROM ok GROUP BY 1"
_PEAK = f"SELECT hour AS peak_hour, errors AS peak_count FROM ({_HOURLY}) h ORDER BY errors DESC, first_seen, hour LIMIT 1"


def _oracle(body: str) -> str:
    return with_views(body, "v_logs", extra=_EXTRA)


@query("log_parse", _oracle(
    f"SELECT ts, {_field(2)} AS level, {_field(3)} AS message FROM ok"))
def q_log_parse(spark, sf):
    """Lines go through real text files: written once, scanned with the text source."""
    path = scratch_path(spark, "logs")
    view(spark, sf, "v_logs").select("value").write.text(path)
    return L.parsed_errors(read_text_lines(spark, path)).select("ts", "level", "message")


@query("log_rejects", _oracle("SELECT line_no, value, 'malformed_timestamp' AS reason FROM err WHERE ts IS NULL"))
def q_log_rejects(spark, sf):
    return L.rejected_lines(view(spark, sf, "v_logs"))


@query("log_rejects_numbered", with_views("""
SELECT chunk, line_no, value, 'malformed_timestamp' AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY event_id) AS line_no FROM (
    SELECT line_no AS event_id, value, CAST(line_no // 1000 AS INTEGER) AS chunk FROM v_logs) l) n
WHERE contains(value, 'ERROR') AND (CASE WHEN NOT regexp_matches(trim(split_part(value, '|', 1), ' ' || chr(9)), ':60$')
  THEN try_strptime(trim(split_part(value, '|', 1), ' ' || chr(9)), '%Y-%m-%d %H:%M:%S') END) IS NULL
""", "v_logs"))
def q_log_rejects_numbered(spark, sf):
    """Log files of a thousand events; every rejected line with its file and its number there."""
    path = scratch_path(spark, "log_files")
    lines = view(spark, sf, "v_logs").withColumn("chunk", F.floor(F.col("line_no") / 1000).cast("int"))
    lines.repartition("chunk").sortWithinPartitions("chunk", "line_no").select("value", "chunk").write.partitionBy("chunk").text(path)
    bad = L.rejected_lines(read_numbered_lines(spark, path, F.col("value").contains(L.MARKER)))
    return bad.select(F.regexp_extract("source_file", "chunk=([0-9]+)", 1).cast("int").alias("chunk"), "line_no", "value", "reason")


@query("log_errors_daily", _oracle(
    "SELECT CAST(ts AS DATE) AS Date, count(*) AS Total_Errors FROM ok GROUP BY 1 ORDER BY 1"))
def q_log_errors_daily(spark, sf):
    return L.errors_daily(L.parsed_errors(view(spark, sf, "v_logs")))


@query("log_errors_csv", _oracle(
    "SELECT CAST(ts AS DATE) AS Date, count(*) AS Total_Errors FROM ok GROUP BY 1"))
def q_log_errors_csv(spark, sf):
    """The daily summary as a two-column CSV sorted by date, read back."""
    path = scratch_path(spark, "log_summary")
    publish_sorted_csv(L.errors_daily(L.parsed_errors(view(spark, sf, "v_logs"))), path, ["Date"])
    return read_csv_typed(spark, path, "Date DATE, Total_Errors BIGINT")


@query("log_errors_hourly", _oracle(_HOURLY))
def q_log_errors_hourly(spark, sf):
    return L.errors_hourly(L.parsed_errors(view(spark, sf, "v_logs")))


@query("log_peak_hour", _oracle(_PEAK))
def q_log_peak_hour(spark, sf):
    return L.peak_hour(L.parsed_errors(view(spark, sf, "v_logs")))


@query("log_summary", _oracle(f"""
SELECT (SELECT count(*) FROM ok) AS total_errors,
       (SELECT count(DISTINCT CAST(ts AS DATE)) FROM ok) AS error_days,
       (SELECT count(*) FROM err WHERE ts IS NULL) AS rejected_lines,
       (SELECT peak_hour FROM ({_PEAK}) p) AS peak_hour,
       (SELECT peak_count FROM ({_PEAK}) p) AS peak_count
"""))
def q_log_summary(spark, sf):
    return L.summary(view(spark, sf, "v_logs")).select(
        "total_errors", "error_days", "rejected_lines", "peak_hour", F.col("peak_count"))


#: error lines in three arrivals, by number; of every 23 lines one comes an arrival later
_ARRIVAL = "least(2, CAST(floor(3 * line_no / ({n})) AS INT) + CASE WHEN line_no % 23 = 0 THEN 1 ELSE 0 END)"
_ARRIVED = {**_EXTRA,
            "arrived": f"SELECT value, ts, {_ARRIVAL.format(n='SELECT max(line_no) + 1 FROM v_logs')} AS arrival FROM ok",
            "judged": """SELECT value, ts, coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark, false) AS late FROM arrived
                         JOIN (SELECT b.arrival, max(a.ts) - INTERVAL 2 HOUR AS mark FROM (SELECT DISTINCT arrival FROM arrived) b
                               LEFT JOIN arrived a ON a.arrival < b.arrival GROUP BY 1) m USING (arrival)"""}


def _three_arrivals(spark, sf) -> tuple[str, str]:
    """Runs the hourly count over the arrivals; returns its two tables."""
    root = scratch_path(spark, "errors_hourly")
    lines = view(spark, sf, "v_logs").where(F.col("value").contains(L.MARKER))
    n = view(spark, sf, "v_logs").agg(F.max("line_no") + 1).first()[0]
    arrival = F.expr(_ARRIVAL.format(n=n))
    for k in range(3):
        lines.where(arrival == k).select("value").write.mode("append").text(f"{root}/inbox")
        H.count_windows(spark, f"{root}/inbox", f"{root}/taken", f"{root}/counts", f"{root}/_checkpoint", L.error_lines)
    return f"{root}/taken", f"{root}/counts"


@query("stream_errors_hourly", with_views("""
SELECT date_trunc('hour', ts) AS window_start, count(*) AS errors FROM judged WHERE NOT late
GROUP BY 1 HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM arrived)
""", "v_logs", extra=_ARRIVED))
def q_stream_errors_hourly(spark, sf):
    """Errors per hour in event time, each hour once, when the watermark has passed it."""
    return read_ingested(spark, _three_arrivals(spark, sf)[1]).withColumnRenamed("n", "errors")


@query("stream_errors_late", with_views("SELECT ts, value FROM judged WHERE late", "v_logs", extra=_ARRIVED))
def q_stream_errors_late(spark, sf):
    """Lines that came after their hour was closed."""
    return H.late_rows(spark, _three_arrivals(spark, sf)[0]).select("ts", "value")
