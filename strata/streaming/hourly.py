"""Counts per event-time window from arriving files, with the rows that come too late listed.

Two streams, run one after the other.  The first takes the files in, splits off what does
not parse, and holds every row against the mark: the latest event time taken in by earlier runs,
less ``delay``.  A row whose window had ended by then is late: it stays in the table with its
reason, and is not counted.  The second stream counts the other rows in a watermarked state store and
appends a window once, when the watermark has passed its end; open windows stay in the state.

The mark is read from the table, so a run that dies between the streams is repaired by the next one.
The counting stream takes all that it finds as one batch (it keeps one row for each window and task),
so its watermark is never ahead of the mark that the rows were held against: it drops no row that the
first stream let pass.

Defined cases: a row without event time carries ``NO_TIME``; nothing is late in the first run, or
while no row has a time; an event time far ahead of the others moves the mark and closes the windows
before it, so bound the times in ``parse`` where sources may be wrong.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.incremental import read_if_exists
from strata.streaming.ingest import IngestResult, ingest, read_ingested

REASON, DAY = "reason", "event_day"
LATE, NO_TIME = "late", "malformed_timestamp"
EPOCH = datetime(1970, 1, 1)
_ALL_FILES = 2 ** 31 - 1


def event_mark(taken: DataFrame | None, ts: str):
    """The latest event time of the table: the last day comes from partition names, so one day is scanned."""
    if taken is None:
        return None
    last = taken.where(F.col(DAY).isNotNull()).agg(F.max(DAY)).first()[0]
    return None if last is None else taken.where(F.col(DAY) == F.lit(last)).agg(F.max(ts)).first()[0]


def cutoff(mark: datetime | None, window: timedelta, delay: timedelta) -> datetime | None:
    """Rows before this time belong to windows that had ended ``delay`` before the mark."""
    return None if mark is None else mark - delay - (mark - delay - EPOCH) % window


def _ntz(t: datetime) -> Column:
    return F.lit(str(t)).cast("timestamp_ntz")


def judged(rows: DataFrame, ts: str, before: datetime | None) -> DataFrame:
    """Rows with ``reason`` (NULL: on time) and the day that they are stored under."""
    late = F.lit(False) if before is None else F.col(ts) < _ntz(before)
    return rows.withColumns({
        REASON: F.when(F.col(ts).isNull(), NO_TIME).when(late, LATE),
        DAY: F.to_date(ts)})


def as_instant(ts: str) -> Column:
    """The instant at which it is ``ts`` in UTC, in any session zone: a watermark takes instants only."""
    parts = (F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.extract(F.lit("SECOND"), ts))
    return F.make_timestamp_ltz(*parts, F.lit("UTC"))


def from_instant(ts: str) -> Column:
    """What ``as_instant`` was given, in whole seconds."""
    zero = F.lit(0)
    return _ntz(EPOCH) + F.make_dt_interval(zero, zero, zero, F.unix_seconds(ts).cast("decimal(18,6)"))


def count_windows(spark: SparkSession, source_dir: str, taken_dir: str, counts_dir: str, checkpoint: str,
                  parse: Callable[[DataFrame], DataFrame], ts: str = "ts", window: timedelta = timedelta(hours=1),
                  delay: timedelta = timedelta(hours=2), schema: T.StructType | str = "value STRING", fmt: str = "text", **kw) -> IngestResult:
    """Take every new file of ``source_dir`` in and append the windows that are complete.

    ``parse`` (stateless) adds the ``timestamp_ntz`` column ``ts``; NULL marks a row without event time.
    ``taken_dir`` holds every row with its reason, ``counts_dir`` the closed windows (``window_start, n``).
    Both spans are whole seconds; windows start at multiples of theirs.
    """
    before = cutoff(event_mark(read_if_exists(spark, taken_dir), ts), window, delay)
    width, wait = (f"{int(d.total_seconds())} seconds" for d in (window, delay))
    got = ingest(spark, source_dir, taken_dir, f"{checkpoint}/taken", schema, fmt=fmt,
                 transform=lambda lines: judged(parse(lines), ts, before), partition_by=[DAY], **kw)

    def counted(rows: DataFrame) -> DataFrame:
        return (rows.where(F.col(REASON).isNull()).select(as_instant(ts).alias(ts)).withWatermark(ts, wait)
                .groupBy(F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
                .select(from_instant("w.start").alias("window_start"), "n"))

    ingest(spark, taken_dir, counts_dir, f"{checkpoint}/counts", f"{ts} TIMESTAMP_NTZ, {REASON} STRING",
           max_files_per_trigger=_ALL_FILES, transform=counted)
    return got


def late_rows(spark: SparkSession, taken_dir: str) -> DataFrame:
    return read_ingested(spark, taken_dir).where(F.col(REASON) == LATE)
