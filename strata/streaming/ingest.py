"""Exactly-once file-stream ingestion.

``ingest`` runs a Structured Streaming query from a folder of arriving files
into a parquet table: the checkpoint records which files were taken, the
file sink's commit log makes each micro-batch land exactly once (a lost
executor or a rerun cannot duplicate rows), and ``availableNow`` processes
everything present, in bounded micro-batches, then stops.  Optional:

* ``archive_dir`` moves finished source files away (``cleanSource=archive``);
  a file is moved once a *later* batch has committed, so with run-to-completion
  triggers the newest batch's files stay until the next run;
* ``source_file`` keeps each row's file path, the ingest ledger's raw material.

Schema evolution is additive: a later run may declare more columns on the same
checkpoint; reading the table with ``mergeSchema`` shows NULL for older rows.
"""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"


@dataclass
class IngestResult:
    batches: int
    rows: int


class _Totals(StreamingQueryListener):
    """Batches and rows of one query run; its events arrive in order, the end of the run last."""

    def __init__(self):
        self.by_run: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self.run = ""

    def follow(self, run: str) -> None:
        self.run = run

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        seen = self.by_run[str(event.progress.runId)]
        seen[0] += 1
        seen[1] += int(event.progress.numInputRows)

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()

    def result(self) -> IngestResult:
        self.ended[self.run].wait()
        return IngestResult(*self.by_run[self.run])


def ingest(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str,
           schema: T.StructType | str, fmt: str = "parquet", archive_dir: str | None = None,
           source_file: bool = False, max_files_per_trigger: int = 1000,
           timeout_s: int | None = None, options: dict | None = None,
           transform: Callable[[DataFrame], DataFrame] | None = None,
           partition_by: Sequence[str] = ()) -> IngestResult:
    """Take every file not yet ingested from ``source_dir`` into ``table_dir`` and stop.

    ``transform`` (stateless) is applied to the rows read; ``partition_by`` lays out the table.

    Runs until everything present is taken; ``timeout_s`` sets a limit.  The totals
    come from the progress of every micro-batch, not from the few that Spark keeps.
    """
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("recursiveFileLookup", True)
              .options(**(options or {})))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.load(source_dir)
    if source_file:
        # the micro-batch's timestamp, so the ledger can tell when each file was taken
        stream = stream.withColumns({SOURCE_FILE: F.col("_metadata.file_path"),
                                     INGESTED_AT: F.current_timestamp()})
    if transform:
        stream = transform(stream)
    totals = _Totals()
    spark.streams.addListener(totals)
    try:
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = (writer.partitionBy(*partition_by) if partition_by else writer).start(table_dir)
        totals.follow(str(query.runId))
        if timeout_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout_s):
            query.stop()
            raise TimeoutError(f"stream into {table_dir} did not finish within {timeout_s}s")
        return totals.result()
    finally:
        spark.streams.removeListener(totals)


def read_ingested(spark: SparkSession, table_dir: str, merge_schema: bool = False) -> DataFrame:
    """The committed rows of a stream-fed table (uncommitted files are never visible)."""
    return spark.read.option("mergeSchema", merge_schema).parquet(table_dir)


def ledger(ingested: DataFrame, label: str | None = None) -> DataFrame:
    """Per source file (or per ``label`` regex group of its path): rows ingested and
    when the first of them was taken.

    The file path travels with the rows, so the ledger is an aggregate of the
    table itself: it cannot disagree with what was loaded.
    """
    key = F.col(SOURCE_FILE) if label is None else F.regexp_extract(SOURCE_FILE, label, 1)
    return ingested.groupBy(key.alias("source")).agg(F.count(F.lit(1)).alias("row_count"),
                                                     F.min(INGESTED_AT).alias("first_seen"))
