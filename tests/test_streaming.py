"""Stream ingestion: exactly once across runs, archival of finished files."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from strata.plans.streams import Landing
from strata.plans.views import table
from strata.session import local_path
from tests.conftest import SF_SMALL


def _files(path):
    return [p for p in glob.glob(os.path.join(local_path(path), "**", "*.parquet"), recursive=True)]


def test_archive_moves_finished_files_and_keeps_rows_once(spark):
    ev = table(spark, SF_SMALL, "events")
    s = Landing(spark, "test_archive")
    seen = []
    for k in range(3):
        s.land(ev.where(F.col("event_id") % 3 == k).coalesce(1))
        r = s.run(ev.schema, archive_dir=s.archive)
        seen.append((s.read().count(), r.rows))
    assert seen[-1][0] == ev.count()
    assert [n for n, _ in seen] == sorted(n for n, _ in seen)
    assert len(_files(s.archive)) >= 1          # earlier batches' files were moved
    assert len(_files(s.inbox)) <= 2            # the newest batch may stay until the next run


def test_rerun_without_new_files_adds_nothing(spark):
    ev = table(spark, SF_SMALL, "events")
    s = Landing(spark, "test_rerun")
    s.land(ev)
    first = s.run(ev.schema)
    second = s.run(ev.schema)
    assert first.rows == ev.count() and second.rows == 0
    assert s.read().count() == ev.count()
