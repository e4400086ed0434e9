"""Partitioned writes: files as many as partitions; upserts touch only what their batch changes."""

from __future__ import annotations

import glob

from strata.operators import incremental
from strata.operators.incremental import upsert_latest
from strata.session import scratch_path
from strata.sources.sinks import write_overwrite

ROWS = [(1, "a", 1, 0), (2, "b", 1, 0), (11, "c", 1, 1), (99, "n", 1, None)]


def files(path):
    return sorted(glob.glob(f"{path}/*=*/*.*"))


def test_partitioned_write_has_a_file_for_each_partition(spark):
    path = scratch_path(spark, "parts")
    write_overwrite(spark.range(4000).repartition(8).selectExpr("id", "id % 40 AS p"), path, partition_by=["p"])
    assert len(files(path)) == 40
    assert spark.read.parquet(path).count() == 4000


def test_touched_partitions_as_a_list_and_as_a_join(spark, monkeypatch):
    path, kind = scratch_path(spark, "live"), "id int, v string, at int, part int"
    write_overwrite(spark.createDataFrame(ROWS, kind), path, partition_by=["part"])
    new = spark.createDataFrame([(1, "z", 2, 0), (99, "m", 3, None)], kind)
    want = {(1, "z", 2, 0), (2, "b", 1, 0), (11, "c", 1, 1), (99, "m", 3, None)}
    for most in (1024, 1):
        monkeypatch.setattr(incremental, "LISTED", most)
        got = upsert_latest(spark.read.parquet(path), new, ["id"], ["at"], "part").select("id", "v", "at", "part")
        assert {tuple(r) for r in got.collect()} == want and got.count() == 4
