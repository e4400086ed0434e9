"""A repeated batch leaves the files of an upserted table alone."""

from __future__ import annotations

import glob
import os

from strata.operators.incremental import upsert_in_place

ROWS = [(1, "a", 1, 0), (2, "b", 1, 0), (11, "c", 1, 1), (99, "n", 1, None)]


def files(path):
    return sorted(glob.glob(f"{path}/*=*/*.*"))


def test_a_repeated_batch_keeps_every_file(spark, tmp_path):
    live, kind = str(tmp_path / "live"), "id int, v string, at int, part int"
    for turn, rows in enumerate((ROWS, ROWS, [(1, "z", 2, 0), (11, "c", 1, 1), (99, "n", 1, None)])):
        upsert_in_place(spark, live, spark.createDataFrame(rows, kind), ["id"], ["at"], "part", str(tmp_path / f"s{turn}"))
        now = {os.path.dirname(f): f for f in files(live)}
        if turn == 1:
            assert now == before
        if turn == 2:
            assert [os.path.basename(p) for p in now if now[p] != before[p]] == ["part=0"]
        before = now
    got = {(r["id"], r["v"], r["at"], r["part"]) for r in spark.read.parquet(live).collect()}
    assert got == {(1, "z", 2, 0), *ROWS[1:]}
