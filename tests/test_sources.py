"""Readers and sinks on small files."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import types as T

from strata.functions.rules import bucketize, cast_by_spec
from strata.session import local_path, scratch_path
from strata.sources.readers import bulk_load_csv, file_manifest, read_by_path_regex
from strata.sources.sinks import create_table, publish_csv, write_overwrite


def test_strict_and_lenient_integer_casts(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("x",)], "v STRING")
    strict = [r.v for r in cast_by_spec(df, {"int": ["v"]}).collect()]
    lenient = [r.v for r in cast_by_spec(df, {"int": ["v"]}, lenient=True).collect()]
    assert strict == [12, None, None] and lenient == [12, 12, None]


def test_bucketize_directions_and_nulls(spark):
    df = spark.createDataFrame([(96,), (80,), (10,), (None,)], "r INT")
    desc = [r[0] for r in df.select(bucketize("r", [(95, "VG"), (80, "G")], "P", descending=True)).collect()]
    asc = [r[0] for r in df.select(bucketize("r", [(50, "low")], "high", null_label="none")).collect()]
    assert desc == ["VG", "G", "P", "P"] and asc == ["high", "high", "low", "none"]


def test_csv_has_one_file_for_each_task(spark):
    path = scratch_path(spark, "published")
    publish_csv(spark.range(2000).repartition(4), path)
    assert len(glob.glob(os.path.join(local_path(path), "part-*.csv"))) == 4


def test_path_regex_prunes_non_matching_files(spark):
    root = scratch_path(spark, "prune")
    spark.createDataFrame([(1, 2)], "x INT, y INT").write.option("header", True).csv(f"{root}/a/a_transformed_1")
    spark.createDataFrame([("bad", "2")], "x STRING, y STRING").write.option("header", True).csv(f"{root}/b/b_other_1")
    df = read_by_path_regex(spark, root, ".*a_transformed.*", "csv", "x INT, y INT", header=True, mode="FAILFAST")
    assert [tuple(r) for r in df.collect()] == [(1, 2)]   # the malformed file is never opened


def test_manifest_lists_without_reading(spark):
    root = scratch_path(spark, "manifest")
    spark.range(10).repartition(3).write.csv(root)
    m = file_manifest(spark, root, glob="*.csv")
    assert m.count() >= 1 and set(m.columns) == {"path", "length", "modificationTime"}


def test_bulk_load_by_position_with_null_tokens(spark):
    path = scratch_path(spark, "bulk")
    spark.createDataFrame([("1", "NULL", "x"), ("2", "null", ""), ("3", "ok", "7")], "a STRING, b STRING, c STRING") \
        .write.option("header", True).csv(path)
    schema = T.StructType.fromDDL("id BIGINT, name STRING, n INT")
    rows = sorted(tuple(r) for r in bulk_load_csv(spark, path, schema).collect())
    assert rows == [(1, None, None), (2, None, None), (3, "ok", 7)]


def test_partitioned_overwrite_replaces_all_partitions(spark):
    path = scratch_path(spark, "shrinking")
    write_overwrite(spark.range(40).selectExpr("id", "id % 4 AS p"), path, partition_by=["p"])
    write_overwrite(spark.range(1).selectExpr("id", "id % 4 AS p"), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 1


def test_sorted_summary_csv(spark):
    from strata.sources.sinks import publish_sorted_csv

    df = spark.createDataFrame([("2026-03-04", 300.0), ("2026-03-03", 401.0)], "Date STRING, Total DOUBLE")
    path = scratch_path(spark, "summary")
    publish_sorted_csv(df, path, ["Date"])
    files = sorted(glob.glob(os.path.join(local_path(path), "part-*.csv")))
    lines = [x for f in files for x in open(f).read().splitlines() if x != "Date,Total"]
    assert lines == ["2026-03-03,401.0", "2026-03-04,300.0"]


def test_overwrite_of_an_input_is_refused(spark):
    import pytest

    path = scratch_path(spark, "self_overwrite")
    write_overwrite(spark.range(3), path)
    with pytest.raises(ValueError):
        write_overwrite(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 3


def test_created_table_is_replaced_whole(spark, tmp_path):
    name, path = "created_" + tmp_path.name.replace("-", "_"), str(tmp_path / "t")
    try:
        create_table(spark.range(5), name, path)
        old = spark.table(name)
        create_table(spark.table(name).where("id > 2"), name, path)       # reads the table that it replaces
        assert sorted(r.id for r in spark.table(name).collect()) == [3, 4]
        assert old.count() == 5 or old.count() == 2                       # either state is whole, no file is missing
        create_table(spark.range(2).selectExpr("id", "'x' AS v"), name, path)
        assert spark.table(name).columns == ["id", "v"] and spark.table(name).count() == 2
        with pytest.raises(Exception):
            create_table(spark.range(3).selectExpr("id", "raise_error('dies') AS v"), name, path)
        assert spark.table(name).count() == 2                             # a run that dies leaves the table as it was
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
