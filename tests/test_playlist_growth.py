"""Documents: one file for an arrival, items compiled before they are collected, one table parses its own fields."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from strata.plans import playlist as P
from strata.sources.readers import read_json_docs


def files(path):
    return sorted(glob.glob(f"{path}/*=*/*.*"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders 0 .. 3999 of three lines, one of them with 130; 40 parts, 7 suppliers."""
    root = str(tmp_path_factory.mktemp("tables"))
    lines = spark.range(12130).select(
        F.when(F.col("id") < 12000, F.floor(F.col("id") / 3)).otherwise(F.lit(77)).alias("l_orderkey"),
        (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"), (F.col("id") % 3 + 1).alias("l_linenumber"),
        F.expr("CAST(date_add(DATE'1995-01-01', CAST(id % 900 AS INT)) AS TIMESTAMP_NTZ)").alias("l_shipdate"))
    lines.repartition(8).write.parquet(f"{root}/lineitem.parquet")
    spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("part "), F.col("id")).alias("p_name"),
                           (F.col("id") % 9).alias("p_size")).write.parquet(f"{root}/part.parquet")
    spark.range(7).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), F.col("id")).alias("s_name")) \
        .write.parquet(f"{root}/supplier.parquet")
    return root


def test_an_arrival_is_one_file_in_order(spark, tables):
    path = P.land_arrivals(spark, tables)
    assert [f.split("/")[-2] for f in files(path)] == [f"arrival={i}" for i in range(4)]
    docs = read_json_docs(spark, path, P.PLAYLIST_SCHEMA).collect()
    assert sum(len(d["items"]) for d in docs) == 12130
    assert sorted(len(d["items"]) for d in docs if d["playlist_id"] == 77) == [33, 50, 50]
    for d in docs:
        order = [(i["track"]["id"], i["track"]["album"]["id"], i["added_at"]) for i in d["items"]]
        assert order == sorted(order)


def test_one_table_parses_its_own_fields(spark, tables):
    for schema, build in ((P.ALBUM_SCHEMA, P.albums), (P.ARTIST_SCHEMA, P.artists)):
        narrow, whole = (sorted(build(P.load_docs(spark, tables, schema=s)).collect()) for s in (schema, P.PLAYLIST_SCHEMA))
        assert narrow == whole and whole


def test_items_are_projected_before_they_are_collected(spark, tables):
    plan = P.playlist_docs(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(item#" in plan
