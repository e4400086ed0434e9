"""Small keys are not cut into ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.windows import hot_ranges, neighbours


def test_only_large_keys_are_cut_into_ranges(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.lit(None).cast("long")).otherwise(F.col("id") % 500).alias("k"),
                                  ((F.col("id") * 7) % 1000).alias("at"), "id")
    assert hot_ranges(df, ["k"], "at") is None
    bucket = hot_ranges(df, ["k"], "at", rows=300)  # NULL has half of the rows
    n = {r["k"]: r["n"] for r in df.withColumn("b", bucket).groupBy("k").agg(F.countDistinct("b").alias("n")).collect()}
    assert n.pop(None) > 3 and set(n.values()) == {1}
    plain, split = (sorted(map(str, neighbours(df, ["k"], ["at", "id"], "id", "p", "n", bucket=b).collect())) for b in (None, bucket))
    assert plain == split
