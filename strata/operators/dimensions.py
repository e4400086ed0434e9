"""Facts and dimensions: surrogate keys that stay the same over loads, an unknown member, facts at their version.

A dimension has one row for each version of a natural key, with its own surrogate key and the time
span for which it holds.  New versions are numbered after the highest key in use by
partition offsets: each task numbers its sorted range, and the row counts of the ranges before it
are added, so no global window puts all rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.incremental import scd2
from strata.session import staged

#: the surrogate key of facts whose dimension row is not known
UNKNOWN = 0


def numbered(df: DataFrame, order: Sequence[str], after: int, out: str) -> DataFrame:
    """``df`` with consecutive numbers ``after + 1, ...`` in the order of ``order`` (NULLs first)."""
    rows = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {"_part": F.spark_partition_id(), "_id": F.monotonically_increasing_id()}), "ranges")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))  # one row for each task
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n")
    number = F.lit(after) + F.col("_before") + F.col("_id") - F.col("_first") + 1
    return rows.join(starts, "_part").select(*df.columns, number.alias(out))


def load_dimension(dimension: DataFrame | None, versions: DataFrame, key: str, valid_from: str, sk: str = "sk") -> DataFrame:
    """``dimension`` with the versions that it does not hold yet: ``sk``, the columns of ``versions``, ``valid_to``, ``is_current``.

    A version is known by its natural key and ``valid_from`` (of versions that share both, the one
    least in all columns counts); one that is there keeps its surrogate key, and only
    ``valid_to`` and ``is_current`` move when later ones come.  The first load adds the
    unknown member (``UNKNOWN``, all else NULL).  Versions without a natural key are left out:
    facts without a key belong to the unknown member.
    """
    cols = versions.columns
    rest = [c for c in cols if c not in (key, valid_from)]
    one = versions.where(F.col(key).isNotNull()).groupBy(key, valid_from).agg(F.min(F.struct(*rest)).alias("_rest")) \
        .select(key, valid_from, *[F.col(f"_rest.{c}").alias(c) for c in rest]).select(*cols)
    if dimension is None:
        known, last = None, UNKNOWN
    else:
        known = dimension.where(F.col(sk) != UNKNOWN).select(sk, *cols)
        last = dimension.agg(F.max(sk)).first()[0]
        held = known.select(F.col(key).alias("_k"), F.col(valid_from).alias("_from"))
        one = one.join(held, (F.col(key) == F.col("_k")) & F.col(valid_from).eqNullSafe(F.col("_from")), "left_anti")
    new = numbered(one, [key, valid_from], last, sk).select(F.col(sk).cast("long").alias(sk), *cols)
    spans = scd2(new if known is None else known.unionByName(new), [key], valid_from, tie_break=[sk])
    unknown = versions.sparkSession.range(1).select(
        F.lit(UNKNOWN).cast("long").alias(sk), *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in cols],
        F.lit(None).cast(versions.schema[valid_from].dataType).alias("valid_to"), F.lit(True).alias("is_current"))
    return unknown.unionByName(spans.select(*unknown.columns))


def at_version(facts: DataFrame, dimension: DataFrame, key: str, at: str, valid_from: str, sk: str = "sk", out: str | None = None) -> DataFrame:
    """``facts`` with the surrogate key of the version that holds at ``at``; ``UNKNOWN`` where there is none.

    An equi-join on the natural key, of which a fact meets the few versions; the spans do not
    overlap, so no fact comes twice.
    """
    d = dimension.where(F.col(sk) != UNKNOWN).select(
        F.col(key).alias("_k"), F.col(valid_from).alias("_from"), F.col("valid_to").alias("_to"), F.col(sk).alias("_sk"))
    hit = (F.col(key) == F.col("_k")) & (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return facts.join(d, hit, "left").select(*facts.columns, F.coalesce("_sk", F.lit(UNKNOWN).cast("long")).alias(out or sk))
