"""Row validation: every input row lands in exactly one of (clean, rejects).

Checks are evaluated once as columns; the first failing check names the
reason, in the order given (the order the source jobs parse fields in).  Both
outputs come from the same projected frame, so ``clean ∪ rejects`` is the
input.  ``write_split`` materialises both in a single pass as one dataset
partitioned by status, instead of two jobs over the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "_reject_reason"


def tag_rejects(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``_reject_reason``: the name of the first check whose *bad* condition holds."""
    expr = None
    for name, bad in checks:
        cond = F.coalesce(bad, F.lit(False))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(REASON, expr if expr is not None else F.lit(None).cast("string"))


def split_valid(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    tagged = tag_rejects(df, checks)
    clean = tagged.where(F.col(REASON).isNull()).drop(REASON)
    rejects = tagged.where(F.col(REASON).isNotNull())
    return clean, rejects


def write_split(tagged: DataFrame, path: str, fmt: str = "parquet") -> dict:
    """One job writes ``status=clean`` and ``status=reject`` folders and returns the
    row counts, observed while writing (no second pass over the input)."""
    obs = Observation("split_counts")
    out = tagged.withColumn("status", F.when(F.col(REASON).isNull(), "clean").otherwise("reject"))
    out = out.observe(obs, F.count(F.lit(1)).alias("total_rows"),
                      F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
                      F.count_if(F.col(REASON).isNotNull()).alias("rejected_rows"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("status").format(fmt).save(path)
    return obs.get


def counters(tagged: DataFrame) -> DataFrame:
    """One-row totals: all, valid, rejected (a single aggregate, partial per task)."""
    return tagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON).isNull()).alias("valid_rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected_rows"),
    )


def audit(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str] | None = None) -> DataFrame:
    """Data-quality audit in one pass: rule -> number of violating rows.

    ``rules`` maps a rule name to a *violation* condition (NULL counts as no
    violation).  With ``key``, a ``duplicate_key`` rule counts rows beyond the
    first per key (exact; the distinct count is a two-phase aggregate).
    """
    aggs = [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()]
    aggs.append(F.count(F.lit(1)).alias("_rows"))
    names = list(rules)
    if key:
        aggs.append(F.count_distinct(*[F.col(k) for k in key]).alias("_distinct_keys"))
    wide = df.agg(*aggs)
    if key:
        wide = wide.withColumn("duplicate_key", F.col("_rows") - F.col("_distinct_keys"))
        names.append("duplicate_key")
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (rule, violations)", "_rows AS checked_rows")
