"""Window operators that survive a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a key
holding a third of the table makes that task a third of the job.  The
operators here take an optional ``bucket`` column, a monotone function of the
leading order column (``ranges`` makes one from its quantiles, ``hot_ranges`` one
that leaves small keys whole), and work in two levels:

1. the window runs per ``(key, bucket)``, spreading a hot key over many tasks;
2. a per-key window over *bucket summaries* (one row per bucket, taken from the
   windowed rows, so the input is read once) supplies what crosses bucket borders: the
   running offset, or the neighbour row just before / after the bucket;
3. the summaries join back on ``(key, bucket)``, the partitioning the big
   side already has after step 1.

Without ``bucket`` they are the plain single-level windows.  Results are the
same either way, given a total order within each key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_bucket"


def _same(local: DataFrame, side: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition on key and bucket; NULL keys and NULL buckets are groups like any other."""
    return reduce(lambda a, c: a & local[c].eqNullSafe(side[f"_r{c}"]), keys, local[_B].eqNullSafe(side["_rb"]))


#: ranges that ``ranges`` makes at most, and how many of them one step of its look-up passes over
MAX_RANGES, STRIDE = 1024, 32


def ranges(df: DataFrame, column: str, rows: int = 1_000_000) -> Column:
    """Buckets for ``column``: ranges with about ``rows`` rows of ``df`` each, at most ``MAX_RANGES``, from its quantiles.

    A key with a third of all rows is then spread over a third of the ranges, wherever its
    rows lie.  One scan finds the row count and the quantiles, an array of fixed size.  A row's
    range is looked up in two steps, among the cuts ``STRIDE`` apart and then between two of them.
    """
    steps = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
    n, cuts = df.agg(F.count(F.lit(1)), F.percentile_approx(column, steps, 10 * MAX_RANGES)).first()
    want = min(MAX_RANGES, -(-n // rows))
    if want <= 1 or not cuts:
        return F.lit(0)
    cuts = sorted(set(cuts[i * MAX_RANGES // want - 1] for i in range(1, want)))
    parts = [cuts[i:i + STRIDE] for i in range(0, len(cuts), STRIDE)]
    heads = F.size(F.filter(F.lit([p[0] for p in parts]), lambda c: c <= F.col(column)))
    inside = F.element_at(F.array(*[F.lit(p) for p in parts]), F.greatest(heads, F.lit(1)))
    at = F.greatest(heads - 1, F.lit(0)) * STRIDE + F.size(F.filter(inside, lambda c: c <= F.col(column)))
    return F.when(F.col(column).isNull(), -1).otherwise(at)


def hot_ranges(df: DataFrame, keys: Sequence[str], column: str, rows: int = 1_000_000) -> Column | None:
    """``ranges`` of ``column`` for the keys with more than ``rows`` rows of ``df``; one bucket for a key with fewer.

    None if no key has as many: the plain windows serve.  Cut into ranges, small keys would become about as many
    buckets as rows, and the more so the larger the table is.  ``MAX_RANGES`` keys at most are
    spread, the largest; they are known by a hash, and a small key that shares it is spread as well.
    """
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    found = large.orderBy(F.desc("_n")).limit(MAX_RANGES).select(F.xxhash64(*keys).alias("_hash")).collect()
    if not found:
        return None
    hot = F.xxhash64(*keys).isin([r["_hash"] for r in found])
    return F.when(hot, ranges(df.where(hot), column, rows)).otherwise(F.lit(0))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, out: str,
                bucket: Column | None = None) -> DataFrame:
    """``sum(value) over (partition by keys order by order rows unbounded preceding)``."""
    keys = list(keys)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(w))
    b = df.withColumn(_B, bucket)
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    local = b.withColumns({"_local": F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                           "_last": F.lead(F.lit(1)).over(w).isNull()})
    # a bucket's total stands in its last row: the windowed rows are read again, not the input
    totals = local.where("_last").select(*keys, _B, F.col("_local").alias("_bt"))
    w_prev = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias(f"_r{c}") for c in keys], F.col(_B).alias("_rb"),
                            F.sum("_bt").over(w_prev).alias("_off"))
    joined = local.join(offsets, _same(local, offsets, keys), "left")
    total = F.when(F.col("_off").isNull(), F.col("_local")).otherwise(
        F.coalesce(F.col("_local") + F.col("_off"), F.col("_off")))
    return joined.withColumn(out, total).select(*df.columns, out)


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str,
               bucket: Column | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)``: numbers within a bucket plus the rows before it."""
    counted = running_sum(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", out, bucket)
    return counted.drop("_one")


def moving_avg(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str, n: int, out: str,
               bucket: Column | None = None) -> DataFrame:
    """Mean of ``value`` (a decimal) over the current and the ``n - 1`` rows before it, as double; NULLs do not count.

    With ``bucket``, the first ``n - 1`` rows of a bucket take what they lack from a halo: the last
    ``n - 1`` values of the buckets before it, several if they are short.  A bucket
    keeps that many values at most, so the per-key step is as small as buckets times ``n``.
    """
    keys = list(keys)
    frame = (1 - n, Window.currentRow)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        return df.withColumn(out, F.try_divide(F.sum(value).over(w).cast("double"), F.count(value).over(w)))
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    local = df.withColumn(_B, bucket).withColumns({
        "_sum": F.sum(value).over(w.rowsBetween(*frame)), "_n": F.count(value).over(w.rowsBetween(*frame)),
        "_at": F.row_number().over(w),
        # a bucket's last values stand in its last row; a struct keeps NULLs in the list
        "_tail": F.when(F.lead(F.lit(1)).over(w).isNull(),
                        F.collect_list(F.struct(F.col(value).alias("v"))).over(w.rowsBetween(2 - n, Window.currentRow)))})
    if n < 2:
        return local.withColumn(out, F.try_divide(F.col("_sum").cast("double"), F.col("_n"))).select(*df.columns, out)
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(1 - n, -1)
    halo = F.flatten(F.collect_list("_tail").over(before))
    size = F.least(F.size(halo), F.lit(n - 1))
    edges = local.where(F.col("_tail").isNotNull()).select(
        *[F.col(c).alias(f"_r{c}") for c in keys], F.col(_B).alias("_rb"),
        F.slice(halo, F.size(halo) - size + 1, size).alias("_halo"))
    joined = local.join(edges, _same(local, edges, keys), "left")
    # of the halo the last n - at values are in the frame
    lack = F.greatest(F.least(F.lit(n) - F.col("_at"), F.size("_halo")), F.lit(0))
    taken = F.filter(F.slice("_halo", F.size("_halo") - lack + 1, lack), lambda x: x["v"].isNotNull())
    kind = local.schema["_sum"].dataType
    more = F.aggregate(taken, F.lit(0).cast(kind), lambda a, x: (a + x["v"]).cast(kind))
    total = F.when(F.size(taken) > 0, F.coalesce("_sum", F.lit(0).cast(kind)) + more).otherwise(F.col("_sum"))
    return joined.withColumn(out, F.try_divide(total.cast("double"), F.col("_n") + F.size(taken))).select(*df.columns, out)


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               prev_out: str, next_out: str, bucket: Column | None = None) -> DataFrame:
    """``lag(value)`` and ``lead(value)`` over ``(partition by keys order by order)``.

    ``order`` must be a total order within a key (add a unique column last).
    """
    keys = list(keys)
    order = list(order)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({prev_out: F.lag(value).over(w), next_out: F.lead(value).over(w)})
    b = df.withColumn(_B, bucket)
    w = Window.partitionBy(*keys, _B).orderBy(*order)
    local = b.withColumns({
        "_lag": F.lag(value).over(w), "_lead": F.lead(value).over(w),
        "_first": F.lag(F.lit(1)).over(w).isNull(), "_last": F.lead(F.lit(1)).over(w).isNull(),
    })
    # a bucket's border values stand in its first and last rows
    ends = local.where("_first OR _last").groupBy(*keys, _B).agg(
        F.max(F.when(F.col("_first"), F.col(value))).alias("_head"),
        F.max(F.when(F.col("_last"), F.col(value))).alias("_tail"))
    wb = Window.partitionBy(*keys).orderBy(_B)
    edges = ends.select(*[F.col(c).alias(f"_r{c}") for c in keys], F.col(_B).alias("_rb"),
                        F.lag("_tail").over(wb).alias("_prev_tail"),
                        F.lead("_head").over(wb).alias("_next_head"))
    joined = local.join(edges, _same(local, edges, keys), "left")
    return joined.withColumns({
        prev_out: F.when(F.col("_first"), F.col("_prev_tail")).otherwise(F.col("_lag")),
        next_out: F.when(F.col("_last"), F.col("_next_head")).otherwise(F.col("_lead")),
    }).select(*df.columns, prev_out, next_out)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    out: str = "rnk") -> DataFrame:
    """Rows ranked ``<= k`` within each group (ties share a rank, as ``RANK``).

    Spark inserts a per-task group limit before the shuffle for a rank filter,
    so a hot group ships at most ``k`` (plus ties) rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.rank().over(w)).where(F.col(out) <= k)
