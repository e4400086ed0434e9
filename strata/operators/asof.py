"""As-of join: each left row meets the last right row of its key that is not later.

No range join: both sides are united and sorted by time within a key, and the last right
row seen is carried on to the left rows after it.  With ``bucket`` (``windows.ranges`` of the time) a
hot key is spread over its buckets; a bucket that starts without a right row takes the last one of the
buckets before it, from one summary row for each key and bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_bucket"


def both_times(left: DataFrame, right: DataFrame, left_at: str, right_at: str, keys: Sequence[str] = ()) -> DataFrame:
    """The times of both sides as one column ``at``, for ``ranges``; with ``keys`` also these, as ``_k0``, ... for ``hot_ranges``."""
    key = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    return left.select(*key, F.col(left_at).alias("at")).unionAll(right.select(*key, F.col(right_at).alias("at")))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str,
              values: Mapping[str, str], bucket: Column | None = None) -> DataFrame:
    """``left`` with ``{new name: column of right}`` of the last right row of its key at or before ``left_at``.

    Every left row comes back once.  Of right rows with one key and time the greatest by the values, in
    their order, counts (NULL least).  A row with a NULL key or time matches nothing; an unmatched left row has NULLs.
    ``bucket`` is an expression over a column ``at`` (and the keys as ``_k0``, ...), for each key monotone in
    ``at``, the same for both sides.
    """
    key = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    seen = F.struct(F.col(right_at).alias("at"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())])
    events = (right.select(*key, F.col(right_at).alias("at"), seen.alias("_r"))
              .where(F.col("at").isNotNull()).dropna(subset=names).withColumn("_l", F.lit(None))
              .unionByName(left.select(*key, F.col(left_at).alias("at"), F.lit(None).alias("_r"), F.struct("*").alias("_l"))))
    by = names if bucket is None else [*names, _B]
    if bucket is not None:
        events = events.withColumn(_B, bucket)
    # right rows come before left rows of the same time, the greatest last
    order = Window.partitionBy(*by).orderBy(F.col("at").asc_nulls_first(), F.col("_r").isNull(), "_r")
    carried = events.withColumn("_c", F.last("_r", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if bucket is not None:
        carried = carried.withColumn("_end", F.lead(F.lit(1)).over(order).isNull())
        before = Window.partitionBy(*names).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
        # a bucket's last right row stands in its last row
        ends = carried.where("_end").select(*[F.col(c).alias(f"_s{c}") for c in by],
                                            F.last("_c", ignorenulls=True).over(before).alias("_p"))
        same = F.lit(True)
        for c in by:
            same = same & carried[c].eqNullSafe(ends[f"_s{c}"])
        carried = carried.join(ends, same, "left").withColumn("_c", F.coalesce("_c", "_p"))
    known = F.col("at").isNotNull()
    return carried.where(F.col("_l").isNotNull()).select(
        "_l.*", *[F.when(known, F.col(f"_c.v{i}")).alias(n) for i, n in enumerate(values)])
