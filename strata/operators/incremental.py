"""Incremental loads: high-water mark, append-new, keyed upsert, SCD2 history.

The mark is derived from the target itself (``max`` of the incremental column,
first run = 1900-01-01), never from a side file written after the load, so a
crash between load and bookkeeping cannot skip or duplicate rows.  The mark is
resolved to a literal of the column's own type before filtering, which lets
the comparison reach the Parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.parse import parse_ts, parse_ts_strict
from strata.operators.dedup import latest_per_key
from strata.operators.windows import neighbours
from strata.session import staged
from strata.sources.sinks import write_append, write_overwrite

FIRST_MARK = "1900-01-01 00:00:00"
#: touched partitions that ``upsert_latest`` lists for the scan at most
LISTED = 1024


def _typed_literal(value, dtype: T.DataType):
    text = str(value)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"TIMESTAMP'{text}'")
    if isinstance(dtype, T.DateType):
        return F.expr(f"DATE'{text[:10]}'")
    return F.lit(value).cast(dtype)


def typed_source(df: DataFrame, col: str, pattern: str = "yyyy-M-d H:m:s",
                 on_bad: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """Parse the incremental column from text.

    ``on_bad="fail"``: a malformed value fails the whole batch, as the source job
    did.  ``on_bad="reject"``: malformed rows are split off as rejects and the rest
    loads.  Both use one parser, so they agree on what is malformed.
    """
    if on_bad == "fail":
        return df.withColumn(col, parse_ts_strict(col, pattern)), None
    parsed = df.withColumn("_parsed", parse_ts(col, pattern))
    good = parsed.where(F.col("_parsed").isNotNull()).drop(col).withColumnRenamed("_parsed", col)
    bad = parsed.where(F.col("_parsed").isNull()).drop("_parsed")
    return good.select(*df.columns), bad


def high_water_mark(target: DataFrame | None, col: str, default: str = FIRST_MARK):
    """``coalesce(max(col), default)`` of the target: one scalar."""
    if target is None:
        return default
    value = target.agg(F.max(col)).first()[0]
    return default if value is None else value


def rows_after(source: DataFrame, col: str, mark, inclusive: bool = False) -> DataFrame:
    """Rows strictly newer than ``mark`` (``inclusive`` also takes rows equal to it)."""
    lit = _typed_literal(mark, source.schema[col].dataType)
    return source.where(F.col(col) >= lit if inclusive else F.col(col) > lit)


def new_rows(source: DataFrame, target: DataFrame | None, col: str, inclusive: bool = False) -> DataFrame:
    return rows_after(source, col, high_water_mark(target, col), inclusive)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if there is none yet. Any other failure to read it is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_new(spark: SparkSession, source: DataFrame, target_path: str, col: str,
               inclusive_key: Sequence[str] | None = None) -> None:
    """Append rows newer than the target's mark to the target (first run: all rows).

    A re-run with no newer source rows appends nothing: the mark moved with the data.  With
    ``inclusive_key`` rows equal to the mark are taken too, unless the target has their key at
    the mark already: a row that arrives late in the mark's own second is not lost, and none comes twice.
    """
    target = read_if_exists(spark, target_path)
    if inclusive_key is None or target is None:
        write_append(new_rows(source, target, col), target_path)
        return
    mark = high_water_mark(target, col)
    at_mark = target.where(F.col(col) == _typed_literal(mark, target.schema[col].dataType))
    known = at_mark.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(inclusive_key)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(inclusive_key)])
    new = rows_after(source, col, mark, inclusive=True).join(
        known.withColumn("_at", _typed_literal(mark, source.schema[col].dataType)), same & (F.col(col) == F.col("_at")), "left_anti")
    write_append(staged(new, "late"), target_path)


def upsert_latest(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                  part: str | None = None) -> DataFrame:
    """``target`` with ``batch`` merged in: per key the latest row by ``order`` (ties broken on all columns).

    With ``part``, a column whose value never changes for a key and by which ``target``
    is partitioned, only the partitions that the batch has rows for are merged; the others
    are passed on as they are, without a shuffle.  Up to ``LISTED`` touched partitions become a filter on the
    scan, more of them a join.  ``upsert_in_place`` leaves the others where they are.
    """
    if target is None:
        return latest_per_key(batch, keys, order)
    if part is None:
        return latest_per_key(target.unionByName(batch), keys, order)
    listed = [r[0] for r in batch.select(part).distinct().limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        hit = F.col(part).isin([v for v in listed if v is not None])
        if None in listed:
            hit = hit | F.col(part).isNull()
        hit = F.coalesce(hit, F.lit(False))
        return latest_per_key(target.where(hit).unionByName(batch), keys, order).unionByName(target.where(~hit))
    merged = latest_per_key(touched_rows(target, batch, part).unionByName(batch), keys, order)
    parts = batch.select(F.col(part).alias("_part")).distinct()
    return merged.unionByName(target.join(parts, F.col(part).eqNullSafe(F.col("_part")), "left_anti"))


def touched_rows(target: DataFrame, batch: DataFrame, part: str) -> DataFrame:
    """The rows of ``target`` whose partition ``batch`` has rows for.

    A semi join on the distinct partitions: where these are few, Spark prunes the scan to them at
    run time, and no list comes to the driver.  The partition of NULL is a filter of its own.
    """
    parts = batch.select(part).distinct()
    known = target.join(parts.where(F.col(part).isNotNull()), part, "left_semi").select(*target.columns)
    no_part = parts.where(F.col(part).isNull()).select(F.lit(True).alias("_hit"))
    unknown = target.where(F.col(part).isNull()).withColumn("_hit", F.lit(True)).join(no_part, "_hit", "left_semi")
    return known.unionByName(unknown.select(*target.columns))


def publish_partitions(rows: DataFrame, path: str, part: str) -> None:
    """Replace just the partitions that ``rows`` has; all others keep their files."""
    rows.hint("rebalance", F.col(part)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(part).parquet(path)


def upsert_in_place(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                    part: str, staging: str) -> None:
    """Merge ``batch`` into the table at ``path``; only partitions that it has rows for are read and written.

    ``part`` is a column whose value never changes for a key.  The merged partitions are first
    written whole to ``staging`` (a folder of this batch alone, with a ``done`` table at its
    end), then from there into the table.  A run that died before ``done`` merges again, since it
    has changed nothing; one that died while it replaced partitions only repeats the second
    step, from files that do not depend on the table any more.  Partitions whose merged rows are all the
    table's own (a repeated batch) keep their files.
    """
    rows = f"{staging}/rows"
    if read_if_exists(spark, f"{staging}/done") is None:
        target = read_if_exists(spark, path)
        kept = batch.withColumn("_held", F.lit(False))
        if target is not None:
            held = touched_rows(target, batch, part).select(*batch.columns)
            kept = kept.unionByName(held.withColumn("_held", F.lit(True)))
        # the last column decides last: of equal rows the table's own stays
        write_overwrite(latest_per_key(kept, keys, order), rows, compression="zstd")
        spark.range(1).write.mode("overwrite").parquet(f"{staging}/done")
    merged = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("_held", T.BooleanType())])).parquet(rows)
    changed = merged.where(~F.col("_held")).select(F.col(part).alias("_part")).distinct()
    publish_partitions(merged.join(changed, F.col(part).eqNullSafe(F.col("_part")), "left_semi").drop("_held"), path, part)


def scd2(history: DataFrame, keys: Sequence[str], valid_from: str,
         tie_break: Sequence[str] = (), bucket=None) -> DataFrame:
    """Type-2 history: each version valid from its own time until the next version of its key.

    Adds ``valid_to`` (NULL for the current version) and ``is_current``, true for the
    last version of a key and no other, also where ``valid_from`` is NULL (such
    versions come first).  Versions
    of a key are ordered by ``valid_from`` then ``tie_break`` (default: all other
    columns), so equal timestamps get a deterministic order.  ``bucket`` (ranges of
    ``valid_from``, see ``windows.ranges``) spreads a key with very many
    versions over many tasks.
    """
    keys = list(keys)
    tb = list(tie_break) or [c for c in history.columns if c not in keys and c != valid_from]
    row = F.struct(F.col(valid_from).alias("at"))  # never NULL itself, so a missing one means the last version
    out = neighbours(history.withColumn("_at", row), keys, [valid_from, *tb], "_at", "_prev", "_next", bucket=bucket)
    return out.select(*history.columns, F.col("_next.at").alias("valid_to"), F.col("_next").isNull().alias("is_current"))


def scd2_merge(history: DataFrame, batch: DataFrame, keys: Sequence[str], valid_from: str,
               tie_break: Sequence[str] = (), bucket=None) -> DataFrame:
    """``history`` (a result of ``scd2``) with a batch of further versions, in any order of time.

    Only keys of the batch are worked on: their versions, old and new, get their intervals
    anew, so a late version splits the interval it falls into, one at the time of
    another comes before or after it by ``tie_break``, and one that is there already
    changes nothing.  The versions of all other keys pass through, without a sort.
    """
    keys, cols = list(keys), batch.columns
    touched = batch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    old = history.join(touched, same, "left_semi").select(*cols)
    merged = scd2(old.unionByName(batch).distinct(), keys, valid_from, tie_break, bucket)
    return history.join(touched, same, "left_anti").unionByName(merged)
