"""Sinks: overwrite, append, CSV publishing and truncate.

A table is never overwritten while it is an input of the same job.  Every output is
written by as many tasks as its data needs; a sorted output is partitioned by range,
so its part files follow the order.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _norm_path(p: str) -> str:
    return re.sub(r"^file:/*", "/", p).rstrip("/")


def _roots(df: DataFrame) -> list[str]:
    """Root folders of the file relations in the plan (not their files, which grow with the table)."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    except AttributeError:  # Spark Connect has no plan here
        return df.inputFiles()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("LogicalRelation") or leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            relation = leaf.relation()
            if hasattr(relation, "location") and relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                out += [paths.apply(k).toString() for k in range(paths.size())]
    return out


def _reads_from(df: DataFrame, path: str) -> bool:
    target = _norm_path(path) + "/"
    return any((_norm_path(f) + "/").startswith(target) or target.startswith(_norm_path(f) + "/") for f in _roots(df))


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet",
                    partition_by: Sequence[str] | None = None, **options) -> None:
    """Replace the whole table at ``path``, all its partitions too.  A job may not overwrite
    a table it reads (the old files would vanish mid-read): write to a new path for that.

    With ``partition_by`` the rows of a partition are brought together first, and a large one is dealt to several tasks:
    the files are about as many as the partitions, not partitions times tasks."""
    if _reads_from(df, path):
        raise ValueError(f"{path} is an input of this write; write to a new path instead")
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.mode("overwrite").format(fmt).options(**{"partitionOverwriteMode": "static", **options})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_append(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    df.write.mode("append").format(fmt).options(**options).save(path)


def publish_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with a header, one file for each task."""
    df.write.mode("overwrite").option("header", header).csv(path)


def publish_sorted_csv(df: DataFrame, path: str, order: Sequence[str], header: bool = True) -> None:
    """A summary CSV sorted by ``order``: partitioned by range, so the part files' names follow the order."""
    publish_csv(df.orderBy(*order), path, header)


def dated_path(base: str, name: str, run_date: str, stem: str | None = None) -> str:
    """``<base>/<name>/<stem>_<YYYY-MM-DD>`` (run date is a parameter, never the clock)."""
    return f"{base.rstrip('/')}/{name}/{stem or name}_{run_date}"


def publish_csv_dated(df: DataFrame, base: str, name: str, run_date: str, stem: str | None = None, **kw) -> str:
    path = dated_path(base, name, run_date, stem)
    publish_csv(df, path, **kw)
    return path


def truncate(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """Empty the table at ``path`` but keep its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").format(fmt).save(path)


def create_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Create the catalog table ``name`` with the rows of ``df``, or replace it.

    Each run writes a new folder below ``path`` and then points the table at it, so a run that dies leaves
    the table as it was, readers of the old rows keep their files, and ``df`` may read the table itself.
    A table of other columns is dropped and created anew; its old files stay.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(folder)
    if spark.catalog.tableExists(name):
        if spark.table(name).schema == spark.read.format(fmt).load(folder).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    spark.catalog.createTable(name, path=folder, source=fmt)
