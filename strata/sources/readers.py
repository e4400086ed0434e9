"""Typed and tolerant readers.

Text sources always get an explicit schema (inference costs a pass over the
data and drifts between files).  File selection by path pattern uses the
``_metadata.file_path`` column, which Spark evaluates per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import staged


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 where: Column | str | None = None) -> DataFrame:
    """Parquet scan; ``columns`` and ``where`` reach the scan as ReadSchema / PushedFilters."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A layer table by path in a table format (parquet by default; delta if installed)."""
    return spark.read.format(fmt).load(path)


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                   **options) -> DataFrame:
    """CSV with a header and a declared schema (by name order)."""
    return spark.read.options(header=header, **options).schema(schema).csv(path)


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     header: bool = True, **options) -> DataFrame:
    """CSV where every field stays text (a dictionary-reader view of the file)."""
    reader = spark.read.options(header=header, **options)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def bulk_load_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                  null_tokens: Sequence[str] = ("NULL", "null"), empty_as_null: bool = True,
                  skip_header: bool = True, pattern: str | None = None, **options) -> DataFrame:
    """Load CSV into a typed table, columns matched **by position**.

    Fields equal to a null token (and empty fields) become NULL; every other
    field is converted with ``try_cast`` to the declared type (NULL if it does
    not convert; VARCHAR(n) stays text, see ``length_violations``).  With
    ``pattern``, only files below ``path`` whose full path matches are loaded.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    opts = dict(header=skip_header, enforceSchema=True, **options)
    if pattern:
        raw = read_by_path_regex(spark, path, pattern, "csv", text_schema, **opts)
    else:
        raw = spark.read.options(**opts).schema(text_schema).csv(path)
    return typed_text(raw, schema, null_tokens, empty_as_null)


def typed_text(raw: DataFrame, schema: T.StructType | str, null_tokens: Sequence[str] = ("NULL", "null"),
               empty_as_null: bool = True) -> DataFrame:
    """Text columns to the declared types; null tokens (and empty fields) become NULL."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    exprs = {}
    for f in schema.fields:
        c = F.col(f.name)
        is_null = c.isin(*null_tokens) if null_tokens else F.lit(False)
        if empty_as_null:
            is_null = is_null | (c == F.lit(""))
        text = isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
        target = T.StringType() if text else f.dataType
        value = c if text else c.try_cast(target)
        exprs[f.name] = F.when(is_null, F.lit(None).cast(target)).otherwise(value)
    return raw.withColumns(exprs)


def read_by_path_regex(spark: SparkSession, root: str, pattern: str, fmt: str = "csv",
                       schema: T.StructType | str | None = None, **options) -> DataFrame:
    """All files below ``root`` (recursively) whose full path matches ``pattern``."""
    reader = spark.read.format(fmt).options(recursiveFileLookup=True, **options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(root)
    cols = [c for c in df.columns]
    return df.where(F.col("_metadata.file_path").rlike(pattern)).select(*cols)


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType | str,
                   multi_line: bool = False, suffix: str | None = ".json", with_source: bool = False) -> DataFrame:
    """JSON documents below ``path``: one per line (splittable) or one per file (``multi_line``);
    optionally the ``source_file`` of each."""
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if suffix:
        # plain or compressed (``part-….json.gz``) files
        reader = reader.option("pathGlobFilter", f"*{suffix}{{,.gz,.bz2,.deflate,.lz4,.snappy}}")
    docs = reader.json(path)
    return docs.withColumn("source_file", F.col("_metadata.file_path")) if with_source else docs


def read_json_records(spark: SparkSession, path: str, multi_line: bool = False,
                      out: str = "v") -> DataFrame:
    """JSON records as ``variant`` values (JSON null and a missing key stay different).

    A line (or, with ``multi_line``, a whole file) may hold one object or an
    array of objects; arrays yield one row per element.
    """
    docs = spark.read.option("singleVariantColumn", "_doc").option("multiLine", multi_line).json(path)
    elems = F.coalesce(F.try_variant_get("_doc", "$", "array<variant>"), F.array(F.col("_doc")))
    return docs.select(F.explode(elems).alias(out))


def read_text_lines(spark: SparkSession, path: str, with_source: bool = False) -> DataFrame:
    """Text lines as ``value``; optionally the source file of each line."""
    df = spark.read.text(path)
    return df.withColumn("source_file", F.col("_metadata.file_path")) if with_source else df


def read_numbered_lines(spark: SparkSession, path: str, keep: Column | None = None) -> DataFrame:
    """Text lines with their file and place: ``value, source_file, line_no`` (from 1, as an editor shows them).

    A file is read in blocks, each by one task from its first line to its last, so a line's place in
    its block is a difference of row ids.  The lines are written once with their block; the
    second pass adds up the line counts of a file's earlier blocks (one row for each block), and only
    lines for which ``keep`` holds meet them.  No line is sorted and no file goes through one task.
    """
    lines = staged(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id")), "lines")
    blocks = lines.groupBy("source_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long"))).drop("_n")
    kept = lines if keep is None else lines.where(keep)
    return kept.join(starts, ["source_file", "_block"]).select(
        "value", "source_file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"))


def file_manifest(spark: SparkSession, path: str, glob: str | None = None,
                  recursive: bool = True) -> DataFrame:
    """Listing of files (path, length, modificationTime); file contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def length_violations(df: DataFrame, limits: dict[str, int]) -> Column:
    """True where any text column is longer than its declared VARCHAR(n)."""
    cond = F.lit(False)
    for c, n in limits.items():
        cond = cond | F.coalesce(F.length(c) > n, F.lit(False))
    return cond
