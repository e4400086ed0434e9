"""Schema tracking for streams of JSON lines: the caller declares no columns.

Before a run, the fields of the files that came since the last run are found on the cluster
(one row for each field and kind of value leaves a task) and merged into the newest stored
version of the schema.  The list of versions lies beside the checkpoint.  The merge only adds:

* a new field becomes a column; a field that was always null or absent is none yet;
* BIGINT widens to DOUBLE; any other change leaves the column's type as it was;
* objects and arrays are kept as their JSON text (a STRING column).

What does not fit is kept, not lost: ``_rescued`` holds a JSON object of the fields of a line that are
no column or whose value is not of the column's type, or the whole line where it is no JSON
object (or names a field twice).  Names that differ in case only share no column: the name stored first, else the
first in sorting order, has it and the others are rescued, as are fields named like the two columns added here.
Blank lines are no rows.

The table is partitioned by ``_schema_version``; ``read_tracked`` reads each version with its own schema and
casts it to the newest, so a widened column needs no rewrite.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.incremental import read_if_exists
from strata.streaming.ingest import IngestResult, ingest

RESCUED, VERSION = "_rescued", "_schema_version"

#: files this much older than the newest one seen are looked at once more (a store's clock may be coarse)
OVERLAP_S = 2
_STORE = "version INT, schema STRING, mark_s BIGINT"

#: column types, narrowest first, with the kinds of value that fit them; every value fits a STRING
_KINDS = {"BIGINT": ["BIGINT"], "DOUBLE": ["BIGINT", "DOUBLE"], "BOOLEAN": ["BOOLEAN"]}
_TYPES = {"BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType(), "STRING": T.StringType()}


def _fields(col: str) -> Column:
    """A line's fields as ``map<string,variant>``; NULL where the line is no JSON object."""
    return F.try_variant_get(F.try_parse_json(col), "$", "map<string,variant>")


def _kind(value: Column) -> Column:
    """BIGINT, DOUBLE, BOOLEAN or STRING (everything else); NULL for a null."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "VOID", None).when(kind.isin("BIGINT", "BOOLEAN"), kind)
            .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "DOUBLE").otherwise("STRING"))


def schema_of_lines(lines: DataFrame, col: str = "value") -> T.StructType:
    """The columns that JSON lines ask for, sorted by name; what reaches the driver is one row for each field."""
    found = lines.select(F.explode(_fields(col)).alias("name", "_v")).select("name", _kind(F.col("_v")).alias("kind"))
    rows = found.where("kind IS NOT NULL").groupBy("name").agg(F.collect_set("kind").alias("kinds")).collect()
    types = {r["name"]: next((t for t, fits in _KINDS.items() if set(r["kinds"]) <= set(fits)), "STRING") for r in rows}
    return T.StructType([T.StructField(n, _TYPES[types[n]]) for n in sorted(types)])


def merged(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` with the new fields of ``seen`` after its own, and BIGINT widened where ``seen`` has DOUBLE."""
    wider = {f.name for f in seen if f.dataType == T.DoubleType()}
    out = [T.StructField(f.name, T.DoubleType() if f.dataType == T.LongType() and f.name in wider else f.dataType)
           for f in known]
    taken = {f.name.lower() for f in known} | {RESCUED, VERSION}
    for f in seen:
        if f.name.lower() not in taken:
            taken.add(f.name.lower())
            out.append(f)
    return T.StructType(out)


def typed_lines(lines: DataFrame, schema: T.StructType, version: int, col: str = "value") -> DataFrame:
    """JSON lines as the columns of ``schema``, then ``_rescued`` and ``_schema_version``."""
    rows = lines.where(F.trim(col) != "").select(F.col(col).alias("_line"), _fields(col).alias("_f"))

    def fits(value: Column, dtype: T.DataType) -> Column:
        kinds = _KINDS.get(dtype.simpleString().upper())
        return F.lit(True) if kinds is None else F.coalesce(_kind(value).isin(kinds), F.lit(True))

    def typed(f: T.StructField) -> Column:
        value = F.try_element_at("_f", F.lit(f.name))
        return F.when(fits(value, f.dataType), F.try_variant_get(value, "$", f.dataType.simpleString())).alias(f.name)

    def stays(name: Column, value: Column) -> Column:
        # a null that no column holds says nothing
        return reduce(lambda a, f: F.when(name == f.name, ~fits(value, f.dataType)).otherwise(a), schema.fields,
                      ~F.is_variant_null(value))

    left = F.map_filter("_f", stays)
    rescued = F.when(F.col("_f").isNull(), F.col("_line")).when(F.size(left) > 0, F.to_json(left))
    return rows.select(*[typed(f) for f in schema], rescued.alias(RESCUED), F.lit(version).alias(VERSION))


def versions(spark: SparkSession, checkpoint: str) -> list[tuple[int, T.StructType, int]]:
    """The stored ``(version, schema, mark)`` entries, oldest first: one for each run that found files."""
    stored = read_if_exists(spark, _store(checkpoint))
    rows = [] if stored is None else stored.select("version", "schema", "mark_s").collect()
    return sorted(((r.version, T.StructType.fromDDL(r.schema) if r.schema else T.StructType(), r.mark_s) for r in rows),
                  key=lambda v: (v[0], v[2]))


def _store(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_schemas"


def _since(reader: DataFrameReader, mark: int | None) -> DataFrameReader:
    if mark is None:
        return reader
    at = datetime.fromtimestamp(mark - OVERLAP_S, timezone.utc)
    return reader.options(modifiedAfter=at.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC")


def track(spark: SparkSession, source_dir: str, checkpoint: str) -> tuple[int, T.StructType]:
    """Look at the files that came since the last call, store what they add, return the newest version.

    A file is looked at by its modification time.  One that is missed (it came late with an old
    time, or while this ran) loses nothing: its new fields are rescued.
    """
    known = versions(spark, checkpoint)
    version, schema, mark = known[-1] if known else (0, T.StructType(), None)
    files = _since(spark.read.format("binaryFile").option("recursiveFileLookup", True), mark).load(source_dir)
    n, newest = files.agg(F.count("path"), F.max(F.unix_seconds("modificationTime"))).first()
    if not n:
        return version, schema
    lines = _since(spark.read.option("recursiveFileLookup", True), mark).text(source_dir)
    grown = merged(schema, schema_of_lines(lines))
    if grown != schema or not known:
        version, schema = version + 1, grown
    if not known or (version, newest) != (known[-1][0], mark):
        entry = spark.createDataFrame([(version, _ddl(schema), max(newest, mark or newest))], _STORE)
        entry.coalesce(1).write.mode("append").parquet(_store(checkpoint))
    return version, schema


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def ingest_tracked(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str, **kw) -> IngestResult:
    """Take every file of JSON lines not yet ingested into ``table_dir``, with the columns found in them."""
    version, schema = track(spark, source_dir, checkpoint)
    return ingest(spark, source_dir, table_dir, checkpoint, "value STRING", fmt="text",
                  transform=lambda lines: typed_lines(lines, schema, version), partition_by=[VERSION], **kw)


def read_tracked(spark: SparkSession, table_dir: str, checkpoint: str) -> DataFrame:
    """The committed rows under the newest schema, with ``_rescued`` and the version each row was written with."""
    by_version = {v: s for v, s, _ in versions(spark, checkpoint)}
    if not by_version:
        raise ValueError(f"{checkpoint} has no stored schema: nothing has been ingested")
    newest = by_version[max(by_version)]
    parts = []
    for v, schema in sorted(by_version.items()):
        whole = T.StructType(schema.fields + [T.StructField(RESCUED, T.StringType()), T.StructField(VERSION, T.IntegerType())])
        rows = spark.read.schema(whole).parquet(table_dir).where(F.col(VERSION) == v)
        has = set(schema.names)
        parts.append(rows.select(*[(F.col(_quoted(f.name)) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name)
                                   for f in newest], RESCUED, VERSION))
    return reduce(DataFrame.unionByName, parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
