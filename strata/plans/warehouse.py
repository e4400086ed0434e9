"""Warehouse loads and storage round trips.

The playlist tables are published as dated CSV folders, then bulk-loaded into
typed tables by a path pattern (columns by position, ``NULL``/``null``/empty
as NULL), truncated and reloaded, and counted.  The remaining keys exercise
each reader and sink on the driver tables through real files in the shared
scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.validate import REASON, split_valid
from strata.plans import playlist as P
from strata.plans.registry import query
from strata.plans.views import table, with_views
from strata.session import scratch_path
from strata.sources.readers import (
    bulk_load_csv, file_manifest, length_violations, read_csv_strings, read_csv_typed, read_parquet,
)
from strata.sources.sinks import publish_csv_dated, truncate, write_overwrite

RUN_DATE = "2024-06-30"

# target table definitions of the warehouse load (fixed values)
ALBUM_DDL = "album_id VARCHAR(100), name VARCHAR(100), release_date DATE, total_tracks INT, url VARCHAR(200)"
ARTIST_DDL = "artist_id VARCHAR(100), artist_name VARCHAR(100), external_url VARCHAR(200)"
SONG_DDL = ("song_id VARCHAR(100), song_name VARCHAR(100), duration_ms INT, url VARCHAR(200), popularity INT, "
            "song_added TIMESTAMP_NTZ, album_id VARCHAR(100), artist_id VARCHAR(100)")
PATTERNS = {"album": ".*album_transformed.*.csv", "artist": ".*artist_transformed.*.csv",
            "songs": ".*song_transformed.*.csv"}


def publish_playlist(spark: SparkSession, sf: str, tables=("album", "artist", "songs")) -> str:
    """albums / artists / songs as CSV under ``<root>/<table>/<name>_transformed_<date>/``."""
    root = scratch_path(spark, "transformed_data")
    builders = {"album": (P.albums, "album_transformed", P.ALBUM_SCHEMA), "artist": (P.artists, "artist_transformed", P.ARTIST_SCHEMA),
                "songs": (P.songs, "song_transformed", P.PLAYLIST_SCHEMA)}
    # one table takes its part of the documents alone; several share what is parsed once
    docs = P.load_docs(spark, sf, bronze=len(tables) > 1, schema=P.PLAYLIST_SCHEMA if len(tables) > 1 else builders[tables[0]][2])
    for name in tables:
        build, stem, _ = builders[name]
        publish_csv_dated(build(docs), root, name, RUN_DATE, stem=stem)
    return root


def load_by_pattern(spark: SparkSession, root: str, pattern: str, ddl: str) -> DataFrame:
    """Bulk load: files below ``root`` matching ``pattern`` into the typed layout ``ddl``."""
    return bulk_load_csv(spark, root, ddl, pattern=pattern)


def load_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per loaded table, one report (each count is a partial aggregate over its files)."""
    parts = []
    for name, ddl in (("album", ALBUM_DDL), ("artist", ARTIST_DDL), ("songs", SONG_DDL)):
        df = load_by_pattern(spark, root, PATTERNS[name], ddl)
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- oracles

SQL_ALBUM_LOADED = P.SQL_ALBUMS.replace(
    "total_tracks, album_url AS url FROM flat", "CAST(total_tracks AS INTEGER) AS total_tracks, album_url AS url FROM flat")

@query("scan_by_path_regex", SQL_ALBUM_LOADED)
def q_scan_by_path_regex(spark, sf):
    """Only the album files are picked from the published folder (pattern on the full path)."""
    root = publish_playlist(spark, sf, tables=("album", "artist"))
    return load_by_pattern(spark, root, PATTERNS["album"], ALBUM_DDL)


def _count_sql() -> str:
    ctes = P._EXTRA
    albums = P.SQL_ALBUMS[P.SQL_ALBUMS.index("\nSELECT DISTINCT"):]
    artists = P.SQL_ARTISTS[P.SQL_ARTISTS.index("\nSELECT DISTINCT"):]
    songs = P.SQL_SONGS[P.SQL_SONGS.index("\nSELECT * EXCLUDE"):]
    return with_views(f"""
SELECT 'album' AS table_name, count(*) AS row_count FROM ({albums}) a
UNION ALL SELECT 'artist', count(*) FROM ({artists}) b
UNION ALL SELECT 'songs', count(*) FROM ({songs}) c
""", extra=ctes)


@query("load_counts", _count_sql())
def q_load_counts(spark, sf):
    return load_counts(spark, publish_playlist(spark, sf))


@query("bulk_load_csv", """
SELECT s_suppkey,
  CASE WHEN s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 THEN NULL ELSE s_name END AS s_name,
  CAST(s_nationkey AS INTEGER) AS s_nationkey,
  CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal
FROM supplier
""")
def q_bulk_load_csv(spark, sf):
    """Supplier exported with null tokens and other header names, loaded back by position."""
    path = scratch_path(spark, "supplier_csv")
    sup = table(spark, sf, "supplier")
    dirty = sup.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit("NULL")).when(F.col("s_suppkey") % 11 == 0, F.lit("null"))
        .otherwise(F.col("s_name")).alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.when(F.col("s_suppkey") % 13 == 0, F.lit(None)).otherwise(F.col("s_acctbal")).alias("balance"))
    dirty.write.option("header", True).csv(path)
    return bulk_load_csv(spark, path, T.StructType.fromDDL(
        "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"))


@query("truncate_reload", SQL_ALBUM_LOADED)
def q_truncate_reload(spark, sf):
    """Load albums into a table, truncate it (schema kept, zero rows), load again."""
    root = publish_playlist(spark, sf, tables=("album",))
    target = scratch_path(spark, "tbl_album")
    loaded = load_by_pattern(spark, root, PATTERNS["album"], ALBUM_DDL)
    write_overwrite(loaded, target)
    truncate(spark, target, spark.read.parquet(target).schema)
    write_overwrite(load_by_pattern(spark, root, PATTERNS["album"], ALBUM_DDL), target)
    return spark.read.parquet(target)


URL_LIMIT = 40  # declared VARCHAR length of the typed page table (ours)


def split_lengths(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = pages.select("page_id", "url")
    return split_valid(rows, [("over_length", length_violations(rows, {"url": URL_LIMIT}))])


@query("typed_load_with_length_check", f"SELECT page_id, url FROM pages WHERE length(url) <= {URL_LIMIT}")
def q_typed_load_with_length_check(spark, sf):
    """Over-length values go to rejects first; the rest is inserted into a VARCHAR(n) table,
    whose own length check would otherwise fail the whole insert."""
    clean = split_lengths(table(spark, sf, "pages"))[0]
    location = scratch_path(spark, "tbl_pages")
    name = "pages_typed_" + location.rsplit("-", 1)[-1]
    spark.sql(f"CREATE TABLE {name} (page_id BIGINT, url VARCHAR({URL_LIMIT})) USING parquet "
              f"LOCATION '{location}'")
    try:
        clean.write.insertInto(name)
        return spark.read.schema("page_id BIGINT, url STRING").parquet(location)
    finally:
        spark.sql(f"DROP TABLE {name}")  # an external table: its files stay


@query("typed_load_rejects", f"SELECT page_id, url, 'over_length' AS reason FROM pages WHERE length(url) > {URL_LIMIT}")
def q_typed_load_rejects(spark, sf):
    """The over-length rows, with the reason."""
    return split_lengths(table(spark, sf, "pages"))[1].withColumnRenamed(REASON, "reason")


@query("scan_parquet", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
""")
def q_scan_parquet(spark, sf):
    return read_parquet(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                        F.col("o_orderdate") >= F.expr("TIMESTAMP_NTZ'1998-01-01 00:00:00'"))


ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@query("scan_csv_typed", "SELECT * FROM orders")
def q_scan_csv_typed(spark, sf):
    path = scratch_path(spark, "orders_csv")
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return read_csv_typed(spark, path, ORDERS_DDL)


@query("scan_csv_strings", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer
""")
def q_scan_csv_strings(spark, sf):
    path = scratch_path(spark, "customer_csv")
    table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment") \
        .write.option("header", True).csv(path)
    return read_csv_strings(spark, path)


@query("write_overwrite", "SELECT * FROM supplier")
def q_write_overwrite(spark, sf):
    """A second overwrite replaces, never adds to, the first."""
    path = scratch_path(spark, "supplier")
    write_overwrite(table(spark, sf, "supplier"), path)
    write_overwrite(table(spark, sf, "supplier"), path)
    return spark.read.parquet(path)


@query("write_overwrite_schema", "SELECT p_partkey, upper(p_brand) AS brand, p_size * 2 AS size2 FROM part")
def q_write_overwrite_schema(spark, sf):
    """Overwriting with a different column set replaces the table's schema."""
    path = scratch_path(spark, "part")
    write_overwrite(table(spark, sf, "part"), path)
    write_overwrite(table(spark, sf, "part").select(
        "p_partkey", F.upper("p_brand").alias("brand"), (F.col("p_size") * 2).alias("size2")), path)
    return spark.read.parquet(path)


#: events in a file of a day's folder at most: a hot day is many files, written by many tasks
FILE_EVENTS = 5000


@query("file_manifest", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(DISTINCT event_id // {FILE_EVENTS}) AS INTEGER) AS files
FROM events GROUP BY 1
""")
def q_file_manifest(spark, sf):
    """Events land in day folders, a file for each range of ids; the report counts a day's files, from a listing
    alone (contents never read)."""
    path = scratch_path(spark, "events_by_day")
    events = table(spark, sf, "events").withColumns({
        "day": F.to_date("ts"), "slice": F.floor(F.col("event_id") / FILE_EVENTS).cast("int")})
    events.repartition("day", "slice").write.partitionBy("day", "slice").parquet(path)
    folder = F.regexp_extract("path", "/day=([0-9-]+)/", 1)
    return file_manifest(spark, path).where(folder != "").groupBy(folder.alias("day")) \
        .agg(F.count(F.lit(1)).cast("int").alias("files"))


@query("publish_provenance", with_views(f"""
SELECT *, 'album_transformed_{RUN_DATE}' AS source_file FROM ({P.SQL_ALBUMS[P.SQL_ALBUMS.index(chr(10) + "SELECT DISTINCT"):]}) a
""", extra=P._EXTRA))
def q_publish_provenance(spark, sf):
    """Published rows carry the dated file they belong to, so a load can be traced to its publication."""
    root = scratch_path(spark, "provenance")
    albums = P.albums(P.load_docs(spark, sf, schema=P.ALBUM_SCHEMA))
    stamped = albums.withColumn("source_file", F.lit(f"album_transformed_{RUN_DATE}"))
    publish_csv_dated(stamped, root, "album", RUN_DATE, stem="album_transformed")
    return bulk_load_csv(spark, root, "album_id STRING, name STRING, release_date DATE, total_tracks BIGINT, url STRING, "
                         "source_file STRING", pattern=PATTERNS["album"])


@query("publish_traced", P._traced_sql(
    "album_id", f"album_id, album_name AS name, {P._RD} AS release_date, total_tracks, album_url AS url", "playlist_id, chunk, item_no"))
def q_publish_traced(spark, sf):
    """Published albums say which document, item and file they came from and how many documents had them."""
    root = scratch_path(spark, "traced")
    publish_csv_dated(P.traced_albums(P.traced_items(spark, P.land_arrivals(spark, sf))), root, "album", RUN_DATE,
                      stem="album_transformed")
    loaded = bulk_load_csv(spark, root, "album_id STRING, name STRING, release_date DATE, total_tracks BIGINT, url STRING, "
                           "playlist_id BIGINT, chunk BIGINT, item_no INT, source_file STRING, documents BIGINT",
                           pattern=PATTERNS["album"])
    return loaded.select("*", P._arrival()).drop("source_file")
