"""Playlist documents -> albums, artists, songs (and their warehouse load).

Stand-in documents: one playlist per order (chunks of at most 50 lines), one
item per line item; the track is the part, the album is the supplier.  They
are written as JSON Lines (splittable, unlike one document per file) and read
back with an explicit schema.  The oracles compute the same tables flat from
``lineitem ⋈ part ⋈ supplier``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.parse import iso_timestamp, parse_date_lenient
from strata.operators.dedup import keep_one, keep_one_traced
from strata.operators.nested import explode_path, first_elem_field, project
from strata.plans.registry import query
from strata.plans.views import DUCK, SPARK, Dialect, table, with_views
from strata.session import scratch_path
from strata.sources.readers import read_json_docs

DOC_ITEMS = 50

# fixed value of the document format: the key under ``external_urls`` holding the public URL
URL_KEY = "spotify"

PLAYLIST_SCHEMA = """
playlist_id BIGINT, chunk BIGINT,
items ARRAY<STRUCT<
  added_at: STRING,
  track: STRUCT<
    id: STRING, name: STRING, duration_ms: BIGINT, popularity: BIGINT,
    external_urls: STRUCT<{URL_KEY}: STRING>,
    artists: ARRAY<STRUCT<id: STRING, name: STRING, href: STRING>>,
    album: STRUCT<id: STRING, name: STRING, release_date: STRING, total_tracks: BIGINT,
                  external_urls: STRUCT<{URL_KEY}: STRING>, artists: ARRAY<STRUCT<id: STRING>>>>>>
""".replace("{URL_KEY}", URL_KEY)

# the parts of it that one table alone is made from: the parser passes over the other fields
ALBUM_SCHEMA = f"""
playlist_id BIGINT, items ARRAY<STRUCT<track: STRUCT<album: STRUCT<
  id: STRING, name: STRING, release_date: STRING, total_tracks: BIGINT, external_urls: STRUCT<{URL_KEY}: STRING>>>>>
"""
ARTIST_SCHEMA = "playlist_id BIGINT, items ARRAY<STRUCT<track: STRUCT<artists: ARRAY<STRUCT<id: STRING, name: STRING, href: STRING>>>>>"


def fields(d: Dialect) -> dict[str, str]:
    """Stand-in field values as SQL text over lineitem (l_), part (p_), supplier (s_)."""
    year = "CAST(1990 + s_suppkey % 30 AS STRING)"
    month = "'-0' || CAST(s_suppkey % 9 + 1 AS STRING)"
    added = ("date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")" if d.name == "spark"
             else "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ')")
    return {
        "added_at": added,
        "track_id": "'trk_' || CAST(l_partkey AS STRING)",
        "track_name": "p_name",
        "duration_ms": "p_size * 4000 + p_partkey % 1000",
        "popularity": "p_partkey % 100",
        "track_url": "'https://open.example/track/' || CAST(l_partkey AS STRING)",
        "artist1_num": "CAST(p_partkey % 97 AS STRING)",
        "artist2_num": "CAST(p_partkey % 89 + 100 AS STRING)",
        "n_artists": "CASE WHEN p_partkey % 10 = 0 THEN 0 WHEN p_partkey % 3 = 0 THEN 2 ELSE 1 END",
        "album_id": "'alb_' || CAST(s_suppkey AS STRING)",
        "album_name": "'Album ' || s_name",
        "release_date": (f"CASE s_suppkey % 4 WHEN 1 THEN {year} || {month} WHEN 2 THEN {year} "
                         f"ELSE {year} || {month} || '-1' || CAST(s_suppkey % 9 AS STRING) END"),
        "total_tracks": "s_suppkey % 20 + 1",
        "album_url": "'https://open.example/album/' || CAST(s_suppkey AS STRING)",
        "album_artist_id": "'art_' || CAST(s_suppkey % 97 AS STRING)",
        "n_album_artists": "CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END",
    }


def _artist(num_expr: str):
    num = F.expr(num_expr)
    return F.struct(F.concat(F.lit("art_"), num).alias("id"), F.concat(F.lit("Artist "), num).alias("name"),
                    F.concat(F.lit("https://api.example/artists/"), num).alias("href"))


def playlist_docs(spark: SparkSession, sf: str, arrival: Column | None = None) -> DataFrame:
    """Nested documents built on the cluster, 50 items each at most: an order's lines are numbered first
    (line numbers repeat within an order, so they are no bound themselves).

    With ``arrival``, a function of ``l_orderkey``, all documents of an arrival are made by one task (they have it
    as a column) and their items are in the order of track, album and time.
    """
    f = {k: F.expr(v) for k, v in fields(SPARK).items()}
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    supp = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    rows = li.join(part, li.l_partkey == part.p_partkey).join(supp, li.l_suppkey == supp.s_suppkey)
    artists = F.slice(F.array(_artist(fields(SPARK)["artist1_num"]), _artist(fields(SPARK)["artist2_num"])),
                      1, f["n_artists"])
    album = F.struct(
        f["album_id"].alias("id"), f["album_name"].alias("name"), f["release_date"].alias("release_date"),
        f["total_tracks"].alias("total_tracks"), F.struct(f["album_url"].alias(URL_KEY)).alias("external_urls"),
        F.slice(F.array(F.struct(f["album_artist_id"].alias("id"))), 1, f["n_album_artists"]).alias("artists"))
    track = F.struct(
        f["track_id"].alias("id"), f["track_name"].alias("name"), f["duration_ms"].alias("duration_ms"),
        f["popularity"].alias("popularity"), F.struct(f["track_url"].alias(URL_KEY)).alias("external_urls"),
        artists.alias("artists"), album.alias("album"))
    item = F.struct(f["added_at"].alias("added_at"), track.alias("track"))
    by = []
    if arrival is not None:
        rows, by = rows.withColumn("arrival", arrival).repartition("arrival"), ["arrival"]
        item = F.struct(f["track_id"].alias("t"), f["album_id"].alias("a"), f["added_at"].alias("at"), item.alias("item"))
    place = F.row_number().over(Window.partitionBy(*by, "l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    # items are a column before they are collected: a projection is compiled, an aggregate's argument is not;
    # grouping by order and chunk needs no other exchange than the window's
    docs = (rows.withColumn("chunk", F.floor((place - 1) / DOC_ITEMS))
            .select(*by, F.col("l_orderkey").alias("playlist_id"), "chunk", item.alias("item"))
            .groupBy(*by, "playlist_id", "chunk").agg(F.collect_list("item").alias("items")))
    if by:
        docs = docs.withColumn("items", F.transform(F.sort_array("items"), lambda x: x["item"]))
    return docs


def land_docs(spark: SparkSession, sf: str) -> str:
    """Raw arrival: the documents as JSON Lines files; returns their folder."""
    path = scratch_path(spark, "playlists_raw")
    playlist_docs(spark, sf).write.option("compression", "lz4").json(path)
    return path


ARRIVAL_ORDERS = 1000


def land_arrivals(spark: SparkSession, sf: str) -> str:
    """The documents in arrival folders, a thousand orders each, one file a folder; items in the order of their lines."""
    path = scratch_path(spark, "playlists_arrived")
    arrival = F.floor(F.col("l_orderkey") / ARRIVAL_ORDERS).cast("int")
    playlist_docs(spark, sf, arrival).write.partitionBy("arrival").option("compression", "lz4").json(path)
    return path


def load_docs(spark: SparkSession, sf: str, bronze: bool = False, schema: str = PLAYLIST_SCHEMA) -> DataFrame:
    """The landed documents, read with the explicit schema (or the part of it that the reader needs).

    ``bronze=True`` parses the JSON once into nested parquet first; worth it
    when several tables are derived from the same documents, each then
    reading columnar data instead of parsing the text again.
    """
    docs = read_json_docs(spark, land_docs(spark, sf), schema)
    if not bronze:
        return docs
    path = scratch_path(spark, "playlists_bronze")
    docs.write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- transforms

def items(docs: DataFrame) -> DataFrame:
    return explode_path(docs, "items", "item", keep=("playlist_id",))


ALBUM_FIELDS = {
    "album_id": "item.track.album.id", "name": "item.track.album.name",
    "release_date": "item.track.album.release_date", "total_tracks": "item.track.album.total_tracks",
    "url": f"item.track.album.external_urls.{URL_KEY}"}


def albums(docs: DataFrame) -> DataFrame:
    out = project(items(docs), ALBUM_FIELDS)
    # equal rows fall together by hash, without a sort; then dedup on the raw text, and parse the (few) surviving dates
    return keep_one(out.distinct(), ["album_id"]).withColumn("release_date", parse_date_lenient("release_date"))


def artists(docs: DataFrame) -> DataFrame:
    track_artists = explode_path(items(docs), "item.track.artists", "artist")
    out = project(track_artists, {"artist_id": "artist.id", "artist_name": "artist.name",
                                  "external_url": "artist.href"})
    return keep_one(out.distinct(), ["artist_id"])


def song_fields():
    return (
        F.col("item.track.id").alias("song_id"), F.col("item.track.name").alias("song_name"),
        F.col("item.track.duration_ms").alias("duration_ms"),
        F.col(f"item.track.external_urls.{URL_KEY}").alias("url"),
        F.col("item.track.popularity").alias("popularity"),
        iso_timestamp(F.col("item.added_at")).alias("song_added"),
        F.col("item.track.album.id").alias("album_id"),
        first_elem_field("item.track.album.artists", "id").alias("artist_id"))


def songs(docs: DataFrame) -> DataFrame:
    return keep_one(items(docs).select(*song_fields()), ["song_id"], ["song_added"], keep="first")


#: what tells one document from another, and where in it an item was
DOCUMENT, PLACE = ("playlist_id", "chunk"), ("item_no", "source_file")


def traced_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of the landed documents with their document, their place in it and its file."""
    docs = read_json_docs(spark, path, PLAYLIST_SCHEMA, with_source=True)
    return explode_path(docs, "items", "item", keep=(*DOCUMENT, "source_file"), place="item_no")


def traced_albums(items_: DataFrame) -> DataFrame:
    """Albums, each with the document and file its row came from and the number of documents that had it."""
    origin = {c: c for c in (*DOCUMENT, *PLACE)}
    out = project(items_, {**ALBUM_FIELDS, **origin})
    return keep_one_traced(out, ["album_id"], document=DOCUMENT, place=PLACE).withColumn(
        "release_date", parse_date_lenient("release_date"))


def traced_songs(items_: DataFrame) -> DataFrame:
    """Songs as first added, traced likewise."""
    out = items_.select(*song_fields(), *DOCUMENT, *PLACE)
    return keep_one_traced(out, ["song_id"], ["song_added"], document=DOCUMENT, place=PLACE)


# ---------------------------------------------------------------- oracles

_F = fields(DUCK)
_FLAT = f"""
SELECT l_orderkey AS playlist_id, {_F['added_at']} AS added_at, CAST(date_trunc('second', l_shipdate) AS TIMESTAMP) AS added_time,
  {_F['track_id']} AS track_id, {_F['track_name']} AS track_name, {_F['duration_ms']} AS duration_ms,
  {_F['popularity']} AS popularity, {_F['track_url']} AS track_url,
  'art_' || {_F['artist1_num']} AS artist1_id, 'art_' || {_F['artist2_num']} AS artist2_id,
  {_F['n_artists']} AS n_artists,
  {_F['album_id']} AS album_id, {_F['album_name']} AS album_name, {_F['release_date']} AS release_date,
  {_F['total_tracks']} AS total_tracks, {_F['album_url']} AS album_url,
  CASE WHEN {_F['n_album_artists']} = 1 THEN {_F['album_artist_id']} END AS album_artist
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""
_EXTRA = {"flat": _FLAT}
_RD = ("CAST(coalesce(try_strptime(release_date, '%Y-%m-%d'), try_strptime(release_date, '%Y-%m'), "
       "try_strptime(release_date, '%Y')) AS DATE)")
_ART = ("'Artist ' || regexp_extract({0}, '([0-9]+)$', 1) AS artist_name, "
        "'https://api.example/artists/' || regexp_extract({0}, '([0-9]+)$', 1) AS external_url")

SQL_ITEMS = with_views("SELECT playlist_id, track_id, added_at FROM flat", extra=_EXTRA)
SQL_ALBUMS = with_views(f"""
SELECT DISTINCT album_id, album_name AS name, {_RD} AS release_date, total_tracks, album_url AS url FROM flat
""", extra=_EXTRA)
SQL_ARTISTS = with_views(f"""
SELECT DISTINCT artist_id, artist_name, external_url FROM (
  SELECT artist1_id AS artist_id, {_ART.format('artist1_id')} FROM flat WHERE n_artists >= 1
  UNION ALL
  SELECT artist2_id AS artist_id, {_ART.format('artist2_id')} FROM flat WHERE n_artists = 2) a
""", extra=_EXTRA)
_SONG_COLS = ["song_added", "song_name", "duration_ms", "url", "popularity", "album_id", "artist_id"]
SQL_SONGS = with_views(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY
     {", ".join(c + " ASC NULLS FIRST" for c in _SONG_COLS)}) AS rn
  FROM (SELECT track_id AS song_id, track_name AS song_name, duration_ms, track_url AS url, popularity,
               added_time AS song_added, album_id, album_artist AS artist_id FROM flat) s) r
WHERE rn = 1
""", extra=_EXTRA)


@query("scan_json_nested", SQL_ITEMS)
def q_scan_json_nested(spark, sf):
    return items(load_docs(spark, sf)).select(
        "playlist_id", F.col("item.track.id").alias("track_id"), F.col("item.added_at").alias("added_at"))


@query("nested_albums", SQL_ALBUMS)
def q_nested_albums(spark, sf):
    return albums(load_docs(spark, sf, schema=ALBUM_SCHEMA))


@query("nested_artists", SQL_ARTISTS)
def q_nested_artists(spark, sf):
    return artists(load_docs(spark, sf, schema=ARTIST_SCHEMA))


@query("nested_songs", SQL_SONGS)
def q_nested_songs(spark, sf):
    return songs(load_docs(spark, sf))


# documents as the stand-in cuts them, items in the order of ``land_arrivals``
_PLACED = """
SELECT *, row_number() OVER (PARTITION BY playlist_id, chunk ORDER BY track_id, album_id, added_at) - 1 AS item_no FROM (
  SELECT *, (row_number() OVER (PARTITION BY playlist_id ORDER BY line, part, supp, shipped) - 1) // 50 AS chunk FROM flat_lines) n
"""
_LINES = _FLAT.replace("SELECT l_orderkey AS playlist_id,", "SELECT l_orderkey AS playlist_id, l_linenumber AS line, "
                       "l_partkey AS part, l_suppkey AS supp, l_shipdate AS shipped,", 1)
_TRACED = {"flat_lines": _LINES, "placed": _PLACED}
_ORIGIN = "playlist_id, chunk, item_no"


def _traced_sql(key: str, cols: str, order: str) -> str:
    return with_views(f"""
SELECT r.* EXCLUDE (rn), r.playlist_id // {ARRIVAL_ORDERS} AS arrival, d.documents FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM (SELECT {cols}, {_ORIGIN} FROM placed) s) r
JOIN (SELECT {key}, count(DISTINCT playlist_id * 1000000 + chunk) AS documents FROM (SELECT {cols}, {_ORIGIN} FROM placed) s GROUP BY 1) d
  USING ({key})
WHERE rn = 1
""", extra=_TRACED)


def _arrival():
    return F.regexp_extract("source_file", "/arrival=([0-9]+)/", 1).cast("int").alias("arrival")


@query("nested_songs_traced", _traced_sql(
    "song_id", "track_id AS song_id, track_name AS song_name, duration_ms, track_url AS url, popularity, added_time AS song_added, "
    "album_id, album_artist AS artist_id",
    ", ".join(c + " ASC NULLS FIRST" for c in [*_SONG_COLS, "playlist_id", "chunk", "item_no"])))
def q_nested_songs_traced(spark, sf):
    """Each song with the document (and its file's arrival folder) its row came from, and in how many it was."""
    out = traced_songs(traced_items(spark, land_arrivals(spark, sf)))
    return out.select("*", _arrival()).drop("source_file")
