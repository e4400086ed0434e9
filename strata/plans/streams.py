"""File-stream ingestion keys.

Each key lands driver-table rows as files in a fresh folder under the shared
scratch area (in arrival batches), runs the ingest stream with a checkpoint,
and returns the committed table, so the result is checked against the source
table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import medallion as M
from strata.plans import playlist as P
from strata.plans import warehouse as W
from strata.plans.registry import query
from strata.plans.views import table, view, with_views
from strata.session import scratch_path
from strata.sources.readers import typed_text
from strata.sources.sinks import write_overwrite
from strata.streaming.ingest import ingest, ledger, read_ingested
from strata.streaming.tracked import RESCUED, VERSION, ingest_tracked, read_tracked

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


class Landing:
    """A landing folder, its stream table, checkpoint and archive."""

    def __init__(self, spark, name: str):
        root = scratch_path(spark, name)
        self.spark = spark
        self.inbox, self.table = f"{root}/inbox", f"{root}/table"
        self.checkpoint, self.archive = f"{root}/_checkpoint", f"{root}/archive"

    def land(self, df: DataFrame, fmt: str = "parquet", by_day: str | None = None, **options) -> None:
        """Files arrive: one append of ``df`` (day folders when ``by_day`` names a timestamp)."""
        w = df.withColumn("day", F.to_date(by_day)) if by_day else df
        writer = w.write.mode("append").format(fmt).options(**options)
        if by_day:
            writer = writer.partitionBy("day")
        writer.save(self.inbox)

    def run(self, schema, **kw):
        return ingest(self.spark, self.inbox, self.table, self.checkpoint, schema, **kw)

    def read(self, merge_schema: bool = False) -> DataFrame:
        return read_ingested(self.spark, self.table, merge_schema)


def _events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(*EVENT_COLS)


@query("stream_ingest", "SELECT * FROM events")
def q_stream_ingest(spark, sf):
    """Two arrival batches, two runs: every event exactly once."""
    ev = _events(spark, sf)
    s = Landing(spark, "events_stream")
    s.land(ev.where(F.col("event_id") % 2 == 0))
    s.run(ev.schema)
    s.land(ev.where(F.col("event_id") % 2 == 1))
    s.run(ev.schema)
    return s.read()


@query("stream_rerun_idempotent", "SELECT * FROM events")
def q_stream_rerun_idempotent(spark, sf):
    """A second run with no new files adds no rows."""
    ev = _events(spark, sf)
    s = Landing(spark, "events_rerun")
    s.land(ev)
    s.run(ev.schema)
    s.run(ev.schema)
    return s.read()


@query("stream_ingest_csv", "SELECT * FROM supplier")
def q_stream_ingest_csv(spark, sf):
    """CSV files with a header auto-ingested into a typed table."""
    sup = table(spark, sf, "supplier")
    s = Landing(spark, "supplier_stream")
    s.land(sup, fmt="csv", header=True)
    s.run(sup.schema, fmt="csv", options={"header": True})
    return s.read()


def _loaded(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, count(nullif(url, '')) AS with_url FROM ({sql}) t"


def _body(sql: str, start: str) -> str:
    return sql[sql.index("\n" + start):]


@query("stream_ingest_playlists", with_views(" UNION ALL ".join([
    _loaded("album", f"SELECT CASE WHEN album_id LIKE '%7' THEN NULL ELSE url END AS url FROM ({_body(P.SQL_ALBUMS, 'SELECT DISTINCT')}) a"),
    _loaded("artist", f"SELECT CASE WHEN artist_id LIKE '%7' THEN NULL ELSE external_url END AS url FROM ({_body(P.SQL_ARTISTS, 'SELECT DISTINCT')}) a"),
    _loaded("songs", f"SELECT CASE WHEN song_id LIKE '%7' THEN NULL ELSE url END AS url FROM ({_body(P.SQL_SONGS, 'SELECT * EXCLUDE')}) a")]),
    extra=P._EXTRA))
def q_stream_ingest_playlists(spark, sf):
    """Three CSV exports in one landing folder; three streams pick theirs by file pattern, read columns by
    position and take ``NULL``, ``null`` and empty fields for NULL."""
    root = scratch_path(spark, "playlist_stream")
    docs = P.load_docs(spark, sf, bronze=True)
    out = None
    for name, build, key, url, ddl in (
            ("album", P.albums, "album_id", "url", W.ALBUM_DDL), ("artist", P.artists, "artist_id", "external_url", W.ARTIST_DDL),
            ("songs", P.songs, "song_id", "url", W.SONG_DDL)):
        last = F.substring(F.col(key), -1, 1)
        token = F.when(F.length(key) % 3 == 0, "NULL").when(F.length(key) % 3 == 1, "null").otherwise("")
        dirty = build(docs).withColumn(url, F.when(last == "7", token).otherwise(F.col(url)))
        dirty.write.option("header", True).csv(f"{root}/inbox/{name}_transformed")
    for name, url, ddl in (("album", "url", W.ALBUM_DDL), ("artist", "external_url", W.ARTIST_DDL), ("songs", "url", W.SONG_DDL)):
        target = f"{root}/{name}"
        text = ", ".join(f"{f.name} STRING" for f in T.StructType.fromDDL(ddl).fields)
        ingest(spark, f"{root}/inbox/{name}_transformed*", target, f"{root}/_checkpoint/{name}", text, fmt="csv",
               options={"header": True, "enforceSchema": True, "pathGlobFilter": "*.csv"})
        loaded = typed_text(read_ingested(spark, target), ddl)
        row = loaded.agg(F.count(F.lit(1)).alias("row_count"), F.count(url).alias("with_url")) \
            .select(F.lit(name).alias("table_name"), "row_count", "with_url")
        out = row if out is None else out.unionByName(row)
    return out


@query("stream_schema_evolution", """
SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props
FROM events
""")
def q_stream_schema_evolution(spark, sf):
    """First files lack ``props``; later files have it; one checkpoint, additive schema."""
    ev = _events(spark, sf)
    s = Landing(spark, "events_evolving")
    old = ev.drop("props")
    s.land(old.where(F.col("event_id") % 2 == 0))
    s.run(old.schema)
    s.land(ev.where(F.col("event_id") % 2 == 1))
    s.run(ev.schema)
    return s.read(merge_schema=True).select(*EVENT_COLS)


@query("stream_archive", "SELECT * FROM events")
def q_stream_archive(spark, sf):
    """Three runs with archival of finished files; rows still land exactly once."""
    ev = _events(spark, sf)
    s = Landing(spark, "events_archive")
    for k in range(3):
        s.land(ev.where(F.col("event_id") % 3 == k))
        s.run(ev.schema, archive_dir=s.archive)
    return s.read()


@query("ingest_ledger", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS row_count FROM events GROUP BY 1
""")
def q_ingest_ledger(spark, sf):
    """Rows per arrival folder, aggregated from the file path stored with every row."""
    ev = _events(spark, sf)
    s = Landing(spark, "events_ledger")
    s.land(ev, by_day="ts")
    s.run(ev.schema, source_file=True)
    return (ledger(s.read(), label=r"/day=([0-9-]+)/")
            .select(F.col("source").alias("day"), "row_count"))  # first_seen is a wall-clock time


@query("stream_users_medallion", with_views(M.SQL_USERS_SILVER, "v_users"), M.USER_DEC_COLS)
def q_stream_users_medallion(spark, sf):
    """Users files -> stream into bronze -> silver rules -> gold copy (schema replaced)."""
    users = view(spark, sf, "v_users")
    s = Landing(spark, "users_stream")
    s.land(users)
    s.run(users.schema)
    silver, gold = f"{s.table}_silver", f"{s.table}_gold"
    write_overwrite(M.users_silver(s.read()), silver)
    write_overwrite(spark.read.parquet(silver), gold)
    return spark.read.parquet(gold)


@query("stream_schema_tracked", """
SELECT event_id, CASE WHEN event_id % 15 = 2 THEN NULL ELSE user_id END AS user_id,
  CASE WHEN event_id % 3 = 0 THEN CAST(floor(value) AS DOUBLE) ELSE value END AS amount,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 15 = 2 THEN '{"user_id":"u' || CAST(user_id AS VARCHAR) || '"}' END AS rescued,
  CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS version
FROM events
""")
def q_stream_schema_tracked(spark, sf):
    """Three arrivals of JSON lines, no schema declared: whole amounts; then amounts with decimals and a new
    field; then users whose id is a text."""
    ev = table(spark, sf, "events").select("event_id", "user_id", F.col("value").alias("amount"), "event_type")
    s = Landing(spark, "events_tracked")
    third = F.col("event_id") % 3
    odd = F.col("event_id") % 15 == 2
    as_json = F.to_json(F.struct("*"))
    text_id = ev.withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string"))).where(odd).select(as_json)
    for lines in (ev.where(third == 0).withColumn("amount", F.floor("amount")).drop("event_type").select(as_json),
                  ev.where(third == 1).select(as_json),
                  ev.where((third == 2) & ~odd).select(as_json).union(text_id)):
        s.land(lines, fmt="text")
        ingest_tracked(spark, s.inbox, s.table, s.checkpoint)
    return read_tracked(spark, s.table, s.checkpoint).withColumnsRenamed({RESCUED: "rescued", VERSION: "version"})
