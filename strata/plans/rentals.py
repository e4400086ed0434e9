"""Rentals medallion: incremental bronze, keyed silver models, metadata-driven gold.

Bronze appends rows newer than the target's mark; silver projects and merges
on the unique key (latest ``created_at`` wins, ties broken on all columns);
gold is a config list of tables, columns and join conditions turned into a
left-join chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.parse import parse_ts
from strata.functions.rules import bucketize, round_product
from strata.operators.dedup import keep_one
from strata.operators.incremental import (append_new, new_rows, read_if_exists, scd2, scd2_merge, typed_source, upsert_in_place,
                                          upsert_latest)
from strata.operators.obt import JoinSpec, metadata_chain
from strata.operators.windows import hot_ranges
from strata.plans.registry import query
from strata.plans.views import view, with_views
from strata.session import scratch_path, staged
from strata.sources.readers import read_csv_strings, read_table
from strata.sources.sinks import create_table, write_overwrite

# fixed values of the source models
RESPONSE_QUALITY = [(95, "VERY GOOD"), (80, "GOOD"), (60, "FAIR")]
RESPONSE_ELSE = "POOR"
# the price tag macro is not defined in the source project; these thresholds are ours
PRICE_TAGS = [(100, "low"), (200, "medium")]
PRICE_TAG_ELSE = "high"


def bookings_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "booking_id", "listing_id", "booking_date",
        (round_product("nights_booked", "booking_amount", 2) + F.col("cleaning_fee") + F.col("service_fee"))
        .cast("double").alias("total_amount"),
        "booking_status", "created_at")


def hosts_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "host_id", F.replace("host_name", F.lit(" "), F.lit("_")).alias("host_name"),
        "host_since", "is_superhost", "response_rate",
        bucketize("response_rate", RESPONSE_QUALITY, RESPONSE_ELSE, descending=True).alias("response_rate_quality"),
        "created_at")


def listings_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "listing_id", "host_id", "property_type", "room_type", "city", "country", "accommodates",
        "bedrooms", "bathrooms", F.col("price_per_night").cast("double").alias("price_per_night"),
        bucketize(F.col("price_per_night").cast("int"), PRICE_TAGS, PRICE_TAG_ELSE).alias("price_per_night_tag"),
        "created_at")


LISTING_COLS = ["host_id", "property_type", "room_type", "city", "accommodates", "bedrooms", "bathrooms",
                "price_per_night"]
HOST_COLS = ["host_name", "host_since", "is_superhost", "response_rate", "response_rate_quality"]


def obt(bookings: DataFrame, listings: DataFrame, hosts: DataFrame) -> DataFrame:
    return metadata_chain([
        JoinSpec(bookings, "silver_bookings", ["*"]),
        JoinSpec(listings, "silver_listings", LISTING_COLS,
                 "silver_bookings.listing_id = silver_listings.listing_id"),
        JoinSpec(hosts, "silver_hosts", HOST_COLS, "silver_listings.host_id = silver_hosts.host_id"),
    ])


# ---------------------------------------------------------------- oracles

SQL_BOOKINGS = """
SELECT booking_id, listing_id, booking_date,
  CAST(round(nights_booked * booking_amount, 2) + cleaning_fee + service_fee AS DOUBLE) AS total_amount,
  booking_status, created_at
FROM v_bookings
"""
SQL_HOSTS = """
SELECT host_id, replace(host_name, ' ', '_') AS host_name, host_since, is_superhost, response_rate,
  CASE WHEN response_rate >= 95 THEN 'VERY GOOD' WHEN response_rate >= 80 THEN 'GOOD'
       WHEN response_rate >= 60 THEN 'FAIR' ELSE 'POOR' END AS response_rate_quality,
  created_at
FROM v_hosts
"""
SQL_LISTINGS = """
SELECT listing_id, host_id, property_type, room_type, city, country, accommodates, bedrooms, bathrooms,
  CAST(price_per_night AS DOUBLE) AS price_per_night,
  CASE WHEN CAST(trunc(price_per_night) AS INTEGER) < 100 THEN 'low'
       WHEN CAST(trunc(price_per_night) AS INTEGER) < 200 THEN 'medium' ELSE 'high' END AS price_per_night_tag,
  created_at
FROM v_listings
"""
_SILVER = {"sb": SQL_BOOKINGS, "sl": SQL_LISTINGS, "sh": SQL_HOSTS}
_ALL = ("v_bookings", "v_listings", "v_hosts")
_BOOKING_REST = "listing_id, booking_date, total_amount, booking_status"


def _ranked(direction: str, nulls: str) -> str:
    cols = ", ".join(f"{c} {direction} NULLS {nulls}" for c in ["created_at"] + _BOOKING_REST.split(", "))
    return f"SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY {cols}) AS rn FROM sb"


@query("bookings_silver", with_views("SELECT * FROM sb", *_ALL, extra=_SILVER))
def q_bookings_silver(spark, sf):
    return bookings_silver(view(spark, sf, "v_bookings"))


@query("hosts_silver", with_views("SELECT * FROM sh", *_ALL, extra=_SILVER))
def q_hosts_silver(spark, sf):
    return hosts_silver(view(spark, sf, "v_hosts"))


@query("listings_silver", with_views("SELECT * FROM sl", *_ALL, extra=_SILVER))
def q_listings_silver(spark, sf):
    return listings_silver(view(spark, sf, "v_listings"))


CUT = "2000-01-01 00:00:00"
KEYS_PER_PART = 100_000


def with_part(silver: DataFrame, key: str) -> DataFrame:
    """A partition column that never changes for a key: its range of ids."""
    return silver.withColumn("part", F.floor(F.col(key) / KEYS_PER_PART).cast("int"))


#: the three tables of the medallion: stand-in view, silver model, unique key
LAYERS = {"bookings": ("v_bookings", bookings_silver, "booking_id"),
          "listings": ("v_listings", listings_silver, "listing_id"),
          "hosts": ("v_hosts", hosts_silver, "host_id")}


def run_layers(spark, sources: dict[str, DataFrame], root: str, run: int) -> dict[str, DataFrame]:
    """One run of the medallion: bronze appends what is newer than it holds, silver merges bronze rows
    newer than itself on the unique key. Returns the silver tables. Silver of run n lies in ``silver_n``."""
    out = {}
    for name, (_, model, key) in LAYERS.items():
        bronze, silver = f"{root}/bronze/{name}", f"{root}/silver_{run}/{name}"
        append_new(spark, sources[name], bronze, "created_at")
        before = read_if_exists(spark, f"{root}/silver_{run - 1}/{name}")
        batch = model(new_rows(read_table(spark, bronze), before, "created_at"))
        merged = upsert_latest(before, with_part(batch, key), [key], ["created_at"], "part")
        write_overwrite(merged, silver, partition_by=["part"])
        out[name] = read_table(spark, silver).drop("part")
    return out


def _latest(cte: str, key: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY created_at DESC) AS rn "
            f"FROM {cte}) r WHERE rn = 1")


SQL_OBT = with_views(f"""
SELECT b.*, {", ".join("l." + c for c in LISTING_COLS)}, {", ".join("h." + c for c in HOST_COLS)}
FROM (SELECT * EXCLUDE (rn) FROM ({_ranked('DESC', 'LAST')}) r WHERE rn = 1) b
LEFT JOIN ({_latest('sl', 'listing_id')}) l ON b.listing_id = l.listing_id
LEFT JOIN ({_latest('sh', 'host_id')}) h ON l.host_id = h.host_id
""", *_ALL, extra=_SILVER)


@query("obt_metadata", SQL_OBT)
def q_obt_metadata(spark, sf):
    """Two runs (rows before 2000, then everything), bronze to silver to gold on the merged silver."""
    root = scratch_path(spark, "rentals")
    whole = {name: view(spark, sf, v) for name, (v, _, _) in LAYERS.items()}
    early = {name: df.where(F.col("created_at") < F.expr(f"TIMESTAMP_NTZ'{CUT}'")) for name, df in whole.items()}
    run_layers(spark, early, root, 1)
    silver = run_layers(spark, whole, root, 2)
    return obt(silver["bookings"], silver["listings"], silver["hosts"])


@query("gold_table", SQL_OBT)
def q_gold_table(spark, sf):
    """Gold as a table of the catalog, created from the early rows and replaced by the second run, then read by name."""
    root = scratch_path(spark, "rentals_gold")
    name = "rentals_obt_" + root.rsplit("-", 1)[-1]
    whole = {n: view(spark, sf, v) for n, (v, _, _) in LAYERS.items()}
    early = {n: df.where(F.col("created_at") < F.expr(f"TIMESTAMP_NTZ'{CUT}'")) for n, df in whole.items()}
    try:
        for run, sources in enumerate((early, whole), 1):
            silver = run_layers(spark, sources, root, run)
            create_table(obt(silver["bookings"], silver["listings"], silver["hosts"]), name, f"{root}/gold")
        folder = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
        return spark.read.schema(spark.table(name).schema).parquet(folder)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the catalog entry is this run's; the files stay


@query("upsert_latest", with_views(
    f"SELECT * EXCLUDE (rn) FROM ({_ranked('DESC', 'LAST')}) r WHERE rn = 1", *_ALL, extra=_SILVER))
def q_upsert_latest(spark, sf):
    """First load: bookings created before 2000; then merge all later ones on booking_id."""
    silver = with_part(bookings_silver(view(spark, sf, "v_bookings")), "booking_id")
    cut = F.col("created_at") < F.expr(f"TIMESTAMP_NTZ'{CUT}'")
    first, second = scratch_path(spark, "silver_bookings"), scratch_path(spark, "silver_bookings")
    keys, order = ["booking_id"], ["created_at"]
    write_overwrite(upsert_latest(None, silver.where(cut), keys, order, "part"), first, partition_by=["part"])
    merged = upsert_latest(spark.read.parquet(first), silver.where(~cut), keys, order, "part")
    write_overwrite(merged, second, partition_by=["part"])
    return spark.read.parquet(second).drop("part")


@query("upsert_in_place", with_views(
    f"SELECT * EXCLUDE (rn) FROM ({_ranked('DESC', 'LAST')}) r WHERE rn = 1", *_ALL, extra=_SILVER))
def q_upsert_in_place(spark, sf):
    """Three batches into one live table: before 2000, all later ones, and the last again (a repeated run changes nothing)."""
    silver = with_part(bookings_silver(view(spark, sf, "v_bookings")), "booking_id")
    cut = F.col("created_at") < F.expr(f"TIMESTAMP_NTZ'{CUT}'")
    live = scratch_path(spark, "live_bookings")
    for batch in (silver.where(cut), silver.where(~cut), silver.where(~cut)):
        upsert_in_place(spark, live, batch, ["booking_id"], ["created_at"], "part", scratch_path(spark, "batch"))
    return spark.read.parquet(live).drop("part")


@query("dedup_key", with_views(
    f"SELECT * EXCLUDE (rn) FROM ({_ranked('ASC', 'FIRST')}) r WHERE rn = 1", *_ALL, extra=_SILVER))
def q_dedup_key(spark, sf):
    return keep_one(bookings_silver(view(spark, sf, "v_bookings")), ["booking_id"], ["created_at"], keep="first")


def undated(bookings: DataFrame) -> DataFrame:
    """Some versions whose time is not known (they come before all others of their key)."""
    return bookings.withColumn("created_at", F.when(F.col("booking_id") % 53 != 0, F.col("created_at")))


@query("scd2_history", with_views(f"""
SELECT *, n = versions AS is_current FROM (
  SELECT *, lead(created_at) OVER w AS valid_to, row_number() OVER w AS n, count(*) OVER (PARTITION BY booking_id) AS versions
  FROM (SELECT * REPLACE (CASE WHEN booking_id % 53 <> 0 THEN created_at END AS created_at) FROM sb) u
  WINDOW w AS (PARTITION BY booking_id ORDER BY
    {", ".join(f"{c} ASC NULLS FIRST" for c in ["created_at"] + _BOOKING_REST.split(", "))})) t
""", *_ALL, extra=_SILVER).replace("SELECT *, n = versions AS is_current FROM", "SELECT * EXCLUDE (n, versions), n = versions AS is_current FROM"))
def q_scd2_history(spark, sf):
    return scd2(undated(bookings_silver(view(spark, sf, "v_bookings"))), ["booking_id"], "created_at", bucket=hot_ranges(
        undated(view(spark, sf, "v_bookings")), ["booking_id"], "created_at"))


_VERSIONS = "listing_id, created_at, booking_status, total_amount"
_VERSION_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ("created_at", "booking_status", "total_amount"))


@query("scd2_merge", with_views(f"""
SELECT {_VERSIONS}, valid_to, n = versions AS is_current FROM (
  SELECT *, lead(created_at) OVER w AS valid_to, row_number() OVER w AS n, count(*) OVER (PARTITION BY listing_id) AS versions
  FROM (SELECT DISTINCT {_VERSIONS} FROM sb) u
  WINDOW w AS (PARTITION BY listing_id ORDER BY {_VERSION_ORDER})) t
""", *_ALL, extra=_SILVER))
def q_scd2_merge(spark, sf):
    """A listing's states by its bookings. History: what was confirmed or cancelled before 2000; the batch: all
    that came later, all pending ones (late), and all cancelled ones once more (repeated)."""
    states = bookings_silver(view(spark, sf, "v_bookings")).select(*_VERSIONS.split(", "))
    pending, cancelled = F.col("booking_status") == "pending", F.col("booking_status") == "cancelled"
    early = (F.col("created_at") < F.expr(f"TIMESTAMP_NTZ'{CUT}'")) & ~pending
    keys = ["listing_id"]
    spread = hot_ranges(states, keys, "created_at")
    history = staged(scd2(states.where(early).distinct(), keys, "created_at", bucket=spread), "history")
    return scd2_merge(history, states.where(~early | cancelled), keys, "created_at", bucket=spread)


@query("quality_referential", with_views("""
SELECT listing_id, host_id FROM sl WHERE NOT EXISTS (SELECT 1 FROM sh WHERE sh.host_id = sl.host_id)
""", *_ALL, extra=_SILVER))
def q_quality_referential(spark, sf):
    """Listings whose host is missing from the host dimension (orphans)."""
    listings = listings_silver(view(spark, sf, "v_listings")).select("listing_id", "host_id")
    hosts = hosts_silver(view(spark, sf, "v_hosts")).select("host_id")
    return listings.join(hosts, "host_id", "left_anti").select("listing_id", "host_id")


# ---------------------------------------------------------------- high-water mark (orders as source)

_CUT = "TIMESTAMP '2000-01-01 00:00:00'"
_MARK = f"(SELECT coalesce(max(updated_at), TIMESTAMP '1900-01-01 00:00:00') FROM v_source WHERE updated_at < {_CUT})"


def _seed_target(spark, sf):
    """The existing history: source rows before 2000, written as the target table."""
    source = view(spark, sf, "v_source")
    target = scratch_path(spark, "history")
    write_overwrite(source.where(F.col("updated_at") < F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'")), target)
    return source, target


@query("incremental_hwm", with_views(f"SELECT * FROM v_source WHERE updated_at > {_MARK}", "v_source"))
def q_incremental_hwm(spark, sf):
    source, target = _seed_target(spark, sf)
    return new_rows(source, spark.read.parquet(target), "updated_at")


@query("incremental_append", with_views(
    f"SELECT * FROM v_source WHERE updated_at < {_CUT} OR updated_at > {_MARK}", "v_source"))
def q_incremental_append(spark, sf):
    source, target = _seed_target(spark, sf)
    append_new(spark, source, target, "updated_at")
    append_new(spark, source, target, "updated_at")  # a re-run adds nothing
    return spark.read.parquet(target)


@query("incremental_inclusive", with_views("SELECT * FROM v_source", "v_source"))
def q_incremental_inclusive(spark, sf):
    """Some rows of the mark's own time come after the first load; they are taken up, and no row comes twice."""
    source = view(spark, sf, "v_source")
    target = scratch_path(spark, "history")
    before = source.where(F.col("updated_at") < F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'"))
    last = before.agg(F.max("updated_at").alias("last"))
    late = before.join(last, F.col("updated_at") == F.col("last"), "left_semi").agg(F.max("id").alias("late"))
    write_overwrite(before.join(late, F.col("id") == F.col("late"), "left_anti"), target)
    append_new(spark, source, target, "updated_at", inclusive_key=["id"])
    append_new(spark, source, target, "updated_at", inclusive_key=["id"])
    return spark.read.parquet(target)


_PARSED = "CASE WHEN updated_at NOT LIKE '%:60' THEN try_strptime(updated_at, '%Y-%m-%d %H:%M:%S') END"


@query("incremental_text_source", with_views(f"""
SELECT id, data, {_PARSED} AS updated_at FROM v_source_text
WHERE {_PARSED} > (SELECT coalesce(max({_PARSED}), TIMESTAMP '1900-01-01 00:00:00') FROM v_source_text
                   WHERE {_PARSED} < {_CUT})
""", "v_source_text"))
def q_incremental_text_source(spark, sf):
    """A CSV export with malformed timestamps: those rows go to rejects (``on_bad="reject"``),
    the rest is typed and filtered by the high-water mark of the existing history."""
    export = scratch_path(spark, "source_db_csv")
    view(spark, sf, "v_source_text").write.option("header", True).csv(export)
    source = read_csv_strings(spark, export, ["id", "data", "updated_at"]).withColumn("id", F.col("id").cast("bigint"))
    good = staged(typed_source(source, "updated_at", on_bad="reject")[0], "text-bronze")  # the text is parsed once
    target = scratch_path(spark, "history_text")
    write_overwrite(good.where(F.col("updated_at") < F.expr("TIMESTAMP_NTZ'2000-01-01 00:00:00'")), target)
    return new_rows(good, spark.read.parquet(target), "updated_at")


@query("incremental_text_rejects", with_views(f"SELECT id, data, updated_at FROM v_source_text WHERE {_PARSED} IS NULL",
                                              "v_source_text"))
def q_incremental_text_rejects(spark, sf):
    """The rows of the text export whose timestamp is malformed, as they came."""
    return typed_source(view(spark, sf, "v_source_text"), "updated_at", on_bad="reject")[1]


@query("incremental_text_strict", with_views(
    f"SELECT id, data, {_PARSED} AS updated_at FROM v_source_text WHERE {_PARSED} IS NOT NULL", "v_source_text"))
def q_incremental_text_strict(spark, sf):
    """Fail mode on the original text of the rows that reject mode accepts (one malformed row would fail the job)."""
    accepted = view(spark, sf, "v_source_text").where(parse_ts("updated_at").isNotNull())
    return typed_source(accepted, "updated_at", on_bad="fail")[0]
