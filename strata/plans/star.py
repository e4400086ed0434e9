"""Host dimension and booking facts over two loads of the rental tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.asof import asof_join, both_times
from strata.operators.dimensions import at_version, load_dimension
from strata.operators.windows import hot_ranges
from strata.plans.rentals import _ALL, _SILVER, bookings_silver, hosts_silver, listings_silver
from strata.plans.registry import query
from strata.plans.views import view, with_views
from strata.session import staged

_CHANGED = """SELECT * REPLACE (created_at + INTERVAL 2 YEAR AS created_at, NOT is_superhost AS is_superhost)
  FROM sh WHERE response_rate IS NOT NULL"""
_DIM = {
    "changed": _CHANGED,
    "keyed": """SELECT row_number() OVER (ORDER BY host_id, created_at) AS host_sk, * FROM sh
  UNION ALL SELECT (SELECT count(*) FROM sh) + row_number() OVER (ORDER BY host_id, created_at), * FROM changed""",
    "dim": """SELECT *, lead(created_at) OVER w AS valid_to, lead(created_at) OVER w IS NULL AS is_current
  FROM keyed WINDOW w AS (PARTITION BY host_id ORDER BY created_at)""",
}
_COLS = "host_id, host_name, host_since, is_superhost, response_rate, response_rate_quality, created_at, valid_to"


def dim_host(spark, sf):
    """First load: all hosts as they came. Second: those with a known response rate, changed two years later,
    and all of the first load once more."""
    hosts = hosts_silver(view(spark, sf, "v_hosts"))
    later = hosts.where(F.col("response_rate").isNotNull()).withColumns({
        "created_at": F.col("created_at") + F.expr("INTERVAL 2 YEAR"), "is_superhost": ~F.col("is_superhost")})
    first = staged(load_dimension(None, hosts, "host_id", "created_at", "host_sk"), "dim-host")
    return staged(load_dimension(first, hosts.unionByName(later), "host_id", "created_at", "host_sk"), "dim-host")


@query("dim_host", with_views(f"""
SELECT host_sk, {_COLS}, is_current FROM dim
UNION ALL SELECT 0, {", ".join(["NULL"] * len(_COLS.split(", ")))}, true
""", *_ALL, extra={**_SILVER, **_DIM}))
def q_dim_host(spark, sf):
    return dim_host(spark, sf)


@query("fact_booking", with_views("""
SELECT b.booking_id, b.listing_id, coalesce(d.host_sk, 0) AS host_sk, b.booking_date, b.total_amount, b.booking_status
FROM sb b LEFT JOIN sl l ON b.listing_id = l.listing_id
LEFT JOIN dim d ON l.host_id = d.host_id AND b.created_at >= d.created_at AND (d.valid_to IS NULL OR b.created_at < d.valid_to)
""", *_ALL, extra={**_SILVER, **_DIM}))
def q_fact_booking(spark, sf):
    """Each booking with the version of its listing's host that held when it was made."""
    listings = listings_silver(view(spark, sf, "v_listings")).select("listing_id", "host_id")
    facts = bookings_silver(view(spark, sf, "v_bookings")).join(listings, "listing_id", "left")
    return at_version(facts, dim_host(spark, sf), "host_id", "created_at", "created_at", "host_sk").select(
        "booking_id", "listing_id", "host_sk", "booking_date", "total_amount", "booking_status")


_PRICES = """SELECT listing_id, price_at, max(price) AS price FROM (
    SELECT listing_id, created_at AS price_at, CAST(price_per_night AS DECIMAL(18,4)) AS price FROM v_listings
    UNION ALL SELECT listing_id, created_at + INTERVAL 1 DAY, CAST(booking_amount AS DECIMAL(18,4)) FROM v_bookings) p
  GROUP BY 1, 2"""


@query("booking_price_asof", with_views("""
SELECT b.booking_id, b.listing_id, b.created_at, p.price AS price, p.price_at
FROM v_bookings b ASOF LEFT JOIN prices p ON b.listing_id = p.listing_id AND b.created_at >= p.price_at
""", "v_bookings", "v_listings", extra={"prices": _PRICES}), ["price"])
def q_booking_price_asof(spark, sf):
    """Each booking with the price known when it was made: the listing's own, or what a booking agreed on the day before or earlier."""
    bookings = view(spark, sf, "v_bookings")
    day = F.expr("INTERVAL 1 DAY")
    prices = view(spark, sf, "v_listings").select(
        "listing_id", F.col("created_at").alias("price_at"), F.col("price_per_night").cast("decimal(18,4)").alias("price")).unionByName(
        bookings.select("listing_id", (F.col("created_at") + day).alias("price_at"), F.col("booking_amount").cast("decimal(18,4)").alias("price")))
    asked = bookings.select("booking_id", "listing_id", "created_at")
    return asof_join(asked, prices, ["listing_id"], "created_at", "price_at", {"price": "price", "price_at": "price_at"},
                     bucket=hot_ranges(both_times(asked, prices, "created_at", "price_at", ["listing_id"]), ["_k0"], "at"))
