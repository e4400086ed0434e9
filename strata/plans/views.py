"""Stand-in inputs derived from the driver tables.

The source jobs read e-commerce, sales, log, rental, API and Olympics data that
the driver does not ship.  Each stand-in below is a SQL view over the driver
tables, written once in the dialect subset Spark and DuckDB share, with a few
hooks where they differ.  Spark builds its inputs from these texts; the DuckDB
oracles embed the very same text as CTEs, so both sides start from identical
rows while the operators themselves are written independently on each side.

Dirty values (bad numbers, bad dates, NULLs, missing JSON keys) are produced by
modulo rules on keys so that both engines produce them identically.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Dialect:
    name: str

    def ts_text(self, x: str) -> str:
        if self.name == "spark":
            return f"date_format({x}, 'yyyy-MM-dd HH:mm:ss')"
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"

    def day_ts(self, base: str, days: str) -> str:
        """timestamp_ntz of ``base`` date plus an integer number of days."""
        if self.name == "spark":
            return f"CAST(date_add(DATE'{base}', CAST({days} AS INT)) AS TIMESTAMP_NTZ)"
        return f"CAST(DATE '{base}' + CAST({days} AS INTEGER) AS TIMESTAMP)"

    def day(self, base: str, days: str) -> str:
        if self.name == "spark":
            return f"date_add(DATE'{base}', CAST({days} AS INT))"
        return f"(DATE '{base}' + CAST({days} AS INTEGER))"

    def tab(self) -> str:
        return "chr(9)"

    def title(self, x: str) -> str:
        # initcap of a single word; DuckDB has no initcap
        return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _dec(int_expr: str, scale: str = "0.001") -> str:
    """Exact decimal text from an integer expression (no division anywhere)."""
    return f"CAST(CAST(({int_expr}) AS DECIMAL(20,0)) * {scale} AS STRING)"


# ---------------------------------------------------------------- e-commerce

def v_users(d: Dialect) -> str:
    return f"""
SELECT
  c.c_custkey AS user_id,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL
       WHEN c.c_custkey % 11 = 0 THEN n.n_name
       ELSE {d.title('n.n_name')} END AS country,
  lower(n.n_name) AS countrycode,
  CASE c.c_custkey % 4 WHEN 0 THEN 'EN' WHEN 1 THEN 'FR' WHEN 2 THEN 'DE' ELSE NULL END AS language,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL ELSE c.c_mktsegment END AS gender,
  CASE c.c_custkey % 6 WHEN 0 THEN 'Mrs' WHEN 1 THEN 'Mme' WHEN 2 THEN 'Ms'
       WHEN 3 THEN 'Mister Doctor' WHEN 4 THEN 'Miss' ELSE NULL END AS civilitytitle,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_custkey % 1000 END AS dayssincelastlogin,
  c.c_custkey % 2000 AS seniority,
  CASE c.c_custkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE NULL END AS hasanyapp,
  CASE c.c_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'maybe' ELSE 'false' END AS hasandroidapp,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS hasiosapp,
  CASE WHEN c.c_acctbal > 0 THEN 'True' ELSE 'False' END AS hasprofilepicture,
  CASE WHEN c.c_custkey % 17 = 0 THEN 'bad' ELSE CAST(c.c_custkey % 500 AS STRING) END AS socialnbfollowers,
  CAST(c.c_custkey % 300 AS STRING) AS socialnbfollows,
  CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) * 0.125 AS STRING) AS productspassrate,
  CAST(c.c_custkey % 2000 AS DECIMAL(12,2)) * 0.033 AS seniorityasmonths,
  CAST(c.c_custkey % 2000 AS DECIMAL(12,2)) * 0.0027 AS seniorityasyears,
  c.c_custkey % 50 AS productsSold,
  c.c_custkey % 70 AS productsWished
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


BUYER_INT_COLS = [
    "buyers", "topbuyers", "femalebuyers", "malebuyers", "topfemalebuyers", "topmalebuyers",
    "totalproductsbought", "totalproductswished", "totalproductsliked",
    "toptotalproductsbought", "toptotalproductswished", "toptotalproductsliked",
]
BUYER_DEC_COLS = [
    "topbuyerratio", "femalebuyersratio", "topfemalebuyersratio", "boughtperwishlistratio",
    "boughtperlikeratio", "topboughtperwishlistratio", "topboughtperlikeratio",
    "meanproductsbought", "meanproductswished", "meanproductsliked", "topmeanproductsbought",
    "topmeanproductswished", "topmeanproductsliked", "meanofflinedays", "topmeanofflinedays",
    "meanfollowers", "meanfollowing", "topmeanfollowers", "topmeanfollowing",
]


def v_buyers(d: Dialect) -> str:
    top = "cb.c_acctbal > 5000"
    ints = {
        "buyers": "CAST(count(*) AS STRING)",
        "topbuyers": f"sum(CASE WHEN {top} THEN 1 ELSE 0 END)",
        "femalebuyers": "CASE WHEN n.n_nationkey % 7 = 3 THEN NULL ELSE CAST(sum(CASE WHEN cb.c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END) AS STRING) END",
        "malebuyers": "CAST(sum(CASE WHEN cb.c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS STRING)",
        "topfemalebuyers": f"sum(CASE WHEN cb.c_mktsegment = 'FURNITURE' AND {top} THEN 1 ELSE 0 END)",
        "topmalebuyers": f"sum(CASE WHEN cb.c_mktsegment = 'MACHINERY' AND {top} THEN 1 ELSE 0 END)",
        "totalproductsbought": "sum(cb.n_orders)",
        "totalproductswished": "CASE WHEN n.n_nationkey % 5 = 2 THEN 'n/a' ELSE CAST(sum(cb.n_open) AS STRING) END",
        "totalproductsliked": "sum(cb.n_pending)",
        "toptotalproductsbought": f"sum(CASE WHEN {top} THEN cb.n_orders ELSE 0 END)",
        "toptotalproductswished": f"sum(CASE WHEN {top} THEN cb.n_open ELSE 0 END)",
        "toptotalproductsliked": f"sum(CASE WHEN {top} THEN cb.n_pending ELSE 0 END)",
    }
    decs = {}
    for i, name in enumerate(BUYER_DEC_COLS):
        body = _dec(f"sum(cb.c_custkey % {7 + 2 * i}) % 1000")
        decs[name] = f"CASE WHEN n.n_nationkey % {3 + i % 4} = 1 THEN NULL ELSE {body} END"
    cols = ",\n  ".join(f"{e} AS {k}" for k, e in {**ints, **decs}.items())
    return f"""
SELECT lower(n.n_name) AS country,
  {cols}
FROM (
  SELECT c.c_nationkey, c.c_custkey, c.c_mktsegment, c.c_acctbal,
         coalesce(co.n_orders, 0) AS n_orders, coalesce(co.n_open, 0) AS n_open,
         coalesce(co.n_pending, 0) AS n_pending
  FROM customer c LEFT JOIN (
    SELECT o_custkey, count(*) AS n_orders,
           sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS n_open,
           sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS n_pending
    FROM orders GROUP BY o_custkey) co ON co.o_custkey = c.c_custkey
) cb JOIN nation n ON cb.c_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name
"""


SELLER_INT_COLS = ["nbsellers", "totalproductssold", "totalproductslisted", "totalbought", "totalwished", "totalproductsliked"]
SELLER_DEC_COLS = [
    "meanproductssold", "meanproductslisted", "meansellerpassrate", "meanproductsbought",
    "meanproductswished", "meanproductsliked", "meanfollowers", "meanfollows",
    "percentofappusers", "percentofiosusers", "meanseniority",
]


def v_sellers(d: Dialect) -> str:
    sex = "CASE WHEN s.s_suppkey % 2 = 0 THEN 'f' ELSE 'm' END"
    ints = {
        "nbsellers": "CASE WHEN n.n_nationkey % 6 = 0 THEN '0' ELSE CAST(sum(s.s_suppkey) % 3000 AS STRING) END",
        "totalproductssold": "sum(s.s_suppkey % 97)",
        "totalproductslisted": "CAST(sum(s.s_suppkey % 1013) AS STRING)",
        "totalbought": "sum(s.s_suppkey % 89)",
        "totalwished": "CASE WHEN n.n_nationkey % 4 = 1 THEN 'x' ELSE CAST(sum(s.s_suppkey % 83) AS STRING) END",
        "totalproductsliked": "sum(s.s_suppkey % 79)",
    }
    decs = {}
    for i, name in enumerate(SELLER_DEC_COLS):
        body = _dec(f"sum(s.s_suppkey % {11 + 3 * i}) % 1000")
        if name == "meansellerpassrate":
            decs[name] = f"CASE WHEN n.n_nationkey % 5 = 0 OR (min(s.s_suppkey % 2) = 1 AND n.n_nationkey % 3 = 0) THEN NULL ELSE {_dec('sum(s.s_suppkey * 7) % 1000')} END"
        else:
            decs[name] = body
    cols = ",\n  ".join(f"{e} AS {k}" for k, e in {**ints, **decs}.items())
    return f"""
SELECT lower(n.n_name) AS country, {sex} AS sex,
  {cols}
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name, {sex}
"""


COUNTRY_INT_COLS = [
    "sellers", "topsellers", "femalesellers", "malesellers", "topfemalesellers", "topmalesellers",
    "toptotalproductssold", "totalproductssold", "toptotalproductslisted", "totalproductslisted",
]
COUNTRY_DEC_COLS = [
    "topsellerratio", "femalesellersratio", "topfemalesellersratio", "countrysoldratio", "bestsoldratio",
    "topmeanproductssold", "topmeanproductslisted", "meanproductssold", "meanproductslisted",
    "meanofflinedays", "topmeanofflinedays", "meanfollowers", "meanfollowing", "topmeanfollowers",
    "topmeanfollowing",
]


def v_countries(d: Dialect) -> str:
    top = "s.s_acctbal > 4000"
    ints = {
        "sellers": "CAST(count(s.s_suppkey) AS STRING)",
        "topsellers": f"sum(CASE WHEN {top} THEN 1 ELSE 0 END)",
        "femalesellers": "sum(CASE WHEN s.s_suppkey % 2 = 0 THEN 1 ELSE 0 END)",
        "malesellers": "sum(CASE WHEN s.s_suppkey % 2 = 1 THEN 1 ELSE 0 END)",
        "topfemalesellers": f"sum(CASE WHEN s.s_suppkey % 2 = 0 AND {top} THEN 1 ELSE 0 END)",
        "topmalesellers": f"sum(CASE WHEN s.s_suppkey % 2 = 1 AND {top} THEN 1 ELSE 0 END)",
        "toptotalproductssold": f"sum(CASE WHEN {top} THEN s.s_suppkey % 7 ELSE 0 END)",
        "totalproductssold": "CAST(sum(s.s_suppkey % 13) AS STRING)",
        "toptotalproductslisted": f"sum(CASE WHEN {top} THEN s.s_suppkey % 9 ELSE 0 END)",
        "totalproductslisted": "sum(s.s_suppkey % 17)",
    }
    decs = {}
    for i, name in enumerate(COUNTRY_DEC_COLS):
        if name == "meanofflinedays":
            decs[name] = f"CASE WHEN n.n_nationkey % 8 = 7 THEN NULL ELSE {_dec('sum(s.s_suppkey * 13) % 10000', '0.01')} END"
        elif name == "femalesellersratio":
            decs[name] = _dec("sum(s.s_suppkey * 3) % 1000")
        else:
            decs[name] = _dec(f"sum(s.s_suppkey % {5 + 2 * i}) % 1000")
    cols = ",\n  ".join(f"{e} AS {k}" for k, e in {**ints, **decs}.items())
    return f"""
SELECT lower(n.n_name) AS country,
  {cols}
FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name
"""


# ---------------------------------------------------------------- sales and logs

def v_raw_sales(d: Dialect) -> str:
    day = "CAST(l_shipdate AS DATE)"
    unpadded = (f"CAST(year({day}) AS STRING) || '-' || CAST(month({day}) AS STRING) || '-' "
                f"|| CAST(day({day}) AS STRING)")
    return f"""
SELECT
  CAST(l_orderkey * 10 + l_linenumber AS STRING) AS id,
  CASE WHEN l_orderkey % 13 = 0 THEN 'INVALID_DATE'
       WHEN l_orderkey % 7 = 0 THEN {unpadded}
       ELSE CAST({day} AS STRING) END AS date,
  CASE WHEN l_partkey % 11 = 0 THEN NULL
       WHEN l_partkey % 17 = 0 THEN 'not_a_number'
       WHEN l_partkey % 3 = 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + l_orderkey % 100 * 0.0001 AS STRING)
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS amount,
  CASE WHEN l_suppkey % 23 = 0 THEN 'invalid'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 0.01 AS STRING) END AS price,
  CASE WHEN l_orderkey % 19 = 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.0'
       ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
  'Item_' || CAST(l_partkey % 100 AS STRING) AS item
FROM lineitem
"""


def v_logs(d: Dialect) -> str:
    level = "CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END"
    unpadded = ("CAST(year(ts) AS STRING) || '-' || CAST(month(ts) AS STRING) || '-' || CAST(day(ts) AS STRING)"
                " || ' ' || CAST(hour(ts) AS STRING) || ':' || CAST(minute(ts) AS STRING) || ':' "
                "|| CAST(CAST(floor(second(ts)) AS INT) AS STRING)")
    msg = ("CASE WHEN event_type <> 'error' AND event_id % 29 = 0 THEN 'retry after ERROR in ' || event_type "
           "ELSE 'user ' || CAST(user_id AS STRING) || ' ' || event_type END")
    return f"""
SELECT event_id AS line_no,
  CASE
    WHEN event_id % 37 = 0 THEN {d.ts_text('ts')} || ' ERROR missing separators'
    WHEN event_id % 31 = 0 THEN 'bad-ts | ERROR | garbled'
    WHEN event_id % 41 = 0 THEN substr({d.ts_text('ts')}, 1, 17) || '60 | ' || {level} || ' | ' || {msg}
    WHEN event_id % 43 = 0 THEN {unpadded} || ' | ' || {level} || ' | ' || {msg}
    WHEN event_id % 17 = 0 THEN {d.ts_text('ts')} || {d.tab()} || '| ' || {level} || {d.tab()} || '|' || {d.tab()} || {msg}
    ELSE {d.ts_text('ts')} || ' | ' || {level} || ' | ' || {msg}
  END AS value
FROM events
"""


# ---------------------------------------------------------------- incremental, API

def v_source(d: Dialect) -> str:
    return """
SELECT o_orderkey AS id, o_orderpriority AS data, o_orderstatus AS status,
       o_totalprice AS amount, o_orderdate AS updated_at
FROM orders
"""


def v_source_text(d: Dialect) -> str:
    """The incremental source as a text export: ``yyyy-MM-dd HH:mm:ss`` strings, a few malformed."""
    return f"""
SELECT o_orderkey AS id, o_orderpriority AS data,
  CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-time'
       WHEN o_orderkey % 89 = 0 THEN {d.ts_text('o_orderdate')} || 'Z'
       WHEN o_orderkey % 83 = 0 THEN substr({d.ts_text('o_orderdate')}, 1, 17) || '60'
       ELSE {d.ts_text('o_orderdate')} END AS updated_at
FROM orders
"""


def v_api(d: Dialect) -> str:
    ck = "c_custkey"
    contact = f"""CASE WHEN {ck} % 7 = 0 THEN 'null'
         WHEN {ck} % 7 = 1 THEN '{{"phone": "555-' || CAST({ck} % 10000 AS STRING) || '"}}'
         WHEN {ck} % 7 = 2 THEN '{{"email": null, "phone": null}}'
         ELSE '{{"email": "user' || CAST({ck} AS STRING) || '@example.com", "phone": null}}' END"""
    meta = f"""CASE WHEN {ck} % 5 = 0 THEN 'null'
         WHEN {ck} % 5 = 1 THEN '{{"city": "City_' || CAST(c_nationkey AS STRING) || '"}}'
         WHEN {ck} % 5 = 2 THEN '{{"city": null, "signup_date": "2026-02-0' || CAST({ck} % 9 + 1 AS STRING) || '"}}'
         WHEN {ck} % 5 = 3 THEN '{{}}'
         ELSE '{{"city": "City_' || CAST(c_nationkey AS STRING) || '", "signup_date": "2025-1' || CAST({ck} % 3 AS STRING) || '-15"}}' END"""
    name = f"""CASE WHEN {ck} % 19 = 0 THEN '' ELSE '"name": "' || c_name || '", ' END"""
    user = f"""CASE WHEN {ck} % 41 = 0 THEN ', "user": null'
         WHEN {ck} % 43 = 0 THEN ''
         ELSE ', "user": {{' || {name} || '"contact": ' || {contact} || ', "meta": ' || {meta} || '}}' END"""
    ident = f"""CASE WHEN {ck} % 47 = 0 THEN '"uid": ' ELSE '"id": ' END"""
    return f"""
SELECT {ck} AS api_row,
  '{{' || {ident} || CAST({ck} AS STRING) || {user} || '}}' AS json
FROM customer
"""


# ---------------------------------------------------------------- rentals

def v_bookings(d: Dialect) -> str:
    return """
SELECT
  l_orderkey * 10 + l_linenumber AS booking_id,
  l_partkey AS listing_id,
  CAST(l_shipdate AS DATE) AS booking_date,
  CAST(l_quantity AS INT) % 14 + 1 AS nights_booked,
  CAST(l_extendedprice AS DECIMAL(12,2)) * 0.01 AS booking_amount,
  CAST(l_tax * 1000 AS DECIMAL(10,2)) AS cleaning_fee,
  CAST(l_discount * 500 AS DECIMAL(10,2)) AS service_fee,
  CASE l_returnflag WHEN 'A' THEN 'confirmed' WHEN 'R' THEN 'cancelled' ELSE 'pending' END AS booking_status,
  l_shipdate AS created_at
FROM lineitem
"""


def v_listings(d: Dialect) -> str:
    return f"""
SELECT
  p_partkey AS listing_id,
  p_partkey % 120 AS host_id,
  p_type AS property_type,
  p_brand AS room_type,
  'City_' || CAST(p_partkey % 30 AS STRING) AS city,
  'Country_' || CAST(p_partkey % 7 AS STRING) AS country,
  p_size % 8 + 1 AS accommodates,
  p_size % 4 + 1 AS bedrooms,
  p_size % 3 + 1 AS bathrooms,
  CAST(p_retailprice AS DECIMAL(10,2)) * (0.05 + 0.01 * (p_partkey % 10)) AS price_per_night,
  {d.day_ts('1997-01-01', 'p_partkey % 700')} AS created_at
FROM part
"""


def v_hosts(d: Dialect) -> str:
    return f"""
SELECT
  s_suppkey AS host_id,
  'Host ' || s_name || CASE WHEN s_suppkey % 3 = 0 THEN ' Jr' ELSE '' END AS host_name,
  {d.day('1990-01-01', 's_suppkey % 2000')} AS host_since,
  s_acctbal > 5000 AS is_superhost,
  CASE WHEN s_suppkey % 10 = 7 THEN NULL ELSE CAST(s_suppkey * 7 % 101 AS INT) END AS response_rate,
  {d.day_ts('1997-01-01', 's_suppkey % 500')} AS created_at
FROM supplier
"""


# ---------------------------------------------------------------- olympics

def v_medals(d: Dialect) -> str:
    return """
SELECT n.n_name AS TeamCountry,
  CAST(sum(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS Gold,
  CAST(sum(CASE WHEN o.o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS Silver,
  CAST(sum(CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS Bronze,
  count(*) AS Total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
"""


def v_entries(d: Dialect) -> str:
    return """
SELECT n.n_name AS Discipline,
  CAST(sum(CASE WHEN c.c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END) AS STRING) AS Female,
  CAST(sum(CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS STRING) AS Male,
  CASE WHEN n.n_nationkey % 9 = 4 THEN 'n/a' ELSE CAST(count(*) AS STRING) END AS Total
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_nationkey, n.n_name
"""


# ---------------------------------------------------------------- hierarchy

def v_tree(d: Dialect) -> str:
    """Customers as a binary tree: the parent of k is (k - 1) div 2, the root is 0."""
    return """
SELECT c_custkey AS node,
  CASE WHEN c_custkey = 0 THEN NULL
       ELSE CAST((c_custkey - 1 - (c_custkey - 1) % 2) / 2 AS BIGINT) END AS parent,
  c_nationkey AS nationkey
FROM customer
"""


VIEWS = {
    "v_users": v_users, "v_buyers": v_buyers, "v_sellers": v_sellers, "v_countries": v_countries,
    "v_raw_sales": v_raw_sales, "v_logs": v_logs, "v_source": v_source, "v_source_text": v_source_text,
    "v_api": v_api,
    "v_bookings": v_bookings, "v_listings": v_listings, "v_hosts": v_hosts,
    "v_medals": v_medals, "v_entries": v_entries, "v_tree": v_tree,
}


# ---------------------------------------------------------------- access

_REGISTERED: dict[tuple[str, str], str] = {}


def _app(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: key by the session object
        return str(id(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose driver parquet files as temp views for the stand-in SQL (once per session and folder)."""
    app = _app(spark)
    for t in names:
        if _REGISTERED.get((app, t)) == sf_dir:
            continue
        table(spark, sf_dir, t).createOrReplaceTempView(t)
        _REGISTERED[(app, t)] = sf_dir


def tables_in(sql: str) -> list[str]:
    return [t for t in DRIVER_TABLES if re.search(rf"\b{t}\b", sql)]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in input as a (lazy) Spark DataFrame."""
    sql = VIEWS[name](SPARK)
    register_tables(spark, sf_dir, tables_in(sql))
    return spark.sql(sql)


def with_views(body: str, *names: str, extra: dict | None = None) -> str:
    """Oracle text: the named stand-ins as DuckDB CTEs, then ``body``."""
    ctes = [f"{n} AS ({VIEWS[n](DUCK)})" for n in names]
    ctes += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
