"""Olympics clean-and-publish: typed casts, top-k, gender shares, CSV publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.rules import cast_by_spec, ratio
from strata.plans.registry import query
from strata.plans.views import register_tables, view, with_views
from strata.session import scratch_path
from strata.sources.readers import read_by_path_regex, read_csv_typed
from strata.sources.sinks import publish_csv, publish_csv_dated

TOP_K = 20  # rows a console preview shows
RUN_DATE = "2024-06-30"
ENTRY_SCHEMA = "Discipline STRING, Female INT, Male INT, Total INT"
MEDAL_SCHEMA = "TeamCountry STRING, Gold BIGINT, Silver BIGINT, Bronze BIGINT, Total BIGINT"


def top_gold(medals: DataFrame, k: int = TOP_K) -> DataFrame:
    """Countries by gold medals, most first (ties by name): a top-k, not a global sort."""
    return medals.orderBy(F.desc("Gold"), F.asc("TeamCountry")).limit(k).select("TeamCountry", "Gold")


def typed_entries(entries: DataFrame) -> DataFrame:
    return cast_by_spec(entries, {"int": ["Female", "Male", "Total"]})


def gender_shares(entries: DataFrame) -> DataFrame:
    """Female/Total and Male/Total, unrounded; NULL when Total is 0 or unknown."""
    return typed_entries(entries).withColumns({
        "Avg_Female": ratio("Female", "Total", scale=None),
        "Avg_Male": ratio("Male", "Total", scale=None),
    })


_ENTRIES = "SELECT Discipline, TRY_CAST(Female AS INTEGER) AS Female, TRY_CAST(Male AS INTEGER) AS Male, " \
           "TRY_CAST(Total AS INTEGER) AS Total FROM v_entries"


@query("topk_medals", with_views(
    "SELECT TeamCountry, Gold FROM v_medals ORDER BY Gold DESC, TeamCountry LIMIT 20", "v_medals"))
def q_topk_medals(spark, sf):
    return top_gold(view(spark, sf, "v_medals"))


@query("share_by_gender", with_views(f"""
SELECT *, CAST(Female AS DOUBLE) / nullif(Total, 0) AS Avg_Female, CAST(Male AS DOUBLE) / nullif(Total, 0) AS Avg_Male
FROM ({_ENTRIES}) e""", "v_entries"))
def q_share_by_gender(spark, sf):
    return gender_shares(view(spark, sf, "v_entries"))


@query("publish_csv", with_views(_ENTRIES, "v_entries"))
def q_publish_csv(spark, sf):
    """A table published as CSV with a header, then read back typed."""
    path = scratch_path(spark, "entriesgender")
    publish_csv(typed_entries(view(spark, sf, "v_entries")), path)
    return read_csv_typed(spark, path, ENTRY_SCHEMA)


@query("publish_csv_dated", with_views("SELECT * FROM v_medals", "v_medals"))
def q_publish_csv_dated(spark, sf):
    """Published under ``medals/medals_<run date>``; read back by a path pattern on that date."""
    base = scratch_path(spark, "transformed")
    publish_csv_dated(view(spark, sf, "v_medals"), base, "medals", RUN_DATE)
    publish_csv_dated(view(spark, sf, "v_medals"), base, "medals", "2024-06-29")  # an older run
    return read_by_path_regex(spark, base, f".*medals_{RUN_DATE}.*", "csv", MEDAL_SCHEMA, header=True)


#: the five published tables: stand-in for each, and its columns
ATHLETES = ("SELECT c_name AS PersonName, n_name AS Country, c_mktsegment AS Discipline "
            "FROM customer JOIN nation ON c_nationkey = n_nationkey")
COACHES = ("SELECT s_name AS Name, n_name AS Country, CAST(s_suppkey % 9 AS STRING) AS Discipline, "
           "CAST(s_suppkey % 4 AS STRING) AS Event FROM supplier JOIN nation ON s_nationkey = n_nationkey")
TEAMS = ("SELECT p_brand || ' ' || CAST(p_partkey AS STRING) AS TeamName, p_type AS Discipline, "
         "CAST(p_size % 25 AS STRING) AS Country, CAST(p_size AS STRING) AS Event FROM part")
PUBLISHED = {
    "athletes": (ATHLETES, "PersonName STRING, Country STRING, Discipline STRING"),
    "coaches": (COACHES, "Name STRING, Country STRING, Discipline STRING, Event STRING"),
    "entriesgender": (None, ENTRY_SCHEMA),
    "medals": (None, MEDAL_SCHEMA),
    "teams": (TEAMS, "TeamName STRING, Discipline STRING, Country STRING, Event STRING"),
}


def publish_all(spark, sf: str, base: str) -> None:
    """Every table of the job as CSV with a header, below its own folder."""
    register_tables(spark, sf, ["customer", "nation", "supplier", "part"])
    for name, (sql, _) in PUBLISHED.items():
        if name == "entriesgender":
            df = typed_entries(view(spark, sf, "v_entries"))
        else:
            df = view(spark, sf, "v_medals") if name == "medals" else spark.sql(sql)
        publish_csv(df, f"{base}/{name}")


def _count(name: str, source: str, column: str) -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT {column}) AS distinct_values FROM ({source}) t"


@query("publish_all_tables", with_views(" UNION ALL ".join([
    _count("athletes", ATHLETES, "PersonName"), _count("coaches", COACHES, "Name"),
    _count("entriesgender", "SELECT * FROM v_entries", "Discipline"),
    _count("medals", "SELECT * FROM v_medals", "TeamCountry"), _count("teams", TEAMS, "TeamName")]), "v_entries", "v_medals"))
def q_publish_all_tables(spark, sf):
    """All five tables published, read back typed, and counted."""
    base = scratch_path(spark, "olympics")
    publish_all(spark, sf, base)
    out = None
    for name, (_, schema) in PUBLISHED.items():
        df = read_csv_typed(spark, f"{base}/{name}", schema)
        row = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(df.columns[0]).alias("distinct_values")) \
            .select(F.lit(name).alias("table_name"), "row_count", "distinct_values")
        out = row if out is None else out.unionByName(row)
    return out
