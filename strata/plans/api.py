"""Nested user API records -> flat rows with defaults; URL ids.

Defaults apply only where a key is *missing* (or its parent object is null or
absent); an explicit JSON null stays NULL.  A record whose ``user`` is an
explicit null would abort the source job for the whole file; here it becomes a
reject row and the rest of the input still loads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.parse import url_last_segment
from strata.operators.nested import is_json_null, json_field
from strata.plans.registry import query
from strata.plans.views import table, view, with_views
from strata.session import scratch_path
from strata.sources.readers import read_json_records

# fixed values of the source job
DEFAULTS = {"full_name": "N/A", "email": "N/A", "city": "Remote", "signup_date": "2026-01-01"}
PATHS = {"full_name": "$.user.name", "email": "$.user.contact.email", "city": "$.user.meta.city",
         "signup_date": "$.user.meta.signup_date"}


def flatten_records(records: DataFrame, vcol: str = "v") -> tuple[DataFrame, DataFrame]:
    """(flat rows, rejects) from variant records.  Unparsable records and
    ``"user": null`` are rejects."""
    v = F.col(vcol)
    bad = records.where(v.isNull() | is_json_null(v, "$.user"))
    good = records.where(v.isNotNull() & ~is_json_null(v, "$.user"))
    flat = good.select(json_field(v, "$.id", None, "bigint").alias("user_id"),
                       *[json_field(v, PATHS[k], DEFAULTS[k]).alias(k) for k in PATHS])
    rejects = bad.select(F.to_json(v).alias("record"), F.lit("null_user_or_bad_json").alias("reason"))
    return flat, rejects


def flatten_users(df: DataFrame, json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """Same, from a column of JSON text."""
    return flatten_records(df.select(F.try_parse_json(json_col).alias("v")))


ARRAY_CHUNK = 100


def land_api_files(spark, sf: str) -> str:
    """API responses as files: each line a JSON array of up to 100 records."""
    path = scratch_path(spark, "api_responses")
    api = view(spark, sf, "v_api")
    (api.groupBy(F.floor(F.col("api_row") / ARRAY_CHUNK).alias("chunk"))
        .agg(F.concat(F.lit("["), F.array_join(F.collect_list("json"), ", "), F.lit("]")).alias("value"))
        .select("value").write.option("compression", "gzip").text(path))
    return path


def _get(path: str, default: str) -> str:
    return (f"CASE WHEN json_extract(json, '{path}') IS NULL THEN '{default}' "
            f"ELSE json_extract_string(json, '{path}') END")


SQL_FLATTEN = with_views(f"""
SELECT CAST(json_extract(json, '$.id') AS BIGINT) AS user_id,
  {", ".join(f"{_get(PATHS[k], DEFAULTS[k])} AS {k}" for k in PATHS)}
FROM v_api WHERE coalesce(json_type(json_extract(json, '$.user')), '') <> 'NULL'
""", "v_api")


@query("flatten_json_defaults", SQL_FLATTEN)
def q_flatten_json_defaults(spark, sf):
    return flatten_records(read_json_records(spark, land_api_files(spark, sf)))[0]


@query("flatten_json_rejects", with_views("""
SELECT CAST(json_extract(json, '$.id') AS BIGINT) AS user_id, 'null_user_or_bad_json' AS reason
FROM v_api WHERE coalesce(json_type(json_extract(json, '$.user')), '') = 'NULL'
""", "v_api"))
def q_flatten_json_rejects(spark, sf):
    """Records whose user is an explicit null, kept with a reason."""
    rejects = flatten_records(read_json_records(spark, land_api_files(spark, sf)))[1]
    return rejects.select(F.get_json_object("record", "$.id").cast("bigint").alias("user_id"), "reason")


@query("url_last_segment", """
SELECT page_id, url, split_part(split_part(url, '/', -1), '?', 1) AS url_id FROM pages
""")
def q_url_last_segment(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url", url_last_segment("url").alias("url_id"))
