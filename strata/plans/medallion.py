"""E-commerce medallion: bronze inputs -> silver rules -> gold one-big-table.

Each silver step is one ``withColumns`` per dependency level, so Catalyst
collapses the whole rule set into a single projection over the scan.  The
order of evaluation that changes results is kept: the login-years ratio reads
the raw days before the 0-fill; the age group tests the rounded years; the
descriptor uses the mapped gender and the cleaned title while the long-title
flag uses the original one; the pass-rate label is computed before the mean
fill; the performance flag tests the rounded indicator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.rules import (
    bucketize, cast_by_spec, descriptor, fill_zero, flag, int_or_zero, prefix_map,
    ratio, round_half_up, smoothed_ratio, value_map,
)
from strata.operators.obt import outer_chain
from strata.plans.registry import query
from strata.plans.views import (
    BUYER_DEC_COLS, BUYER_INT_COLS, COUNTRY_DEC_COLS, COUNTRY_INT_COLS, SELLER_DEC_COLS,
    SELLER_INT_COLS, view, with_views,
)

# fixed values of the source job
LANGUAGES = {"EN": "English", "FR": "French"}
LANGUAGE_ELSE = "Other"
GENDER_PREFIXES = [("M", "Male"), ("F", "Female")]
GENDER_ELSE = "Other"
TITLE_PATTERN = "(Mme|Ms|Mrs)"
TITLE_REPLACEMENT = "Ms"
AGE_GROUPS = [(1, "New"), (3, "Intermediate")]
AGE_ELSE = "Experienced"
LONG_TITLE = 10
SELLER_SIZES = [(500, "Small"), (2000, "Medium")]
SELLER_SIZE_ELSE = "Large"
PASS_RATE_HIGH = 0.75
HIGH_ENGAGEMENT = 0.5
HIGH_FEMALE_RATIO = 0.5
HIGH_PERFORMANCE = 0.8
ACTIVITY_LEVELS = [(30, "Highly Active"), (60, "Moderately Active")]
ACTIVITY_ELSE = "Low Activity"
DEC = "decimal(10,2)"

AS_OF = "2024-12-31"   # injected run date (the source used current_date)

USER_BOOL_COLS = ["hasanyapp", "hasandroidapp", "hasiosapp", "hasprofilepicture"]
USER_INT_COLS = ["socialnbfollowers", "socialnbfollows"]
USER_DEC_COLS = ["productspassrate", "seniorityasmonths", "seniorityasyears"]


# ---------------------------------------------------------------- silver rules

def users_silver(df: DataFrame, as_of: str = AS_OF) -> DataFrame:
    level1 = df.withColumns({
        "countrycode": F.upper("countrycode"),
        "language_full": value_map("language", LANGUAGES, LANGUAGE_ELSE),
        "gender": prefix_map("gender", GENDER_PREFIXES, GENDER_ELSE),
        "civilitytitle_clean": F.regexp_replace("civilitytitle", TITLE_PATTERN, TITLE_REPLACEMENT),
        "years_since_last_login": F.col("dayssincelastlogin") / F.lit(365),
        "account_age_years": round_half_up(F.col("seniority") / F.lit(365), 2),
        "current_year": F.year(F.lit(as_of).cast("date")),
        "flag_long_title": F.length("civilitytitle") > LONG_TITLE,
        **{c: F.col(c).try_cast("boolean") for c in USER_BOOL_COLS},
        **{c: F.col(c).try_cast("int") for c in USER_INT_COLS},
        **{c: F.col(c).try_cast(DEC) for c in USER_DEC_COLS},
    })
    return level1.withColumns({
        "account_age_group": bucketize("account_age_years", AGE_GROUPS, AGE_ELSE),
        "user_descriptor": descriptor("gender", "countrycode",
                                      F.substring("civilitytitle_clean", 1, 3), "language_full"),
        "dayssincelastlogin": int_or_zero("dayssincelastlogin"),
    })


def buyers_silver(df: DataFrame) -> DataFrame:
    typed = cast_by_spec(df, {"int": BUYER_INT_COLS, DEC: BUYER_DEC_COLS})
    typed = fill_zero(typed.withColumn("country", F.initcap("country")), BUYER_INT_COLS)
    return typed.withColumns({
        "female_to_male_ratio": smoothed_ratio("femalebuyers", "malebuyers"),
        "wishlist_to_purchase_ratio": smoothed_ratio("totalproductswished", "totalproductsbought"),
        "high_engagement": flag(F.col("boughtperwishlistratio") > HIGH_ENGAGEMENT),
        "growing_female_market": flag(F.col("femalebuyersratio") > F.col("topfemalebuyersratio")),
    })


def impute_mean(df: DataFrame, cols, scale: int = 2) -> DataFrame:
    """NULL -> the column mean (rounded half-up), via one uncorrelated scalar subquery.

    The mean is computed once on the cluster and inlined as a literal; nothing
    is collected by the caller.  The filled column keeps its type.
    """
    types = dict(df.dtypes)
    means = df.agg(*[round_half_up(F.sum(c).cast("double") / F.count(c), scale).alias(c) for c in cols])
    return df.withColumns({
        c: F.coalesce(F.col(c), means.select(c).scalar().cast(types[c])).cast(types[c]) for c in cols
    })


def sellers_silver(df: DataFrame) -> DataFrame:
    typed = cast_by_spec(df, {"int": SELLER_INT_COLS, DEC: SELLER_DEC_COLS})
    labelled = typed.withColumns({
        "country": F.initcap("country"),
        "sex": F.upper("sex"),
        "seller_size_category": bucketize("nbsellers", SELLER_SIZES, SELLER_SIZE_ELSE),
        "mean_products_listed_per_seller": ratio("totalproductslisted", "nbsellers"),
        "high_seller_pass_rate": F.when(F.col("meansellerpassrate") > PASS_RATE_HIGH, "High").otherwise("Normal"),
    })
    return impute_mean(labelled, ["meansellerpassrate"])


def countries_silver(df: DataFrame) -> DataFrame:
    typed = cast_by_spec(df, {"int": COUNTRY_INT_COLS, DEC: COUNTRY_DEC_COLS})
    level1 = typed.withColumns({
        "country": F.initcap("country"),
        "top_seller_ratio": ratio("topsellers", "sellers"),
        "high_female_seller_ratio": flag(F.col("femalesellersratio") > HIGH_FEMALE_RATIO),
        "performance_indicator": smoothed_ratio("toptotalproductssold", "toptotalproductslisted"),
        "activity_level": bucketize("meanofflinedays", ACTIVITY_LEVELS, ACTIVITY_ELSE),
    })
    return level1.withColumn("high_performance", flag(F.col("performance_indicator") > HIGH_PERFORMANCE))


# ---------------------------------------------------------------- gold

KEY = "country_key"
GOLD_USERS = {"productsSold": "Users_productsSold", "productsWished": "Users_productsWished",
              "account_age_years": "Users_account_age_years", "account_age_group": "Users_account_age_group",
              "hasanyapp": "Users_hasanyapp", "socialnbfollowers": "Users_socialnbfollowers",
              "flag_long_title": "Users_flag_long_title"}
GOLD_COUNTRIES = {"sellers": "Countries_Sellers", "topsellers": "Countries_TopSellers",
                  "femalesellers": "Countries_FemaleSellers", "malesellers": "Countries_MaleSellers",
                  "topfemalesellers": "Countries_TopFemaleSellers", "topmalesellers": "Countries_TopMaleSellers"}
GOLD_BUYERS = {"buyers": "Buyers_Total", "topbuyers": "Buyers_Top", "femalebuyers": "Buyers_Female",
               "malebuyers": "Buyers_Male", "topfemalebuyers": "Buyers_TopFemale", "topmalebuyers": "Buyers_TopMale"}
GOLD_SELLERS = {"nbsellers": "Sellers_Total", "sex": "Sellers_Sex",
                "meanproductssold": "Sellers_MeanProductsSold", "meanproductslisted": "Sellers_MeanProductsListed"}


def _side(df: DataFrame, mapping: dict, keep_country: bool = False) -> DataFrame:
    cols = [F.col("country").alias(KEY)]
    if keep_country:
        cols.append(F.col("country").alias("Country"))
    return df.select(*cols, *[F.col(k).alias(v) for k, v in mapping.items()])


def sellers_by_country_sex(sellers: DataFrame) -> DataFrame:
    """Sellers at (country, sex) grain: counts summed, means averaged (per-seller input)."""
    return sellers.groupBy("country", "sex").agg(
        F.sum("nbsellers").cast("int").alias("nbsellers"),
        F.avg("meanproductssold").cast(DEC).alias("meanproductssold"),
        F.avg("meanproductslisted").cast(DEC).alias("meanproductslisted"))


def gold_user_obt(users: DataFrame, countries: DataFrame, buyers: DataFrame, sellers: DataFrame,
                  force: str | None = None, pre_aggregate: bool = False,
                  normalize_key: bool = False) -> DataFrame:
    """users ⟗ countries ⟗ buyers ⟗ sellers USING (country).

    ``Country`` is the users' key (NULL for rows only the other tables have, as
    in the source); ``country_key`` is the coalesced join key.  Each user row
    repeats once per seller row of its country (the source's grain: one per
    sex); ``pre_aggregate`` first brings finer seller rows to that grain.
    ``normalize_key`` title-cases the users' country for the join as the other
    three tables already are (off by default, as in the source, where users
    spelled differently stay unmatched).
    """
    if pre_aggregate:
        sellers = sellers_by_country_sex(sellers)
    if normalize_key:
        users = users.withColumn("country", F.initcap("country"))
    return outer_chain(
        _side(users, GOLD_USERS, keep_country=True),
        [_side(countries, GOLD_COUNTRIES), _side(buyers, GOLD_BUYERS), _side(sellers, GOLD_SELLERS)],
        KEY, force=force)


#: countries that only some of gold's inputs know, so that the outer joins meet unmatched keys on each
#: side: the rows of the first country come once more under each of these names
STRANGERS = {"countries": ("Atlantis", "Erewhon"), "buyers": ("Atlantis", "Lilliput"), "sellers": ("Lilliput", "Utopia")}


def with_strangers(df: DataFrame, side: str) -> DataFrame:
    first = df.join(df.agg(F.min("country").alias("country")), "country", "left_semi")
    more = first.withColumn("country", F.explode(F.array(*map(F.lit, STRANGERS[side]))))
    return df.unionByName(more.select(*df.columns))


def _with_strangers(cte: str, side: str) -> str:
    names = ", ".join(f"'{n}'" for n in STRANGERS[side])
    return (f"(SELECT * FROM {cte} UNION ALL SELECT * REPLACE (unnest([{names}]) AS country) FROM {cte} "
            f"WHERE country = (SELECT min(country) FROM {cte}))")


def silver_tables(spark, sf):
    """Gold's inputs: the whole silver tables, and rows of countries that not all of them know."""
    return (users_silver(view(spark, sf, "v_users")),
            with_strangers(countries_silver(view(spark, sf, "v_countries")), "countries"),
            with_strangers(buyers_silver(view(spark, sf, "v_buyers")), "buyers"),
            with_strangers(sellers_silver(view(spark, sf, "v_sellers")), "sellers"))


# ---------------------------------------------------------------- oracles (DuckDB)

def _int(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim(CAST({c} AS VARCHAR)), '[+-]?[0-9]+') "
            f"THEN TRY_CAST({c} AS INTEGER) END")


def _r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), 2) AS DOUBLE)"


SQL_USERS_SILVER = f"""
SELECT user_id, country, upper(countrycode) AS countrycode, language,
  CASE WHEN gender LIKE 'M%' THEN 'Male' WHEN gender LIKE 'F%' THEN 'Female' ELSE 'Other' END AS gender,
  civilitytitle,
  CASE WHEN dayssincelastlogin IS NOT NULL THEN TRY_CAST(dayssincelastlogin AS INTEGER) ELSE 0 END AS dayssincelastlogin,
  seniority,
  {", ".join(f"TRY_CAST({c} AS BOOLEAN) AS {c}" for c in USER_BOOL_COLS)},
  {", ".join(f"{_int(c)} AS {c}" for c in USER_INT_COLS)},
  {", ".join(f"TRY_CAST({c} AS DECIMAL(10,2)) AS {c}" for c in USER_DEC_COLS)},
  productsSold, productsWished,
  CASE language WHEN 'EN' THEN 'English' WHEN 'FR' THEN 'French' ELSE 'Other' END AS language_full,
  regexp_replace(civilitytitle, '(Mme|Ms|Mrs)', 'Ms', 'g') AS civilitytitle_clean,
  dayssincelastlogin / 365 AS years_since_last_login,
  {_r2('seniority / 365')} AS account_age_years,
  CASE WHEN {_r2('seniority / 365')} < 1 THEN 'New' WHEN {_r2('seniority / 365')} < 3 THEN 'Intermediate'
       ELSE 'Experienced' END AS account_age_group,
  CAST(year(DATE '{AS_OF}') AS INTEGER) AS current_year,
  (CASE WHEN gender LIKE 'M%' THEN 'Male' WHEN gender LIKE 'F%' THEN 'Female' ELSE 'Other' END)
    || '_' || upper(countrycode) || '_'
    || substring(regexp_replace(civilitytitle, '(Mme|Ms|Mrs)', 'Ms', 'g'), 1, 3) || '_'
    || (CASE language WHEN 'EN' THEN 'English' WHEN 'FR' THEN 'French' ELSE 'Other' END) AS user_descriptor,
  length(civilitytitle) > 10 AS flag_long_title
FROM v_users
"""


def _typed(int_cols, dec_cols, fill_ints: bool) -> str:
    ints = [f"coalesce({_int(c)}, 0) AS {c}" if fill_ints else f"{_int(c)} AS {c}" for c in int_cols]
    decs = [f"TRY_CAST({c} AS DECIMAL(10,2)) AS {c}" for c in dec_cols]
    return ", ".join(ints + decs)


def _ratio(a: str, b: str) -> str:
    return _r2(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)")


_INITCAP = "(upper(substr(country, 1, 1)) || lower(substr(country, 2)))"

SQL_BUYERS_SILVER = f"""
SELECT *,
  {_ratio('femalebuyers', 'malebuyers + 1')} AS female_to_male_ratio,
  {_ratio('totalproductswished', 'totalproductsbought + 1')} AS wishlist_to_purchase_ratio,
  coalesce(boughtperwishlistratio > 0.5, false) AS high_engagement,
  coalesce(femalebuyersratio > topfemalebuyersratio, false) AS growing_female_market
FROM (SELECT {_INITCAP} AS country, {_typed(BUYER_INT_COLS, BUYER_DEC_COLS, True)} FROM v_buyers) t
"""

SQL_SELLERS_TYPED = f"""
SELECT {_INITCAP} AS country, upper(sex) AS sex, {_typed(SELLER_INT_COLS, SELLER_DEC_COLS, False)} FROM v_sellers
"""

_MEAN = "(SELECT round(CAST(CAST(sum(meansellerpassrate) AS DOUBLE) / count(meansellerpassrate) AS DECIMAL(38,8)), 2) FROM sellers_typed)"

SQL_SELLERS_SILVER = f"""
SELECT * REPLACE (CAST(coalesce(meansellerpassrate, {_MEAN}) AS DECIMAL(10,2)) AS meansellerpassrate),
  CASE WHEN nbsellers < 500 THEN 'Small' WHEN nbsellers < 2000 THEN 'Medium' ELSE 'Large' END AS seller_size_category,
  {_ratio('totalproductslisted', 'nbsellers')} AS mean_products_listed_per_seller,
  CASE WHEN meansellerpassrate > 0.75 THEN 'High' ELSE 'Normal' END AS high_seller_pass_rate
FROM sellers_typed
"""

SQL_COUNTRIES_SILVER = f"""
SELECT *,
  {_ratio('topsellers', 'sellers')} AS top_seller_ratio,
  coalesce(femalesellersratio > 0.5, false) AS high_female_seller_ratio,
  {_ratio('toptotalproductssold', 'toptotalproductslisted + 1')} AS performance_indicator,
  CASE WHEN meanofflinedays < 30 THEN 'Highly Active' WHEN meanofflinedays < 60 THEN 'Moderately Active'
       ELSE 'Low Activity' END AS activity_level,
  coalesce({_ratio('toptotalproductssold', 'toptotalproductslisted + 1')} > 0.8, false) AS high_performance
FROM (SELECT {_INITCAP} AS country, {_typed(COUNTRY_INT_COLS, COUNTRY_DEC_COLS, False)} FROM v_countries) t
"""

_SILVER_CTES = {"users_s": SQL_USERS_SILVER, "countries_s": SQL_COUNTRIES_SILVER,
                "buyers_s": SQL_BUYERS_SILVER, "sellers_typed": SQL_SELLERS_TYPED,
                "sellers_s": SQL_SELLERS_SILVER}


def _sel(alias: str, mapping: dict) -> str:
    return ", ".join(f"{alias}.{k} AS {v}" for k, v in mapping.items())


SQL_GOLD = with_views(f"""
SELECT u.country AS Country,
  coalesce(u.country, c.country, b.country, s.country) AS country_key,
  {_sel('u', GOLD_USERS)}, {_sel('c', GOLD_COUNTRIES)}, {_sel('b', GOLD_BUYERS)}, {_sel('s', GOLD_SELLERS)}
FROM users_s u
FULL OUTER JOIN {_with_strangers('countries_s', 'countries')} c ON u.country = c.country
FULL OUTER JOIN {_with_strangers('buyers_s', 'buyers')} b ON coalesce(u.country, c.country) = b.country
FULL OUTER JOIN {_with_strangers('sellers_s', 'sellers')} s ON coalesce(u.country, c.country, b.country) = s.country
""", "v_users", "v_countries", "v_buyers", "v_sellers", extra=_SILVER_CTES)


@query("users_silver", with_views(SQL_USERS_SILVER, "v_users"), USER_DEC_COLS)
def q_users_silver(spark, sf):
    return users_silver(view(spark, sf, "v_users"))


@query("buyers_silver", with_views(SQL_BUYERS_SILVER, "v_buyers"), BUYER_DEC_COLS)
def q_buyers_silver(spark, sf):
    return buyers_silver(view(spark, sf, "v_buyers"))


@query("sellers_silver", with_views("SELECT * FROM sellers_s", "v_sellers",
                                    extra={"sellers_typed": SQL_SELLERS_TYPED, "sellers_s": SQL_SELLERS_SILVER}),
       SELLER_DEC_COLS)
def q_sellers_silver(spark, sf):
    return sellers_silver(view(spark, sf, "v_sellers"))


@query("countries_silver", with_views(SQL_COUNTRIES_SILVER, "v_countries"), COUNTRY_DEC_COLS)
def q_countries_silver(spark, sf):
    return countries_silver(view(spark, sf, "v_countries"))


@query("cast_by_spec", with_views(
    f"SELECT country, {_typed(COUNTRY_INT_COLS, COUNTRY_DEC_COLS, False)} FROM v_countries", "v_countries"),
    COUNTRY_DEC_COLS)
def q_cast_by_spec(spark, sf):
    return cast_by_spec(view(spark, sf, "v_countries"), {"int": COUNTRY_INT_COLS, DEC: COUNTRY_DEC_COLS})


@query("impute_mean", with_views(
    "SELECT country, sex, meansellerpassrate FROM sellers_s", "v_sellers",
    extra={"sellers_typed": SQL_SELLERS_TYPED, "sellers_s": SQL_SELLERS_SILVER}), ["meansellerpassrate"])
def q_impute_mean(spark, sf):
    typed = cast_by_spec(view(spark, sf, "v_sellers"), {DEC: ["meansellerpassrate"]})
    typed = typed.withColumns({"country": F.initcap("country"), "sex": F.upper("sex")})
    return impute_mean(typed, ["meansellerpassrate"]).select("country", "sex", "meansellerpassrate")


@query("gold_user_obt", SQL_GOLD, ["Sellers_MeanProductsSold", "Sellers_MeanProductsListed"])
def q_gold_user_obt(spark, sf):
    return gold_user_obt(*silver_tables(spark, sf))
