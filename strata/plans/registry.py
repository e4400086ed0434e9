"""Query registry: key -> Spark job over the driver tables, plus its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def decimals_as_double(df: DataFrame) -> DataFrame:
    """Present decimal result columns as double (exact for decimal(10,2) values), so a
    result compares equal however a checker converts numbers."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DecimalType

    dec = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in dec}) if dec else df


def oracle_as_double(sql: str, cols) -> str:
    """The same presentation on the oracle side: named decimal columns cast to DOUBLE."""
    if not cols:
        return sql
    replaced = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({replaced}) FROM (\n{sql}\n) _r"


def query(name: str, oracle: str | None = None, decimal_cols=()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    Results are presented with decimal columns as double; ``decimal_cols`` names
    the oracle's decimal columns to present the same way.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_as_double(fn(spark, sf_dir))

        run.__name__, run.__doc__, run.__wrapped__ = fn.__name__, fn.__doc__, fn
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle_as_double(oracle, list(decimal_cols))
        return fn

    return deco
