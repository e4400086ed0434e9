"""Nested documents: explode arrays along dotted paths; JSON fields with defaults.

``json_field`` keeps the difference between a *missing* key (the default
applies) and an explicit JSON ``null`` (stays NULL), which ``from_json`` with a
schema cannot tell apart; it reads through ``variant`` instead.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_path(df: DataFrame, path: str, alias: str, keep: tuple[str, ...] = (), place: str | None = None) -> DataFrame:
    """One row per element of the array at ``path`` (rows with empty/NULL arrays drop out); ``place`` names
    a column for its index, from 0."""
    if place:
        return df.select(*keep, F.posexplode(F.col(path)).alias(place, alias))
    return df.select(*keep, F.explode(F.col(path)).alias(alias))


def first_elem_field(array_col: str, field: str) -> Column:
    """``arr[0].field`` that is NULL (not an error) for an empty array."""
    return F.get(F.col(array_col), 0)[field]


def project(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """``{output name: dotted path}`` projection."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def json_field(variant: Column, path: str, default: str | None, dtype: str = "string") -> Column:
    """Value at ``path``; ``default`` when the path is missing (or crosses a null/absent
    object); NULL when the value is an explicit JSON null."""
    raw = F.try_variant_get(variant, path, "variant")
    value = F.try_variant_get(variant, path, dtype)
    if default is None:
        return value
    return F.when(raw.isNull(), F.lit(default).cast(dtype)).otherwise(value)


def is_json_null(variant: Column, path: str) -> Column:
    """True when ``path`` exists and holds an explicit JSON null."""
    raw = F.try_variant_get(variant, path, "variant")
    return F.coalesce(raw.isNotNull() & F.is_variant_null(raw), F.lit(False))
