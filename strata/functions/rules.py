"""Reusable column rules: bulk casts, buckets, value maps, ratios, flags.

Every rule returns a built-in ``Column`` expression (or applies a set of them
with one ``withColumns``), so the whole silver layer collapses into a single
codegen'd projection.  Failing conversions become NULL (``try_cast``,
``try_divide``) instead of aborting the job under ANSI mode; the audit counts them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- casts

def cast_by_spec(df: DataFrame, spec: Mapping[str, Sequence[str]], lenient: bool = False) -> DataFrame:
    """Cast named columns to one type per group: ``{"int": [...], "decimal(10,2)": [...]}``.

    Strict (default): text that is not a literal of the type becomes NULL
    (``'2.0'`` is not an int).  ``lenient=True`` reads integers through a wide
    decimal first, so ``'12.0'`` becomes 12 (truncating, as Spark does for
    fractional values).
    """
    exprs = {}
    for type_name, cols in spec.items():
        for c in cols:
            if lenient and type_name.lower() in ("int", "integer", "bigint", "long", "smallint"):
                exprs[c] = F.col(c).try_cast("decimal(38,10)").try_cast(type_name)
            else:
                exprs[c] = F.col(c).try_cast(type_name)
    return df.withColumns(exprs)


def int_or_zero(c: ColumnOrName) -> Column:
    """NULL input -> 0; otherwise the integer cast (a value that fails to cast stays NULL)."""
    c = _c(c)
    return F.when(c.isNotNull(), c.try_cast("int")).otherwise(F.lit(0))


def fill_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.fillna({c: 0 for c in cols})


# ---------------------------------------------------------------- labels

def bucketize(c: ColumnOrName, bounds: Sequence[tuple[float, str]], otherwise: str,
              descending: bool = False, null_label: str | None = None) -> Column:
    """Ordered thresholds to labels.

    Ascending: first ``(b, label)`` with ``c < b`` wins.  Descending: first with
    ``c >= b`` wins.  NULL falls through to ``otherwise`` unless ``null_label``.
    """
    c = _c(c)
    expr = None
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for bound, label in bounds:
        cond = (c >= F.lit(bound)) if descending else (c < F.lit(bound))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


def value_map(c: ColumnOrName, mapping: Mapping[str, str], otherwise: str) -> Column:
    """Exact-value map; unmapped values and NULL -> ``otherwise``."""
    c = _c(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(otherwise))


def prefix_map(c: ColumnOrName, mapping: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """First matching prefix wins; NULL -> ``otherwise``."""
    c = _c(c)
    expr = None
    for prefix, label in mapping:
        cond = c.startswith(prefix)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def flag(cond: Column) -> Column:
    """Boolean rule where an unknown (NULL) comparison counts as False."""
    return F.coalesce(cond, F.lit(False))


def descriptor(*parts: ColumnOrName, sep: str = "_") -> Column:
    """``a_b_c``; any NULL part makes the whole value NULL (``concat`` semantics)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(p))
    return F.concat(*cols)


# ---------------------------------------------------------------- arithmetic

def round_half_up(x: Column, scale: int = 2) -> Column:
    """Round a double through decimal(38,8) so the result is engine-independent; returns double.

    Thirty digits before the point hold every sum or ratio of the declared inputs.
    """
    return F.round(x.try_cast("decimal(38,8)"), scale).cast("double")


def ratio(a: ColumnOrName, b: ColumnOrName, scale: int | None = 2) -> Column:
    """``a / b`` as double, NULL when ``b`` is 0; rounded half-up to ``scale`` unless None."""
    q = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return q if scale is None else round_half_up(q, scale)


def smoothed_ratio(a: ColumnOrName, b: ColumnOrName, scale: int = 2) -> Column:
    """``round(a / (b + 1), scale)``: never divides by zero for non-negative counts."""
    return ratio(a, _c(b) + F.lit(1), scale)


def money(c: ColumnOrName, precision: int = 38, scale: int = 6) -> Column:
    """Text or number to decimal; NaN, infinity and junk -> NULL.

    32 digits before the point and 6 after it: amounts keep the digits they came with,
    so a product is rounded once.
    """
    return _c(c).try_cast(f"decimal({precision},{scale})")


def strict_int(c: ColumnOrName) -> Column:
    """Integer literal text only (``'2.0'`` -> NULL, like Python ``int()``)."""
    return _c(c).try_cast("int")


def round_product(a: ColumnOrName, b: ColumnOrName, scale: int = 2) -> Column:
    """``round(a * b, scale)`` in decimal arithmetic (the ``multiply`` macro)."""
    return F.round(_c(a) * _c(b), scale)
