"""One-big-table joins: a full-outer chain on one key, and a metadata-driven left-join chain.

Full-outer chain ``base ⟗ d1 ⟗ d2 … USING (key)``.  The dimension-grain inputs
(one or a few rows per key) are joined among themselves first; because a chain
of full outer equi-joins on one key is associative, the result equals

    L = base ⟕ dim                     (every base row, matched or not)
    R = dim ▷ distinct(base.key)       (dim rows no base row matches, NULL keys too)
    L ∪ R

Adaptive execution broadcasts ``dim`` if it measures it small enough, so that the big
``base`` side is not shuffled; otherwise the left join is a shuffle join, in which
it can split a hot key of ``base`` (a plain full outer join cannot be split).
``distinct(base.key)`` is a partial aggregate before its shuffle, so a key holding a
third of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_chain(base: DataFrame, dims: Sequence[DataFrame], key: str, force: str | None = None) -> DataFrame:
    """``base ⟗ dims[0] ⟗ dims[1] … USING (key)`` with the output ``key`` coalesced.

    Column names other than ``key`` must be unique across inputs (project and
    alias before calling; that also prunes the scans).  Each base row meets every
    dimension row of its key, as in the literal chain; bring the dimensions to key
    grain first where that is not wanted.  Join strategies are left to adaptive
    execution, which measures the sides at run time.  ``force`` = "plain" runs the
    literal chain (for comparison tests).
    """
    if force == "plain":
        out = base
        for d in dims:
            out = out.join(d, on=key, how="full_outer")
        return out
    dim = dims[0]
    for d in dims[1:]:
        dim = dim.join(d, on=key, how="full_outer")
    left = base.join(dim, on=key, how="left")
    base_keys = base.select(key).where(F.col(key).isNotNull()).distinct()
    right = dim.join(base_keys, on=key, how="left_anti")
    own = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in base.columns if c != key]
    return left.unionByName(right.select("*", *own))


@dataclass(frozen=True)
class JoinSpec:
    """One entry of a metadata-driven chain: a table, its alias, the columns to keep, the condition."""

    df: DataFrame
    alias: str
    columns: Sequence[str]          # "*" or column names of this table
    condition: str | None = None    # SQL text over earlier aliases; None for the base


def metadata_chain(specs: Sequence[JoinSpec], how: str = "left") -> DataFrame:
    """``SELECT <columns> FROM base LEFT JOIN t2 ON c2 LEFT JOIN t3 ON c3 …`` from a config list.

    Join order is the given order (conditions may refer to any earlier alias).
    The physical strategy is left to adaptive execution, which broadcasts a side
    only after measuring it at runtime.
    """
    first = specs[0]
    out = first.df.alias(first.alias)
    for s in specs[1:]:
        out = out.join(s.df.alias(s.alias), F.expr(s.condition), how)
    cols = []
    for s in specs:
        if list(s.columns) == ["*"]:
            cols.append(F.col(f"{s.alias}.*"))
        else:
            cols.extend(F.col(f"{s.alias}.{c}").alias(c) for c in s.columns)
    return out.select(*cols)
