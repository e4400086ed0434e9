"""Deterministic keep-one per key.

``keep_one`` picks, per key, the first (or last) row under a total order:
the given order columns, then every other column.  It is written as a
``min``/``max`` of a struct, so Spark aggregates partially on each task before
the shuffle: a key that holds a third of the input reaches the reducer as one
row per task, never as one huge group.  The result is the same whatever the
input order or partitioning (unlike ``dropDuplicates``, which keeps an
arbitrary row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PICK = "_pick"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first") -> DataFrame:
    """One row per ``keys``: smallest (``first``) or largest (``last``) by ``order`` then all columns."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = list(order) + [c for c in rest if c not in order]
    # struct fields: the order columns first (they decide), then the rest as tie-break
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(ranked)]
    pick = F.struct(*fields)
    agg = F.min(pick) if keep == "first" else F.max(pick)
    out = df.groupBy(*keys).agg(agg.alias(_PICK))
    return out.select(*keys, *[F.col(f"{_PICK}._o{ranked.index(c)}").alias(c) for c in rest]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_one(df, keys, order, keep="last")


def keep_one_traced(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), document: Sequence[str] = (),
                    place: Sequence[str] = (), out: str = "documents") -> DataFrame:
    """``keep_one`` (first) whose row keeps its provenance, with the number of documents that had the key.

    ``document`` names the columns that tell one source document from another, ``place`` those that say where in it
    (and in which file) a row was.  They never decide between rows that differ otherwise: the order is ``order``,
    the data columns, then document and place, so of equal rows the first document's counts.  Rows are combined
    for each key and document before the documents are counted, both times on the tasks first: a key
    that is in every document reaches the last step as one row for each task.  A NULL document counts as one.
    """
    keys, origin = list(keys), [*document, *place]
    data = [c for c in df.columns if c not in keys and c not in origin]
    ranked = [*order, *[c for c in data if c not in order], *origin]
    pick = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(ranked)])
    by_key, by_doc = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], [F.col(c).alias(f"_d{i}") for i, c in enumerate(document)]
    once = df.groupBy(*by_key, *by_doc).agg(F.min(pick).alias(_PICK))
    kept = once.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min(_PICK).alias(_PICK), F.count(F.lit(1)).alias(out))
    return kept.select(*[(F.col(f"_k{keys.index(c)}") if c in keys else F.col(f"{_PICK}._o{ranked.index(c)}")).alias(c)
                         for c in df.columns], out)
