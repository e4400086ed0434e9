"""Mixing sources to target weights by hierarchical budgeting (DataFrame functions only).

The leaves of a tree (domain, language, source) hold the documents.  A token budget
enters at the root and is divided level by level among the children in proportion to
their weights.  A child never gets more than its leaves can give (their tokens times
``max_epochs``); what it cannot take is divided among its siblings, again by weight,
and only what all of them together cannot take reaches the level above.  Since a
node's capacity is the sum of its leaves', one pass from the root does this exactly:
children in order of capacity by weight are full until the rest can share evenly.
All amounts are integers; a share is rounded down.

A leaf that gets T tokens of A takes ``T div A`` whole epochs and, of the next one, the
longest prefix of documents that fits in ``T mod A`` tokens.  An epoch's order is
that of md5(seed:epoch:id).  The prefix is found without sorting a leaf: sums by
the first ``PREFIX`` hex digits of the md5 say which ranges are wholly in or out, and only
the one range per leaf where the budget ends is put in order.

Defined cases: null level values count as empty strings, null texts have no tokens;
documents without tokens belong to the prefix that ends with them, and an epoch of no tokens has no documents; a null id has the md5
of an empty one; rows with equal ids in one leaf are taken together or not at all; weights
below 0 count as 0, unnamed children weigh 1; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, staged

PREFIX = 4
WORD = r"[^ \t\n\r\f\x0B]+"


def word_tokens(text_col: str = "text") -> Column:
    """Number of words between white space."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def _levels(n: int) -> list[str]:
    return [f"l{i}" for i in range(n)]


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight of a node, looked up by its path from the root."""
    named = [(k, v) for k, v in weights.items() if len(k) == len(path)]
    w = F.lit(1)
    for key, value in named:
        hit = F.lit(True)
        for c, v in zip(path, key):
            if v != "*":
                hit = hit & (F.col(c) == F.lit(v))
        w = F.when(hit, F.lit(max(0, int(value)))).otherwise(w)
    return w.cast("decimal(18,0)")


def divide(children: DataFrame, parent: list[str]) -> DataFrame:
    """Give every child its part of ``budget`` (a column of its parent's amount), as column ``budget``.

    ``children`` has the parent's columns, ``budget``, ``weight`` and ``capacity``.
    """
    by = Window.partitionBy(*parent)
    order = by.orderBy(F.col("capacity") / F.col("weight"), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    full = (F.col("weight") > 0) & (F.col("capacity") * F.sum("weight").over(onward)
                                    <= (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))) * F.col("weight"))
    got = children.where("weight > 0").withColumn("full", full)
    taken = F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0))
    left = F.sum(F.when(~F.col("full"), F.col("weight"))).over(by)
    got = got.withColumn("taken", taken).withColumn("left", left)
    share = F.expr("CAST(((budget - taken) * weight) div left AS DECIMAL(20,0))")
    return got.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(share)) \
        .drop("full", "taken", "left")


def budgets(leaves: DataFrame, n_levels: int, total: int, weights: Mapping[tuple[str, ...], int],
            max_epochs: int) -> DataFrame:
    """Tokens for every leaf: the leaf's columns and ``budget``.  ``leaves`` has l0.. and ``tokens``."""
    cols = _levels(n_levels)
    nodes = None
    for depth in range(1, n_levels + 1):
        path = cols[:depth]
        level = leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast("decimal(20,0)").alias("capacity")) \
            .withColumn("weight", _weight(path, weights)).withColumn("node", F.col(path[-1]))
        if nodes is None:
            level = level.withColumn("budget", F.lit(total).cast("decimal(20,0)")).withColumn("root", F.lit(0))
            nodes = divide(level, ["root"]).select(*path, "budget")
        else:
            nodes = divide(level.join(nodes, path[:-1]), path[:-1]).select(*path, "budget")
    return nodes


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int], *,
        fraction: tuple[int, int] = (1, 2), max_epochs: int = 2, seed: int = 0,
        tokens: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per selected document and epoch: ``doc_id, rid, epoch, <levels>, n_tokens``.

    The budget is ``fraction`` (numerator, denominator) of all tokens. ``weights`` maps a
    path of level values ("*" matches any) to an integer weight.
    """
    cols = _levels(len(levels))
    rows = staged(docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
        *[F.coalesce(e.cast("string"), F.lit("")).alias(c) for c, e in zip(cols, levels.values())],
        (word_tokens() if tokens is None else tokens).cast("long").alias("n_tokens")), "mix-rows")
    leaves = staged(rows.groupBy(*cols).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = int(leaves.agg(F.sum("tokens")).first()[0] or 0) * fraction[0] // fraction[1]
    plan = budgets(leaves, len(cols), total, weights, max_epochs).join(leaves, cols) \
        .select(*cols, F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("whole"),
                F.when(F.col("tokens") > 0, F.col("budget").cast("long") % F.col("tokens")).otherwise(0).alias("rest"))
    plan = staged(plan, "mix-plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                              F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    placed = rows.join(plan, cols).withColumn("order", order).withColumn("range", F.substring("order", 1, PREFIX))
    running = Window.partitionBy(*cols).orderBy("range")
    ranges = placed.groupBy(*cols, "range", "rest").agg(F.sum("n_tokens").alias("sum")) \
        .withColumn("upto", F.sum("sum").over(running)).withColumn("start", F.col("upto") - F.col("sum"))
    ranges = staged(ranges.where("rest > 0 AND start <= rest")
                    .select(*cols, "range", "start", (F.col("upto") <= F.col("rest")).alias("inside")), "mix-ranges")
    near = placed.join(ranges, [*cols, "range"])
    inside = near.where("inside").select(*rows.columns, F.col("whole").alias("epoch"))
    upto = F.col("start") + F.sum("n_tokens").over(Window.partitionBy(*cols, "range").orderBy("order"))
    border = near.where("NOT inside").withColumn("upto", upto).where("upto <= rest") \
        .select(*rows.columns, F.col("whole").alias("epoch"))
    whole = placed.where("whole > 0").select(*rows.columns, F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch"))
    return whole.unionByName(inside).unionByName(border).select(
        "doc_id", "rid", "epoch", *[F.col(c).alias(n) for c, n in zip(cols, levels)], "n_tokens")


def mixed(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple[str, ...], int], **options) -> DataFrame:
    """The selected rows of ``docs``, once per epoch; columns unchanged."""
    rid = fresh(docs, "_row")
    taken = mix(docs, levels, weights, **options).select(F.col("rid").alias(rid))
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(taken, rid).select(*docs.columns)
