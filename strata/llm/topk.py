"""Exact top-k inner products by columnar branch and bound.

Queries and candidates are dealt into blocks of bounded size; every pair of a query
block and a candidate block is one task's tile.  Inside a tile the vectors lie dimension
block by dimension block.  Scores grow one dimension block at a time; after each, the
mass of the dimensions to come (the product of both remainders' norms) bounds every
candidate's final score from above and below, and candidates whose upper bound is under
the k-th best lower bound are dropped from the columns.  The tiles' winners are then
ranked once more per query.

Components become floor(1024 x) and scores are exact integers: sums that could leave the
range where doubles are exact are computed with Python integers, and a score outside
the range of a long is set to that range's end.

Defined cases: vectors that are null, empty, or hold null or non-finite components take
no part; vectors of different length do not meet; a query's own row is every row with
its id; repeated candidate rows count each, a repeated query row (same id and vector) is
answered once; ties go to the smaller id, a null id takes part as a candidate only and
comes last; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192
DIMS = 16
EXACT = float(1 << 53)
NULL_ID = np.iinfo(np.int64).max


def _matrix(column, ids) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Scaled vectors by length: ids and a matrix of whole numbers held as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    out = {}
    for d in np.unique(n):
        rows = np.flatnonzero(n == d)
        out[int(d)] = (ids[rows], flat[at[rows][:, None] + np.arange(d)])
    return out


def _big(cand: np.ndarray, query: np.ndarray) -> np.ndarray:
    lo, hi = -(1 << 63), (1 << 63) - 1
    return np.array([min(hi, max(lo, sum(int(a) * int(b) for a, b in zip(c, query)))) for c in cand], dtype=np.int64)


def best(cand_ids: np.ndarray, cand: np.ndarray, query_ids: np.ndarray, query: np.ndarray, k: int):
    """For each query the positions and exact scores of its k best candidates (ties to the smaller id)."""
    n, d = cand.shape
    order = np.argsort(cand_ids, kind="stable")
    cand_ids, cand = cand_ids[order], cand[order]
    blocks = [slice(i, min(i + DIMS, d)) for i in range(0, d, DIMS)]
    columns = [np.ascontiguousarray(cand[:, b]) for b in blocks]
    peak = max(np.abs(cand).max(initial=0), np.abs(query).max(initial=0))
    exact = peak * peak * d < EXACT

    def rests(x):  # norms of the dimensions after each block, a little too large on purpose
        s = np.stack([np.square(x[:, b]).sum(axis=1) for b in blocks], axis=0)
        return np.sqrt(np.cumsum(s[::-1], axis=0)[::-1] - s) * (1 + 1e-9) + 1e-6

    rest_c, rest_q = (rests(cand), rests(query)) if exact else (None, None)
    for j in range(len(query_ids)):
        q = query[j]
        own = np.searchsorted(cand_ids, query_ids[j]), np.searchsorted(cand_ids, query_ids[j], side="right")
        live = np.concatenate([np.arange(own[0]), np.arange(own[1], n)])
        if not exact:
            score = _big(cand[live], q)
        else:
            total = np.zeros(len(live))
            for i, b in enumerate(blocks):
                total += (columns[i] if len(live) == n else columns[i][live]) @ q[b]
                if len(live) > k and i + 1 < len(blocks):
                    slack = rest_c[i][live] * rest_q[i][j]
                    low = total - slack
                    keep = total + slack >= np.partition(low, len(low) - k)[len(low) - k]
                    live, total = live[keep], total[keep]
            score = total.astype(np.int64)
        top = np.lexsort((cand_ids[live], -score if exact else np.array([-int(s) for s in score], dtype=object)))[:k] \
            if len(live) else np.zeros(0, np.int64)
        yield cand_ids[live][top], score[top]


def _tile(k: int):
    kind = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        role = table.column("role").to_numpy()
        ids = pa.compute.fill_null(table.column("vec_id"), NULL_ID).to_numpy()
        rows = table.column("rid").to_numpy()
        out = [[], [], [], []]
        sides = [table.filter(pa.array(role == r)) for r in (0, 1)]
        cands = _matrix(sides[0].column("vec"), ids[role == 0])
        # a query carries its row number, so that it can be told from another with its id
        asked = _matrix(sides[1].column("vec"), np.flatnonzero(role == 1))
        for d, (at, q) in asked.items():
            if d not in cands:
                continue
            for i, (who, score) in zip(at, best(*cands[d], ids[at], q, k)):
                out[0].append(np.full(len(who), ids[i])), out[1].append(np.full(len(who), rows[i]))
                out[2].append(who), out[3].append(score)
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.Table.from_arrays([pa.array(c, pa.int64(), mask=(c == NULL_ID) if i == 2 else None)
                                     for i, c in enumerate(cols)], schema=kind)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, query_row, rank, vec_id, score``: each query's ``k`` best among all rows but its own."""
    def usable(df):
        v = F.col(vec_col).cast("array<double>")
        whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        return df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & whole) \
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vec"))

    cand = usable(vectors).withColumn("rid", F.monotonically_increasing_id())
    asked = usable(queries).where("vec_id IS NOT NULL").dropDuplicates(["vec_id", "vec"]) \
        .withColumn("rid", F.xxhash64("vec"))
    nc = vectors.select(F.count("*")).first()[0]
    nq = queries.select(F.count("*")).first()[0]
    cb, qb = max(1, -(-nc // CANDIDATE_BLOCK)), max(1, -(-nq // QUERY_BLOCK))

    def dealt(df, own, n_own, other, n_other, role):
        return df.select(F.lit(role).alias("role"), "vec_id", "rid", "vec",
                         F.pmod(F.xxhash64("vec_id", "rid"), F.lit(n_own)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))

    tiles = dealt(cand, "c", cb, "q", qb, 0).unionByName(dealt(asked, "q", qb, "c", cb, 1))
    found = tiles.groupBy("q", "c").applyInArrow(_tile(k), "query_id long, query_row long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "query_row", "rank", "vec_id", "score")
