"""Embedding whitening by exact, bit-sliced cross-products.

Every entry c becomes the integer x = floor(64 c) + 1000000.  A task takes blocks of rows,
shifts every dimension by its least value in the block, and packs each bit plane of the
shifted values across the rows into 64-bit words.  The cross-product of two dimensions
is the sum over pairs of planes p, q of 2^(p+q) times the population count of the AND of
their words, an exact integer; the shift is taken out again in integers.  Sums of tasks meet
by pair of dimensions (high and low parts as decimals, so no size overflows), and
n C - S S^T, which is n^2 times the covariance, is formed in integers before it becomes
floating point for ``eigh``.  Only this matrix, as large as the square of the dimension, comes to the driver.

Projection: deviations n x - S are integers, divided by n only when they are projected.
The covariance of the projections is summed from the written rows.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped;
of vectors of several lengths the most common length stays (of equal ones the longer);
values beyond 2^53 in size count as 2^53; a component without variance (constant
or dependent dimensions, or too few rows) has null ``whitened`` and counts in no
identity error; a deviation above a long's range is null; null ids, repeated rows and
ties are rows like any others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged, tidied, worker_tables

SCALE, SHIFT = 64, 1_000_000
#: entries of a block that a task packs at a time, and words that it compares at a time
BLOCK_ENTRIES, WORDS = 1 << 20, 1 << 19
_LIMIT = float(1 << 53)
_PART = 1 << 60


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v`` of rows whose vector has only finite entries."""
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("v").isNotNull() & finite)


def integers(column: pa.Array, dim: int) -> np.ndarray:
    """floor(64 c) of a list column, one row each (the constant of x is left to its shift)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(flat * SCALE), -_LIMIT, _LIMIT).astype(np.int64)


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (powers of two) and packed bit planes of non-negative integers: plane, dimension, word."""
    rows, dim = y.shape
    words = -(-rows // 64)
    bits = [p for p in range(int(y.max()).bit_length() if y.size else 0)]
    out = np.zeros((len(bits), dim, words * 8), dtype=np.uint8)
    for k, p in enumerate(bits):
        packed = np.packbits((y >> p & 1).astype(np.uint8).T, axis=1, bitorder="little")
        out[k, :, :packed.shape[1]] = packed
    return np.array(bits, dtype=np.int64), out.view(np.uint64)


def scatter(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of non-negative integers, by AND and population count of their planes."""
    rows, dim = y.shape
    exponent, word = planes(y)
    # a plane pair's counts are at most ``rows``; beyond 62 bits in total plain integers of any size are used
    small = not len(exponent) or 2 * int(exponent[-1]) + 2 + rows.bit_length() < 62
    kind = np.int64 if small else object
    total, cross = np.zeros(dim, dtype=kind), np.zeros((dim, dim), dtype=kind)
    step = max(1, WORDS // max(1, dim * word.shape[2]))
    for a, p in enumerate(exponent.tolist()):
        total += np.bitwise_count(word[a]).sum(axis=1, dtype=np.int64).astype(kind) * (1 << p)
        for b, q in enumerate(exponent[:a + 1].tolist()):
            count = np.empty((dim, dim), dtype=np.int64)
            for i in range(0, dim, step):
                both = word[a][i:i + step, None, :] & word[b][None, :, :]
                count[i:i + step] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
            count = count.astype(kind) * (1 << (p + q))
            cross += count if a == b else count + count.T
    return total, cross


def _blocks(column: pa.Array, dim: int):
    """Integer rows of a batch in blocks."""
    step = max(64, BLOCK_ENTRIES // dim)
    for k in range(0, len(column), step):
        yield integers(column.slice(k, step), dim)


def _moments(dim: int):
    """Per task: number of rows (-1, -1), sums (i, -1) and cross-products (i, j <= i) of floor(64 c)."""
    def run(batches):
        worker_tables("whitening")
        n, total, cross = 0, np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)
        for b in batches:
            for z in _blocks(b.column("v"), dim):
                if not len(z):
                    continue
                low = z.min(axis=0)
                s, c = scatter(z - low)
                s, c, low = s.astype(object), c.astype(object), low.astype(object)
                n += len(z)
                total += s + low * len(z)
                cross += c + np.outer(low, s) + np.outer(s, low) + np.outer(low, low) * len(z)
        if not n:
            return
        i, j = np.tril_indices(dim)
        rows = [(-1, -1, n)] + [(k, -1, int(x)) for k, x in enumerate(total)] \
            + [(int(p), int(q), int(cross[p, q])) for p, q in zip(i, j)]
        whole = pa.decimal128(38, 0)
        for k in range(0, len(rows), 50_000):
            part = rows[k:k + 50_000]
            yield pa.record_batch([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.int32()),
                                   pa.array([decimal.Decimal(r[2] // _PART) for r in part], whole),
                                   pa.array([decimal.Decimal(r[2] % _PART) for r in part], whole)],
                                  names=["i", "j", "hi", "lo"])
    return run


def _projected(n: int, total, axes: np.ndarray):
    """Deviations and projections of every row."""
    dim = len(total)
    top = max(map(abs, total))

    def run(batches):
        worker_tables("whitening")
        for b in batches:
            deviation, white = [], []
            for z in _blocks(b.column("v"), dim):
                most = n * int(np.abs(z).max(initial=0)) + top
                if most * most * dim < 1 << 62:
                    d = n * z - total.astype(np.int64)
                    deviation += (d * d).sum(axis=1).tolist()
                else:
                    d = n * z.astype(object) - total
                    deviation += [int(x) for x in (d * d).sum(axis=1)]
                white.append((d / n).astype(np.float64) @ axes)
            white = np.concatenate(white) if white else np.zeros((0, axes.shape[1]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * axes.shape[1], pa.int32()), pa.array(white.reshape(-1)))
            yield pa.record_batch([b.column("vec_id"), pa.array([x if x < 1 << 63 else None for x in deviation], pa.int64()), lists],
                                  names=["vec_id", "deviation", "white"])
    return run


def _products(width: int):
    """Per task: sums (i, -1) and cross-products (i, j <= i) of the projections."""
    def run(batches):
        total, cross, any_row = np.zeros(width), np.zeros((width, width)), False
        for b in batches:
            w = b.column("white").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            total, cross, any_row = total + w.sum(axis=0), cross + w.T @ w, True
        if any_row:
            i, j = np.tril_indices(width)
            yield pa.record_batch([pa.array(np.concatenate([np.arange(width), i]), pa.int32()),
                                   pa.array(np.concatenate([np.full(width, -1), j]), pa.int32()),
                                   pa.array(np.concatenate([total, cross[i, j]]))], names=["i", "j", "x"])
    return run


def _symmetric(dim: int, kind, entries) -> np.ndarray:
    out = np.zeros((dim, dim), dtype=kind)
    for i, j, x in entries:
        out[i, j] = out[j, i] = x
    return out


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    size = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if size is None or not size["dim"]:
        return spark.createDataFrame([], f"vec_id {kind}, {OUT}")
    dim = size["dim"]
    rows = rows.where(F.size("v") == dim)
    sums = rows.select("v").mapInArrow(tidied(_moments(dim)), "i int, j int, hi decimal(38,0), lo decimal(38,0)") \
        .groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()  # (dim + 1) (dim + 2) / 2 rows
    exact = [(r["i"], r["j"], int(r["hi"]) * _PART + int(r["lo"])) for r in sums]
    n = next(x for i, _, x in exact if i < 0)
    total = np.array([x for _, x in sorted((i, x) for i, j, x in exact if i >= 0 > j)], dtype=object)
    cross = _symmetric(dim, object, [e for e in exact if e[1] >= 0])
    centred = n * cross - np.outer(total, total)
    covariance = np.array([[x / (n * n) for x in row] for row in centred], dtype=np.float64)
    value, vector = np.linalg.eigh(covariance)
    width = min(components, dim)
    value, vector = value[::-1][:width], vector[:, ::-1][:, :width]
    vector = vector * np.where(vector[np.abs(vector).argmax(axis=0), np.arange(width)] < 0, -1.0, 1.0)
    trace = sum(int(centred[k, k]) for k in range(dim)) / (n * n)
    real = value > dim * np.finfo(float).eps * max(trace, 0.0)
    axes = vector / np.sqrt(np.where(real, value, 1.0))

    written = staged(rows.mapInArrow(tidied(_projected(n, total, axes)), f"vec_id {kind}, deviation long, white array<double>"), "white")
    sums = written.select("white").mapInArrow(tidied(_products(width)), "i int, j int, x double") \
        .groupBy("i", "j").agg(F.sum("x").alias("x")).collect()  # (width + 1) (width + 2) / 2 rows
    mean = np.array([x for _, x in sorted((r["i"], r["x"]) for r in sums if r["j"] < 0)]) / n
    error = _symmetric(width, float, [(r["i"], r["j"], r["x"] / n) for r in sums if r["j"] >= 0]) - np.outer(mean, mean) - np.eye(width)
    error = float(np.abs(error[np.ix_(real, real)]).max()) if real.any() else 0.0
    about = F.array(*[F.struct(F.lit(bool(r)).alias("real"), F.lit(float(max(e, 0.0) / trace) if trace else 0.0).alias("explained"))
                      for r, e in zip(real, value)])
    return written.select("vec_id", "deviation", F.posexplode(F.arrays_zip("white", about.alias("about"))).alias("at", "x")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.col("x.about.real"), F.col("x.white")).alias("whitened"), F.col("x.about.explained").alias("explained"),
        F.lit(error).alias("identity_error"))
