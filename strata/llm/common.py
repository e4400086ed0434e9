"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.session import scratch_path


def staged(df: DataFrame, name: str, compression: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage with a table that every executor can read, so a lost executor
    costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options or {}).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (case is ignored, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in taken:
        k += 1
        name = f"{base}_{k}"
    return name


_kept: dict[str, dict] = {}


def worker_tables(owner: str) -> dict:
    """What a Python worker keeps between its tasks for one operator.

    Workers are used again by later jobs, so an operator that starts gives up what
    another one has kept.
    """
    for other in [k for k in _kept if k != owner]:
        del _kept[other]
    return _kept.setdefault(owner, {})


def give_back() -> None:
    """Return freed memory to the system: workers stay for later jobs and share a machine's memory."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidied(run):
    """A task function over record batches that gives its memory back when it is done."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def few_rows(batches, rows: int = 1000):
    """Record batches of at most ``rows`` rows, to bound what a task holds at a time."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def byte_views(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary Arrow column as one byte buffer and row offsets (nulls have length 0)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64) if n \
        else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]
