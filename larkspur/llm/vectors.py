"""Vectors in packed blocks: one row holds the vectors of a block as bytes, so a task works on whole matrices.

Blocks are numbered, dealt to tasks by joins on their number and of bounded size; nothing here
gathers more than one block in a task's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20            # of doubles in one block
BATCH_ROWS = 4_096               # plain vectors in one Arrow batch
PACKED_BATCH_ROWS = 4            # packed rows in one Arrow batch


def batch_rows(spark: SparkSession, n: int) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def usable(col: str) -> Column:
    """Whether an array is there and every component is a finite number."""
    return F.coalesce(F.forall(col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                               & (F.abs(c.cast("double")) < F.lit(float("inf")))), F.lit(False))


def rows_per_block(dims: Column | int, most: int) -> Column:
    """Rows of a block: ``most``, or what fits ``BLOCK_BYTES``."""
    fits = F.floor(F.lit(BLOCK_BYTES) / (8 * F.greatest(F.lit(1), dims)))
    return F.greatest(F.lit(16), F.least(F.lit(most), fits)).cast("int")


def grouped(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[int, pa.Table]]:
    """(key, rows) of each run of equal keys in sorted batches."""
    held, key = [], None
    for batch in batches:
        keys = np.asarray(batch.column(column))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z == a:
                continue
            if held and keys[a] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = int(keys[a])
            held.append(batch.slice(a, z - a))
    if held:
        yield key, pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """The arrays of a list column, all of one length, as doubles."""
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.Array) else flat
    return np.asarray(flat).astype(np.float64).reshape(rows, -1)


def pack(rows: DataFrame, key: str, scalars: dict[str, str], order: list[str], more: str = "",
         measure: Callable[[dict[str, np.ndarray], np.ndarray], list[pa.Array]] | None = None) -> DataFrame:
    """One row per ``key``: n, dims, and each scalar column and the vectors ``x`` as the bytes of numpy arrays, in ``order``.

    ``measure`` gives further columns (schema ``more``), one value each, from the scalars and vectors of a block.
    """
    names, added = list(scalars), [c.split()[0] for c in more.split(", ") if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, t in grouped(batches):
            x = matrix(t["x"], t.num_rows)
            of = {c: np.asarray(t[c].combine_chunks()).astype(d) for c, d in scalars.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()), pa.array([t.num_rows], pa.int32()), pa.array([x.shape[1]], pa.int32()),
                 *(pa.array([of[c].tobytes()], pa.binary()) for c in names), pa.array([x.tobytes()], pa.binary()),
                 *(measure(of, x) if measure else [])],
                names=[key, "n", "dims", *names, "x", *added])
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batch_rows(rows.sparkSession, BATCH_ROWS)
    schema = [f"{key} long", "n int", "dims int", *(f"{c} binary" for c in names), "x binary", *([more] if more else [])]
    return (rows.select(key, *names, "x").repartition(parts, key).sortWithinPartitions(key, *order)
            .mapInArrow(run, ", ".join(schema)))


def unpacked(data: bytes, dtype: str = "f8", dims: int | None = None) -> np.ndarray:
    a = np.frombuffer(data, dtype)
    return a if dims is None else a.reshape(-1, dims)


def first_different(ids: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """The first k entries of ``order`` with different ids."""
    _, first = np.unique(ids[order], return_index=True)
    return order[np.sort(first)[:k]]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of different ids, ties to the smaller id."""
    return first_different(ids, np.lexsort((ids, -scores)), k)
