"""Vectors in Arrow batches, and sums of fixed-size arrays over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 64      # rows of sums that reach the driver at most


def finite_vector(column: Column) -> Column:
    """True where the vector is there and no component is null, NaN or infinite."""
    return F.coalesce(F.forall(column.cast("array<double>"),
                               lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``dim`` doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def packed_matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """Rows of a binary column that all hold ``width`` numbers of ``dtype``."""
    if not len(column):
        return np.empty((0, width), dtype)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), width)


def packed_rows(rows: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])


def summed(table: DataFrame, kernel: Callable[[pa.RecordBatch], np.ndarray], width: int, dtype=np.float64) -> np.ndarray:
    """Sum of ``kernel(batch)`` (``width`` numbers) over all batches of ``table``.

    Each partition adds up its batches, partitions are added up in ``SLOTS`` groups, and
    the driver adds those: what reaches it does not grow with the table.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype)
        for batch in batches:
            if batch.num_rows:
                total += kernel(batch)
        slot = TaskContext.get().partitionId() % SLOTS
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["slot", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = packed_matrix(rows["sums"].combine_chunks(), dtype, width).sum(axis=0, dtype=dtype)
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = table.mapInArrow(partial, "slot int, sums binary").groupBy("slot").applyInArrow(add, "sums binary").collect()
    return sum((np.frombuffer(r.sums, dtype) for r in parts), np.zeros(width, dtype))
