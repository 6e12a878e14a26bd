"""Embedding columns inside tasks: list rows as one zero-padded matrix of doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import slim

# Rows of a matrix built at once in a task.
MATRIX_ROWS = 4096


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: number(x.cast("double")))


def usable(rows: DataFrame, vector: str, *others: str) -> tuple[DataFrame, int]:
    """Rows whose vector and other columns have values, and the longest vector's length
    (shorter ones count as padded with zeros)."""
    kept = slim(rows, *others, vector)
    for c in others:
        kept = kept.where(F.col(c).isNotNull())
    kept = kept.where(finite(F.col(vector)))
    return kept, kept.agg(F.max(F.size(vector))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row per list; lists shorter than ``width`` end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    at = np.repeat(np.arange(len(column)), lengths)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def unpacked(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """Rows that a task wrote as bytes of ``width`` numbers each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())
