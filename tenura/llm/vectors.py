"""Vectors in Arrow batches: valid rows, and arrays of equal length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_whole(vector: Column) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of doubles) for each vector length of a list column without nulls."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), np.float64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, flat[starts[rows][:, None] + np.arange(length)]
