"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def finite(embedding: str) -> Column:
    """True for a vector that is not null and holds neither nulls nor non-finite components."""
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrices(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of an Arrow list column: for each vector length, the rows that have it and their matrix."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, start = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes) - sizes
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, flat[start[rows][:, None] + np.arange(d)]))
    return out
