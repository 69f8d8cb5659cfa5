"""Rows of vectors as the operators on ``embeddings`` take them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fine(vector: Column) -> Column:
    """No component is null or not finite, and there is one at least."""
    v = vector.cast("array<double>")
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def common_length(vectors: DataFrame, column: str = "embedding") -> int:
    """The length that most vectors have, the shorter one of equals; 0 without any."""
    row = vectors.groupBy(F.size(column).alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return row["n"] if row else 0


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of vectors of one length, none of them null, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(n, -1) if n else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that neither large nor small components are lost."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
