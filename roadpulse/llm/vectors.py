"""Vectors as integers, as the vector operators take them."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Integers of at most this size keep sums of 512 products of two of them within 62 bits.
LIMIT = 1 << 26


def whole(vector: Column | str) -> Column:
    """The vector is there and so are all its components, none of them infinite or NaN."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))


def integers(vector: Column | str, scale: int) -> Column:
    """floor(scale * x) for each component; null if one of them is larger than `LIMIT`."""
    scaled = F.transform(vector, lambda x: scale * x.cast("double"))
    fits = F.forall(scaled, lambda x: F.abs(x) <= LIMIT)
    return F.when(fits, F.transform(scaled, lambda x: F.floor(x).cast("int")))


def matrix(vectors: Iterable[np.ndarray], width: int, dtype: type = np.int64) -> np.ndarray:
    """The vectors as rows, shorter ones filled up with zeros."""
    rows = list(vectors)
    if rows and all(len(v) == width for v in rows):
        return np.stack(rows).astype(dtype)
    out = np.zeros((len(rows), width), dtype=dtype)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out
