"""Vectors as whole numbers: the form in which scores and moments are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256.0


def whole(embedding: Column, largest: float = 2.0**62) -> Column:
    """``floor(256 * c)`` of every component as ``array<bigint>``.

    Null for a vector that is null or empty, that holds a null or a non-finite component, or one whose
    scaled size reaches ``largest`` and so does not fit.
    """
    value = embedding.cast("array<double>")
    good = F.forall(value, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) * SCALE < largest), F.lit(False)))
    return F.when(F.coalesce((F.size(value) > 0) & good, F.lit(False)), F.transform(value, lambda c: F.floor(c * SCALE)))


def rows_by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length of vector -> (places of its rows, their matrix of 64-bit numbers); the column holds no nulls."""
    offsets = np.asarray(column.offsets)
    sizes = np.diff(offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    out = {}
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        out[int(dim)] = at, values[offsets[at][:, None] + np.arange(dim)]
    return out
