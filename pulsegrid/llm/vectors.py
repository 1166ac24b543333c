"""Vector columns as numpy matrices, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest double below 2**63; floors beyond it stay there.
FAR = float(2**63 - 1024)


def vector_rows(df: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """vec_id (long), v (array of double) and ``more`` of the rows whose vector
    is not null and holds neither null nor non-finite components."""
    raw = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("v"), *more)
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return raw.where(F.col("v").isNotNull()).where(~bad)


def matrix(column: pa.ListArray, dim: int | None = None) -> np.ndarray:
    """A column of vectors (no nulls) as rows of doubles, short ones padded
    with zeros to ``dim`` (default: the longest)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pc.list_value_length(column)).astype(np.int64)
    dim = int(lengths.max(initial=0)) if dim is None else dim
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim)
    out = np.zeros((len(lengths), dim))
    out[np.arange(dim) < lengths[:, None]] = flat
    return out


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -FAR, FAR).astype(np.int64)


def narrow(x: np.ndarray) -> bytes:
    """A matrix of 64-bit integers as bytes of the narrowest type that holds them."""
    low, high = x.min(initial=0), x.max(initial=0)
    return x.astype(next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)).tobytes()


def widened(cell: bytes, n: int, dim: int) -> np.ndarray:
    """The ``n`` x ``dim`` matrix that ``narrow`` made ``cell`` of."""
    return np.frombuffer(cell, f"<i{len(cell) // (n * dim)}" if n * dim else "<i8").reshape(n, dim).astype(np.int64)


def as_long(value: int) -> int:
    """A whole number of any size, held to the range of a long."""
    return max(-(2**63), min(2**63 - 1, int(value)))
