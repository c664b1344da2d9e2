"""What the operators on embedding vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mentionmill.llm.common import named

__all__ = ["MOST", "bounded", "finite", "matrix", "named", "packed", "scaled", "unpacked"]

#: Integer components beyond this count as it, so that 64 squared differences fit a long.
MOST = 1 << 26


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers; null counts as no."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def scaled(vector: Column, scale: float = 256.0) -> Column:
    """Each component as the integer ``floor(scale * x)``, computed in double; saturated at ``MOST``."""
    clip = lambda v: F.greatest(F.least(v, F.lit(float(MOST))), F.lit(-float(MOST)))
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(clip(v * scale)).cast("int"))


def matrix(column: pa.Array, dims: int, kind: type = np.int64) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dims)


def packed(rows: np.ndarray) -> pa.Array:
    """The rows of a byte matrix as binaries."""
    n, width = rows.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """Binaries of one length as the rows of a byte matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def bounded(df: DataFrame, most: int = 10_000) -> DataFrame | None:
    """``df`` to broadcast if it has ``most`` rows or fewer, else nothing."""
    return F.broadcast(df) if len(df.limit(most + 1).select(F.lit(1)).collect()) <= most else None
