"""Vector columns as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Larger whole numbers count as this one, so that sums over tables of any size stay exact.
LARGEST = 1 << 45


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * c) of each component c."""
    limit = float(LARGEST)
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(limit)), F.lit(-limit))).cast("long"))


def padded(values: Column, width: int, with_: int = 0) -> Column:
    """The values and as many further ones as the width has."""
    return F.concat(values, F.array_repeat(F.lit(with_).cast("long"), F.greatest(F.lit(width) - F.size(values), F.lit(0))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of that many numbers as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
