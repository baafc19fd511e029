"""Integer vectors shared by the operators over embeddings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def limit(dimension: int) -> int:
    """Integers are kept within plus or minus this, so that squared distances fit into a long."""
    return math.isqrt((1 << 62) // max(1, dimension)) // 2


def is_complete(vector: Column) -> Column:
    """Whether a vector is there and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(vector: Column, scale: int, dimension: int) -> Column:
    """floor(scale * x) of every component, kept within `limit`."""
    most = limit(dimension)
    inside = lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(x.cast("double") * scale)))
    return F.transform(vector, lambda x: inside(x).cast("int"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A column of equally long integer vectors as rows of int64."""
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), dimension)


def list_of(values) -> pa.Array:
    """One list that holds all the values."""
    values = values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def floor_means(table: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of `table`, each replaced by floor(sum / count) where the count is not zero."""
    means = sums // np.maximum(counts, 1)[..., None]
    return np.where(counts[..., None] > 0, means, table)


def totals(sums: DataFrame) -> list:
    """Sums of long tables (group, entry, place, total); as many rows as the parameters allow, whatever the data."""
    return sums.groupBy("group", "entry", "place").agg(F.sum("total").alias("total")).collect()
