"""Embedding-vector column functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fixed_width(vector: Column, dim: int) -> Column:
    """The vector as doubles; a row of any other width fails the job, null passes."""
    problem = F.raise_error(
        F.concat(F.lit(f"expected {dim} values, got "), F.size(vector).cast("string"))
    )
    return F.when(vector.isNotNull() & (F.size(vector) != dim), problem.cast("array<double>")).otherwise(
        vector.cast("array<double>")
    )


def nearest(vector: Column, centers: np.ndarray, labels: np.ndarray) -> Column:
    """Label of the nearest center by squared Euclidean distance; ties go to the first center.

    The few centers travel in the function itself, so assignment needs no shuffle. A vector of
    another width fails the job; a null one has no label.
    """
    dim = centers.shape[1]

    @F.arrow_udf(T.LongType())
    def assign(vectors: pa.Array) -> pa.Array:
        widths = pc.unique(pc.list_value_length(vectors)).drop_null().to_pylist()
        if widths not in ([], [dim]):
            raise ValueError(f"expected {dim} values, got {widths}")
        known = vectors.is_valid().to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        points = flat.reshape(-1, dim)
        best = np.zeros(len(points), dtype=np.int64)
        best_distance = np.full(len(points), np.inf)
        for position, center in enumerate(centers):
            gap = points - center
            distance = np.einsum("ij,ij->i", gap, gap)
            closer = distance < best_distance
            best[closer] = position
            best_distance[closer] = distance[closer]
        result = np.zeros(len(vectors), dtype=np.int64)
        result[known] = labels[best]
        return pa.array(result, mask=~known)

    return assign(vector.cast("array<double>"))
