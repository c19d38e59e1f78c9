"""Distances, vector arithmetic and the nearest-centroid lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def euclidean(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Distance over the listed dimensions; list fewer for a partial distance."""
    squares = [F.pow(y - x, F.lit(2.0)) for x, y in zip(a, b, strict=True)]
    return F.sqrt(reduce(add, squares))


def vector_add(a: Column, b: Column) -> Column:
    """Coordinate-wise sum of two array columns."""
    return F.zip_with(a, b, lambda x, y: x + y)


def nearest_index_of(centroids: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function from the points of one Arrow batch to the index of the nearest
    centroid of each. Ties go to the lowest index and a NaN distance never wins.

    A closure travels to the executors by value, so they need no copy of this
    package.
    """

    slice_rows = max(1, 1_000_000 // len(centroids))

    def index(points: np.ndarray) -> np.ndarray:
        found = np.empty(len(points), dtype="int64")
        # A slice at a time, so that many centroids need no more memory.
        for start in range(0, len(points), slice_rows):
            part = points[start : start + slice_rows]
            squares = np.zeros((len(part), len(centroids)))
            for dim in range(centroids.shape[1]):
                squares += (part[:, dim, None] - centroids[None, :, dim]) ** 2
            distances = np.sqrt(squares)
            distances[np.isnan(distances)] = np.inf
            found[start : start + slice_rows] = distances.argmin(axis=1)
        return found

    return index


def nearest(coords: Sequence[Column], centroids: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest of K fixed centroids.

    A batch at a time: K x d unrolled into JVM expressions overflows the JIT's
    method limit, and a higher-order function is ten times slower (see README).
    """
    nearest_index = nearest_index_of(np.asarray(centroids, dtype=float))

    @F.pandas_udf("int")
    def index(*columns: pd.Series) -> pd.Series:
        rows = np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
        return pd.Series(nearest_index(rows).astype("int32"))

    return index(*coords)
