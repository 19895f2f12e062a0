"""Vectors of an Arrow batch as a matrix, for work inside Python workers."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def to_matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    """Rows as doubles; a missing vector or one of another length becomes NaN."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    matrix = np.full((len(vectors), dimension), np.nan)
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(sizes == dimension)
    if len(usable):
        flat = vectors.take(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
        matrix[usable] = flat.reshape(len(usable), dimension)
    return matrix


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows at unit length; NaN for rows without a direction."""
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(length > 0, length, np.nan)


def pair_scores(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query in the same place (or with the only query).

    All searches score with this one expression, so that they agree to the last bit. NaN
    without a direction.
    """
    scale = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((queries * queries).sum(axis=1))
    with np.errstate(invalid="ignore", over="ignore"):
        return (rows * queries).sum(axis=1) / np.where(scale > 0, scale, np.nan)


def round_half_up(values: np.ndarray, places: int) -> np.ndarray:
    """As Spark's ``round``: halves, by the shortest decimal form, away from zero."""
    rounded = np.round(values, places)
    scaled = np.abs(values) * 10.0**places
    with np.errstate(invalid="ignore"):
        close = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4
    unit = Decimal(1).scaleb(-places)
    for at in np.flatnonzero(close):
        rounded[at] = float(Decimal(repr(float(values[at]))).quantize(unit, ROUND_HALF_UP))
    return rounded


def batch_similarity(vector: Column | str, query: Sequence[float]) -> Column:
    """The same as :func:`folioscope.functions.vectors.search_similarity`, one matrix
    product per Arrow batch. Only the vectors go to Python; faster on large tables, more
    so the longer the vectors."""
    direction = np.asarray(query, dtype=float).reshape(1, -1)

    @F.arrow_udf("double")
    def similarity(vectors: pa.Array) -> pa.Array:
        scores = pair_scores(to_matrix(vectors, direction.shape[1]), direction)
        return pa.array(scores, mask=np.isnan(scores))

    # Declared so that a filter on the score reads the column instead of computing it again.
    similarity = similarity.asNondeterministic()
    return similarity(F.col(vector) if isinstance(vector, str) else vector)
