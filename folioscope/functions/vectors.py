"""Vector expressions over ``array<float>`` columns.

These are Catalyst higher-order functions, evaluated in the JVM. Searches use the matrix
products of ``functions.matrices``, which are faster.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDING = 6


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def vector_literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector]) if len(vector) else F.array().cast("array<double>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product in double precision; NULL on unequal lengths."""
    products = F.zip_with(_column(a), _column(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column | str) -> Column:
    squares = F.aggregate(
        _column(a), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def search_similarity(vector: Column | str, query: Sequence[float]) -> Column:
    """Cosine similarity with a fixed query; NULL when either side is missing, zero,
    of another length, or not a number, so that such rows rank last."""
    length = math.sqrt(sum(float(x) * float(x) for x in query))
    if not length > 0:
        return F.lit(None).cast("double")
    product = dot(vector, vector_literal(query))
    cosine = _let(norm(vector), lambda n: F.when(n > 0, product / (n * F.lit(length))))
    return _let(cosine, lambda c: F.when(~F.isnan(c), c))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two columns; 0 when either vector is zero."""
    return _let(norm(a) * norm(b), lambda n: F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n))


def normalize(vector: Column | str) -> Column:
    """The vector at unit length; a zero vector stays zero."""
    length = _let(norm(vector), lambda n: F.when(n > 0, n).otherwise(F.lit(1.0)))
    return _let(
        length,
        lambda n: F.transform(_column(vector), lambda x: (x.cast("double") / n).cast("float")),
    )


def is_zero(vector: Column | str) -> Column:
    return F.forall(_column(vector), lambda x: x == 0)


def is_finite(vector: Column | str) -> Column:
    limit = float("inf")
    return F.forall(
        _column(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(limit))
    )


def has_dimension(vector: Column | str, dimension: int) -> Column:
    return F.size(_column(vector)) == dimension


def checked(vector: Column | str, dimension: int) -> Column:
    """The vector, failing the job if it is present with another length."""
    value = _column(vector)
    message = F.concat(
        F.lit(f"expected {dimension} dimensions, not "), F.size(value).cast("string")
    )
    return F.when(value.isNull() | has_dimension(value, dimension), value).otherwise(
        F.raise_error(message)
    )
