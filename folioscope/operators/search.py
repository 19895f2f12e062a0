"""Exact search with one query vector, and attaching rows to hits.

Rank order everywhere: similarity rounded to six places, descending, missing last;
then the row key, ascending. Thresholds test the unrounded value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.matrices import batch_similarity
from folioscope.functions.vectors import ROUNDING
from folioscope.schemas import PAGE_KEY

DEFAULT_TOP_K = 5
DEFAULT_THRESHOLD = 0.5


def rank_order(key: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last("similarity"), *[F.asc(name) for name in key]]


def ranked(hits: DataFrame, order: Sequence[Column], per: Sequence[str] = ()) -> DataFrame:
    """Add ``rank`` from 1. Without ``per``, ``hits`` must already be limited."""
    window = Window.partitionBy(*[F.col(name) for name in per]).orderBy(*order)
    return hits.withColumn("rank", F.row_number().over(window).cast("long"))


def in_source(rows: DataFrame, source: str | None, column: str = "source_file") -> DataFrame:
    """Rows of one source; no source (``None`` or empty) means all."""
    return rows.filter(F.col(column) == F.lit(source)) if source else rows


def top_k(
    rows: DataFrame,
    query: Sequence[float],
    k: int = DEFAULT_TOP_K,
    source: str | None = None,
    threshold: float | None = None,
    key: Sequence[str] = PAGE_KEY,
    source_column: str = "source_file",
    vector: str = "embedding",
    score: Callable[[str, Sequence[float]], Column] = batch_similarity,
) -> DataFrame:
    """The ``k`` rows most similar to ``query``, with ``similarity`` and ``rank``.

    The plan is one scan with a heap of ``k`` rows per task. The vector itself is not
    part of the result. ``score`` may be ``functions.vectors.search_similarity`` to stay
    in the JVM, at two to three times the time. Select few columns beforehand, or attach them with
    :func:`attach_rows`, when the rows are wide.
    """
    scored = in_source(rows, source, source_column).withColumn(
        "similarity", score(vector, query)
    )
    if threshold is not None:
        scored = scored.filter(F.col("similarity") >= F.lit(float(threshold)))
    scored = scored.withColumn("similarity", F.round("similarity", ROUNDING)).drop(vector)
    order = rank_order(key)
    return ranked(scored.orderBy(*order).limit(k), order)


def similarities(
    rows: DataFrame,
    query: Sequence[float],
    vector: str = "embedding",
    score: Callable[[str, Sequence[float]], Column] = batch_similarity,
) -> DataFrame:
    """All rows with ``similarity``, rounded as for ranking, in place of the vector."""
    return rows.withColumn("similarity", F.round(score(vector, query), ROUNDING)).drop(vector)


def semantic_search(
    rows: DataFrame,
    query: Sequence[float],
    limit: int = DEFAULT_TOP_K,
    threshold: float = DEFAULT_THRESHOLD,
    **options,
) -> DataFrame:
    """:func:`top_k` with an inclusive threshold."""
    return top_k(rows, query, limit, threshold=threshold, **options)


def attach_rows(hits: DataFrame, rows: DataFrame, key: Sequence[str] = PAGE_KEY) -> DataFrame:
    """The columns of ``rows`` for each hit: first the hits' columns, then the others.

    Whether the hits travel to the rows or both are shuffled, Spark decides by the size it
    measures.
    """
    others = [name for name in rows.columns if name not in key]
    return hits.join(rows, list(key)).select(*hits.columns, *others)
