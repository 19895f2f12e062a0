"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """The rows as written to the shared checkpoint folder: computed once, lineage cut.

    Spark's cleaner removes the files once nothing refers to the frame (with
    ``spark.cleaner.referenceTracking.cleanCheckpoints``). Lost executors lose nothing.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def whole(text: str | Column) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A column as Python strings, NULL as empty."""
    return [value or "" for value in batch.column(name).to_pylist()]


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...], **added: pa.Array) -> pa.RecordBatch:
    """The batch without some columns and with new ones at the end."""
    kept = [name for name in batch.schema.names if name not in drop]
    arrays = [batch.column(name) for name in kept] + list(added.values())
    return pa.RecordBatch.from_arrays(arrays, names=kept + list(added))


def portions(lengths: list[int], limit: int) -> Iterator[slice]:
    """Slices of consecutive items whose lengths sum to about ``limit`` at most; one item
    that is longer makes a slice of its own."""
    start, held = 0, 0
    for at, length in enumerate(lengths):
        if at > start and held + length > limit:
            yield slice(start, at)
            start, held = at, 0
        held += length
    if lengths:
        yield slice(start, len(lengths))
