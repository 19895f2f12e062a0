"""Turning a count into that many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def count_up(df: DataFrame, count: str, name: str, key: str, block: int = BLOCK) -> DataFrame:
    """For each row, ``count`` rows with ``name`` = 0 .. count - 1 (none for a count of 0).

    It goes in two steps, block starts then numbers, with a shuffle between: arrays stay
    short and a row with a large count is spread over the tasks.
    """
    starts = df.filter(F.col(count) > 0).withColumn(
        "__first", F.explode(F.expr(f"sequence(0L, cast({count} AS bigint) - 1, {block}L)"))
    )
    last = F.least(F.col("__first") + block, F.col(count).cast("long")) - 1
    return (
        starts.repartition(key, "__first")
        .withColumn(name, F.explode(F.sequence("__first", last)))
        .drop("__first")
    )
