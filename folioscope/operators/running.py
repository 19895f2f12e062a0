"""Running totals and row numbers within groups of any size.

A plain window over ``partitionBy(group)`` puts a whole group into one task; a source
that holds a third of all rows then decides the run time. Here the order column, an
integer, is cut into buckets of 2**13 consecutive values. Rows are summed per bucket
(with map-side combine), the bucket sums are accumulated, and each row adds the total
of the earlier buckets to a window over its own bucket. No window holds more than one
bucket of rows, and the rows are shuffled once: join and window share the clustering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF_BITS = 13
FAN_BITS = 20


def _before(*partition: str, order: str):
    return (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def _offsets(totals: DataFrame, group: Sequence[str], levels: int) -> DataFrame:
    """Total of the earlier buckets, for each ``(group, __bucket)``."""
    if levels == 0:
        earlier = F.sum("__total").over(_before(*group, order="__bucket"))
        return totals.select(*group, "__bucket", F.coalesce(earlier, F.lit(0)).alias("__offset"))
    fanned = totals.withColumn("__upper", F.shiftright("__bucket", FAN_BITS))
    upper = fanned.groupBy(*group, F.col("__upper")).agg(F.sum("__total").alias("__total"))
    upper = _offsets(upper.withColumnRenamed("__upper", "__bucket"), group, levels - 1)
    upper = upper.withColumnsRenamed({"__bucket": "__upper", "__offset": "__outer"})
    earlier = F.sum("__total").over(_before(*group, "__upper", order="__bucket"))
    return (
        fanned.withColumn("__inner", F.coalesce(earlier, F.lit(0)))
        .join(upper, [*group, "__upper"])
        .select(*group, "__bucket", (F.col("__inner") + F.col("__outer")).alias("__offset"))
    )


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    name: str,
    value: Column | None = None,
    key_bits: int = 34,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group (0 for the
    first). Without ``value``, the number of earlier rows.

    ``(group, order)`` must be unique, ``order`` an integer and not NULL, ``group`` not
    NULL. ``key_bits`` says how large ``order`` can get: a value of ``2**key_bits`` or
    more, or below minus that, fails the job, as one window would grow without bound. Use
    63 for hashed ids.
    """
    levels = max(0, -(-(key_bits - LEAF_BITS - FAN_BITS - 1) // FAN_BITS))
    group = list(group)
    counted = value is None
    place = F.col(order).cast("long")
    if key_bits < 63:
        message = F.lit(f"{order} needs more than {key_bits} bits: pass a larger key_bits")
        wide = (place >= 1 << key_bits) | (place < -(1 << key_bits))
        place = F.when(wide, F.raise_error(message)).otherwise(place)
    rows = df.withColumn("__bucket", F.shiftright(place, LEAF_BITS))
    if not counted:
        rows = rows.withColumn("__value", F.coalesce(value, F.lit(0)).cast("long"))
    total = F.count(F.lit(1)) if counted else F.sum("__value")
    totals = rows.groupBy(*group, "__bucket").agg(total.alias("__total"))
    offsets = _offsets(totals, group, levels)

    by_bucket = Window.partitionBy(*group, "__bucket").orderBy(order)
    if counted:
        local = F.row_number().over(by_bucket).cast("long") - 1
    else:
        window = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
        local = F.coalesce(F.sum("__value").over(window), F.lit(0))
    return (
        rows.withColumn("__local", local)
        .join(offsets, [*group, "__bucket"])
        .withColumn(name, F.col("__local") + F.col("__offset"))
        .select(*df.columns, name)
    )


def row_numbers(
    df: DataFrame, group: Sequence[str], order: str, name: str, key_bits: int = 34
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... within the group."""
    numbered = running_total(df, group, order, name, key_bits=key_bits)
    return numbered.withColumn(name, F.col(name) + 1)
