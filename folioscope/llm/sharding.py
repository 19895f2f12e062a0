"""Contiguous shards of equal bytes.

Rows are put in order of their id by a range partitioning. Each partition's total is one
row; running sums over these few rows tell every partition how many bytes and rows lie
before it, and a row adds the sum within its own partition. The global byte position of a
row decides its shard: the byte axis is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import settled, whole

SHARDS = 8


def shard_by_bytes(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the number of UTF-8 bytes of the text plus 1. Shard k takes the rows whose
    middle byte lies in the k-th of ``shards`` equal parts of all bytes, so a shard misses
    its target by less than one row at each end, and ids ascend from shard to shard.
    ``slot`` counts 0, 1, 2, ... within a shard.

    NULL texts count as empty (size 1, checksum 0). Equal ids are ordered by checksum and
    size; rows equal in all three are interchangeable. A NULL id comes first. An empty
    table gives no rows; further columns are ignored.
    """
    data = F.encode(whole(text), "utf-8")
    order = ["doc_id", "text_crc32", "size", "row"]
    measured = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(whole(text)).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),  # splits runs of equal rows
    )
    parts = settled(measured.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))

    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    totals = (
        parts.groupBy("part")
        .agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
        .select(
            "part",
            F.coalesce(F.sum("part_bytes").over(by_part), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("part_rows").over(by_part), F.lit(0)).alias("rows_before"),
            F.sum("part_bytes").over(everything).alias("all_bytes"),
        )
    )  # one row per partition of the range partitioning: bounded, so it may be broadcast
    within = Window.partitionBy("part").orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        parts.withColumn("bytes_here", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .withColumn("rows_here", F.row_number().over(within) - 1)
        .join(F.broadcast(totals), "part")
        .withColumn("start", F.col("bytes_before") + F.col("bytes_here"))
        .withColumn("position", F.col("rows_before") + F.col("rows_here"))
        .withColumn(
            "shard", F.expr(f"cast((2 * start + size) * {int(shards)} div (2 * all_bytes) as int)")
        )
    )
    firsts = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot")
    )
