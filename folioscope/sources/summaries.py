"""Counts of a page store, kept beside it directory by directory."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    from folioscope.sources.store import PageStore

GROUP_COLUMN = "source_group"
SUMMARY = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("size_class", T.IntegerType()),
        T.StructField("pages", T.LongType()),
        T.StructField("words", T.LongType()),
        T.StructField("chars", T.LongType()),
        T.StructField("newest", T.TimestampNTZType()),
        T.StructField(GROUP_COLUMN, T.IntegerType()),
    ]
)


class StoreSummaries:
    """Mergeable counts of the pages at ``store``, which answer listings without a scan of pages.

    A row has a source's pages of one size class (the binary digits of their number of
    words; NULL if that is missing): how many they are, their words, characters and latest
    time. So rows add up to totals of a source, of the store, and to a histogram of sizes.
    There is a directory for each group of sources, as in the store, and a write to the store
    replaces the directories of the groups it touches, counted from keys and
    numbers alone. Each has one row of zero pages, so that a group that lost its last page is
    replaced as well.

    Before the store appends, a mark with the version of the write is put down; it goes when
    the counts have followed. Readers and writers that find a mark, as after a lost
    driver, let the counts follow first, so they are never those of another state.
    """

    def __init__(self, store: PageStore):
        if not store.groups:
            raise ValueError("summaries need a store with groups")
        self.store, self.spark = store, store.spark
        self.path, self.due = f"{store.path}/summaries", f"{store.path}/summaries_due"

    def exist(self) -> bool:
        return self.store._has(self.path)

    def build(self) -> None:
        """Count all pages; from then on every object of the store keeps the counts."""
        self.store.create()
        self._count(range(self.store.groups))

    def announce(self, version: int) -> None:
        """Put down the mark of a write to come."""
        self.settle()
        files, folder = self.store._folder(f"{self.due}/{version}")
        files.mkdirs(folder)

    def settle(self) -> None:
        """Count the groups again that writes since the oldest mark have touched."""
        if not self.store._has(self.due):
            return
        files, folder = self.store._folder(self.due)
        marks = [int(found.getPath().getName()) for found in files.listStatus(folder)]
        changes = self.store._changes()
        if marks and changes is not None:
            late = changes.filter(F.col("version") >= min(marks))
            # At most one value per group.
            groups = late.select(self.store.group(F.col("source_file"))).distinct().collect()
            self._count([row[0] for row in groups])
        self.store._remove(self.due)

    def _count(self, groups: Sequence[int]) -> None:
        if not len(groups):
            return
        wanted = list(groups)
        digits = F.length(F.bin("word_count"))
        counted = (
            self.store._read()
            .filter(F.col(GROUP_COLUMN).isin(wanted))
            .groupBy(GROUP_COLUMN, "source_file", digits.alias("size_class"))
            .agg(
                F.count(F.lit(1)).alias("pages"),
                F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"),
                F.coalesce(F.sum("char_count"), F.lit(0)).alias("chars"),
                F.max("created_at").alias("newest"),
            )
        )
        none = self.spark.createDataFrame([(None, None, 0, 0, 0, None, group) for group in wanted], SUMMARY)
        (
            counted.select(*SUMMARY.names)
            .unionByName(none)
            .repartition(GROUP_COLUMN)
            .sortWithinPartitions(GROUP_COLUMN, "source_file")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(GROUP_COLUMN)
            .parquet(self.path)
        )

    def rows(self, source: str | None = None) -> DataFrame:
        """All rows or those of a source, of which only its directory is listed."""
        self.settle()
        rows = self.spark.read.schema(SUMMARY).parquet(self.path).filter("pages > 0")
        if source:
            place = F.col(GROUP_COLUMN) == self.store.group(F.lit(source))
            rows = rows.filter(place & (F.col("source_file") == source))
        return rows.drop(GROUP_COLUMN)

    def list_documents(self, source: str | None = None) -> DataFrame:
        """As :func:`folioscope.operators.listing.list_documents`."""
        return self.rows(source).groupBy("source_file").agg(F.sum("pages").alias("pages"))

    def table_stats(self) -> DataFrame:
        """As :func:`folioscope.operators.listing.table_stats`."""
        per_source = self.rows().groupBy("source_file").agg(F.sum("pages").alias("pages"), F.sum("words").alias("words"))
        return per_source.agg(
            F.coalesce(F.sum("pages"), F.lit(0)).alias("total_pages"),
            F.count("source_file").alias("unique_documents"),
            F.coalesce(F.sum("words"), F.lit(0)).alias("total_words"),
        )

    def document_summary(self, source: str) -> DataFrame:
        """As :func:`folioscope.operators.listing.document_summary` of a source."""
        totals = [F.sum(name).alias(f"total_{name}") for name in ("pages", "words", "chars")]
        return self.rows(source).groupBy(F.col("source_file").alias("document_id")).agg(*totals)

    def page_sizes(self, source: str | None = None) -> DataFrame:
        """``size_class, pages, words``: how many pages have a number of words of so many
        binary digits, in a source or in all."""
        sums = [F.sum(name).alias(name) for name in ("pages", "words")]
        return self.rows(source).groupBy(F.col("size_class").cast("long").alias("size_class")).agg(*sums)
