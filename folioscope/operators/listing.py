"""Listings and statistics of a page table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import iso_timestamp
from folioscope.operators.search import in_source, ranked
from folioscope.schemas import PAGE_KEY

DEFAULT_RECENT = 10


def list_documents(pages: DataFrame, source: str | None = None) -> DataFrame:
    """The sources and their numbers of pages."""
    return in_source(pages, source).groupBy("source_file").agg(F.count(F.lit(1)).alias("pages"))


def table_stats(pages: DataFrame) -> DataFrame:
    """Pages, sources and words of the table; a missing word count adds nothing.

    Summed per source first, so that counting distinct sources needs no second shuffle
    of rows.
    """
    per_source = pages.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("word_count").alias("words")
    )
    return per_source.agg(
        F.coalesce(F.sum("pages"), F.lit(0)).cast("long").alias("total_pages"),
        F.count("source_file").alias("unique_documents"),
        F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("total_words"),
    )


def document_summary(pages: DataFrame, document_id, column: str = "document_id") -> DataFrame:
    """Pages, words and characters of one document; no row for an unknown one."""
    return (
        pages.filter(F.col(column) == F.lit(document_id))
        .groupBy(F.col(column).alias("document_id"))
        .agg(
            F.count(F.lit(1)).alias("total_pages"),
            F.coalesce(F.sum("word_count"), F.lit(0)).cast("long").alias("total_words"),
            F.coalesce(F.sum("char_count"), F.lit(0)).cast("long").alias("total_chars"),
        )
    )


def first_page(pages: DataFrame, source: str, key: Sequence[str] = PAGE_KEY) -> DataFrame:
    """The first page of a source, or no row."""
    return in_source(pages, source).orderBy(*key).limit(1) if source else pages.limit(0)


def recent_pages(
    pages: DataFrame, limit: int = DEFAULT_RECENT, key: Sequence[str] = PAGE_KEY
) -> DataFrame:
    """The pages added last, newest first."""
    order = [F.desc_nulls_last("created_at"), *[F.asc(name) for name in key]]
    newest = ranked(pages.orderBy(*order).limit(limit), order)
    return newest.withColumn("created_at", iso_timestamp("created_at"))


def with_document(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Page rows with the span and counts of their chunk."""
    columns = {name: f"chunk_{name}" for name in ("word_count", "char_count") if name in chunks.columns}
    return pages.join(chunks.withColumnsRenamed(columns), ["source_file", "chunk_id"])
