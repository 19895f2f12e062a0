"""Cutting sources into chunks of pages, and the manifest of the cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.running import running_total
from folioscope.operators.spread import count_up
from folioscope.schemas import DEFAULT_CHUNK_SIZE

CHUNK_FILE = "chunk_%04d"


def _check(size: int) -> None:
    if size < 1:
        raise ValueError("a chunk holds at least one page")


def assign_chunks(pages: DataFrame, size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Add ``chunk_id``: 0 for the first ``size`` pages, 1 for the next, ..."""
    _check(size)
    return pages.withColumn("chunk_id", F.expr(f"(page_number - 1) div {size}"))


def assign_chunks_by_words(pages: DataFrame, budget: int) -> DataFrame:
    """Add ``chunk_id``: how often ``budget`` words fit into the pages before this one.

    Chunks so hold about ``budget`` words; ids may skip when a page is longer.
    """
    if budget < 1:
        raise ValueError("a word budget is at least one word")
    totals = running_total(
        pages.drop("chunk_id"), ["source_file"], "page_number", "words_before", F.col("word_count")
    )
    return totals.withColumn("chunk_id", F.expr(f"words_before div {budget}"))


def manifest(pages: DataFrame, size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """One descriptor per chunk of each source, whether or not all its pages are there.

    The largest page number of a source is its total, here as in the header.
    """
    return manifest_from_counts(manifest_header(pages, size), size)


def _descriptors(chunks: DataFrame, size: int) -> DataFrame:
    start = F.col("chunk_id") * size + 1
    return chunks.select(
        "chunk_id",
        F.format_string(CHUNK_FILE, "chunk_id").alias("path"),
        "source_file",
        start.alias("start_page"),
        "end_page",
        (F.col("end_page") - start + 1).alias("page_count"),
    )


def manifest_from_counts(counts: DataFrame, size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """The same descriptors from ``(source_file, total_pages)`` alone."""
    _check(size)
    counted = counts.select(
        "source_file", "total_pages", F.expr(f"(total_pages + {size - 1}) div {size}").alias("num_chunks")
    )
    end = F.least((F.col("chunk_id") + 1) * size, F.col("total_pages")).cast("long")
    chunks = count_up(counted, "num_chunks", "chunk_id", "source_file").withColumn("end_page", end)
    return _descriptors(chunks, size)


def manifest_header(pages: DataFrame, size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Pages and chunks of each source: by the largest page number, or by counting rows
    that have no numbers."""
    _check(size)
    numbered = "page_number" in pages.columns
    total = F.max("page_number").cast("long") if numbered else F.count(F.lit(1))
    return (
        pages.groupBy("source_file")
        .agg(total.alias("total_pages"))
        .select(
            "source_file",
            "total_pages",
            F.lit(size).cast("long").alias("chunk_size"),
            F.expr(f"(total_pages + {size - 1}) div {size}").alias("num_chunks"),
        )
    )


def chunk_pages(manifest: DataFrame, pages: DataFrame) -> DataFrame:
    """The pages of each descriptor: an equi-join on the chunk, not a range join."""
    return manifest.join(pages, ["source_file", "chunk_id"])
