"""Sources of pages: tables, separated texts and files read by an extractor."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions.text import char_count, or_empty, word_count
from folioscope.operators.chunking import assign_chunks
from folioscope.operators.running import row_numbers
from folioscope.operators.search import in_source
from folioscope.schemas import DEFAULT_CHUNK_SIZE, required

PAGE_BREAK = "\f"
Extractor = Callable[[bytes], Iterable[str | None]]


def with_metrics(pages: DataFrame) -> DataFrame:
    """Replace a missing text by the empty one; add ``word_count`` and ``char_count``."""
    return pages.withColumns(
        {
            "text": or_empty("text"),
            "word_count": word_count("text"),
            "char_count": char_count("text"),
        }
    )


def page_table(
    rows: DataFrame,
    source: str,
    order: str,
    text: str = "text",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    keep: dict[str, Column] | None = None,
    only: str | None = None,
    key_bits: int = 34,
) -> DataFrame:
    """Number the rows of each source by the integer column ``order`` and cut them into
    chunks. ``keep`` names further columns to carry. ``only`` restricts the table to one
    source, by a filter the scan can use.

    Counts are taken before the rows are shuffled, so that a plan which only needs
    counts never moves a text.
    """
    pages = in_source(rows, only, source).select(
        or_empty(source).alias("source_file"),
        required(order).cast("long").alias("__order"),
        F.col(text).alias("text"),
        *[column.alias(name) for name, column in (keep or {}).items()],
    )
    numbered = row_numbers(with_metrics(pages), ["source_file"], "__order", "page_number", key_bits)
    return assign_chunks(numbered.drop("__order"), chunk_size)


def split_pages(
    documents: DataFrame,
    source: str,
    text: str = "text",
    separator: str = r"\f",
    chunk_size: int = DEFAULT_CHUNK_SIZE,
) -> DataFrame:
    """Pages of documents that come as one text each; ``separator`` is a regular expression.

    A trailing separator ends the last page, it does not start another. A document
    without text has no pages.
    """
    documents = documents.filter(F.length(text) > 0)
    body = F.regexp_replace(or_empty(text), f"(?:{separator})\\z", "")
    pages = documents.select(
        or_empty(source).alias("source_file"), F.posexplode(F.split(body, separator))
    ).select("source_file", (F.col("pos") + 1).cast("long").alias("page_number"), F.col("col").alias("text"))
    return assign_chunks(with_metrics(pages), chunk_size)


def plain_text_pages(content: bytes) -> list[str]:
    """Pages of a UTF-8 text file with form feeds between pages."""
    text = content.decode("utf-8", errors="replace")
    return text.removesuffix(PAGE_BREAK).split(PAGE_BREAK) if text else []


def read_paged_files(
    spark: SparkSession,
    path: str,
    extractor: Extractor = plain_text_pages,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    pattern: str | None = None,
) -> DataFrame:
    """Pages of all files below ``path``; ``extractor`` turns the bytes of one file into
    its page texts. A page without text becomes an empty page."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                texts = list(extractor(bytes(content)))
                yield pd.DataFrame(
                    {"source_file": name, "page_number": range(1, len(texts) + 1), "text": texts}
                )

    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path).select("path", "content")
    pages = files.mapInPandas(extract, "source_file string, page_number long, text string")
    return assign_chunks(with_metrics(pages), chunk_size)


def read_page_text(
    spark: SparkSession, path: str, separator: str = PAGE_BREAK, chunk_size: int = DEFAULT_CHUNK_SIZE, pattern: str | None = None
) -> DataFrame:
    """Pages of UTF-8 text files below ``path`` that ``separator`` ends, files of any size.

    Spark plans the files in byte ranges, and a page belongs to the range in which it
    begins, so many tasks read one large file. Pages are numbered within their range, which
    is bounded, and after the pages of the file's earlier ranges. The rows are those of
    :func:`split_pages` for the texts of the files.
    """
    reader = spark.read.option("lineSep", separator).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__at"),
        F.col("value").alias("text"),
    )
    # Counts first: what is shuffled for the numbers has no text.
    ranges = lines.groupBy("source_file", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    earlier = Window.partitionBy("source_file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    number = (F.col("__before") + F.col("__at") - F.col("__first") + 1).cast("long")
    pages = lines.join(offsets, ["source_file", "__start"]).select("source_file", number.alias("page_number"), "text")
    return assign_chunks(with_metrics(pages), chunk_size)
