"""Chunk and book metrics, flat and nested.

Only chunks are ever collected into one row, and a chunk holds a fixed number of
pages. Books have no such bound, so a nested book comes in parts of a fixed number of
chunks, each carrying the totals of the whole book; a short book is one part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.chunking import CHUNK_FILE
from folioscope.operators.spread import count_up
from folioscope.schemas import CHUNK_RESULT

PART_CHUNKS = 64


def _metrics() -> list[Column]:
    pages = F.count(F.lit(1))
    # Pages are joined by one line feed each: that many more characters, no more words.
    return [
        F.min("page_number").cast("long").alias("start_page"),
        F.max("page_number").cast("long").alias("end_page"),
        pages.alias("page_count"),
        F.sum("word_count").cast("long").alias("word_count"),
        (F.sum("char_count") + pages - 1).cast("long").alias("char_count"),
    ]


def chunk_metrics(pages: DataFrame) -> DataFrame:
    """Span, size, words and characters of each chunk."""
    return pages.groupBy("source_file", "chunk_id").agg(*_metrics())


def _ordered_text() -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("page_number", "text")))
    return F.array_join(F.transform(ordered, lambda page: page["text"]), "\n")


def chunk_texts(pages: DataFrame) -> DataFrame:
    """Chunk metrics and the texts of the pages, joined by line feeds in page order."""
    return pages.groupBy("source_file", "chunk_id").agg(*_metrics(), _ordered_text().alias("text"))


def chunk_results(pages: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """The nested result of each chunk: its metrics and its list of page records."""
    record = F.struct(
        F.col("page_number").cast("int").alias("page_number"),
        F.col("char_count").cast("int").alias("char_count"),
        F.col("word_count").cast("int").alias("word_count"),
        F.col("text"),
    )
    now = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    grouped = pages.groupBy("source_file", "chunk_id").agg(
        *_metrics(), F.array_sort(F.collect_list(record)).alias("pages")
    )
    return grouped.select(
        F.col("chunk_id").cast("long").alias("chunk_id"),
        F.format_string(CHUNK_FILE, "chunk_id").alias("chunk_path"),
        "source_file",
        "start_page",
        "end_page",
        "page_count",
        "word_count",
        "char_count",
        (now if processed_at is None else processed_at).cast("double").alias("processed_at"),
        "pages",
    )


def chunk_status(manifest: DataFrame, results: DataFrame, path: str = "") -> DataFrame:
    """For each chunk of the manifest whether its result was found (``done``) or is
    ``missing``, and the folder of the results of its source below ``path``."""
    found = results.select("source_file", "chunk_id", F.lit("done").alias("status")).distinct()
    folder = F.concat(F.lit(f"{path}/" if path else ""), F.lit("source_file="), F.col("source_file"))
    return manifest.join(found, ["source_file", "chunk_id"], "left").select(
        "source_file",
        "chunk_id",
        F.when(F.col("status").isNotNull(), folder).alias("result_path"),
        F.coalesce("status", F.lit("missing")).alias("status"),
    )


def with_manifest(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest rows with the counts of their results; a lost chunk shows with NULLs."""
    counts = chunks.select("source_file", "chunk_id", "word_count", "char_count")
    return manifest.join(counts, ["source_file", "chunk_id"], "left")


def book_totals(chunks: DataFrame) -> DataFrame:
    """Chunks, pages and words of each source, from chunk rows."""
    return chunks.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("num_chunks"),
        F.sum("page_count").cast("long").alias("total_pages"),
        F.coalesce(F.sum("word_count"), F.lit(0)).cast("long").alias("total_word_count"),
    )


def in_parts(
    rows: DataFrame, fields: list[str], totals: list[Column], part_chunks: int = PART_CHUNKS
) -> DataFrame:
    """Nest chunk rows by source, ``part_chunks`` to a row, under the source's totals.

    ``totals`` are aggregates over the part rows. They are spread over the parts first
    and joined on ``(source_file, part)``, so a long source does not end in one task.
    """
    if part_chunks < 1:
        raise ValueError("a part holds at least one chunk")
    parts = (
        rows.withColumn("part", F.expr(f"chunk_id div {part_chunks}"))
        .groupBy("source_file", "part")
        .agg(
            F.array_sort(F.collect_list(F.struct(*fields))).alias("chunks"),
            F.count(F.lit(1)).alias("__chunks"),
            F.sum("page_count").cast("long").alias("__pages"),
            F.sum("word_count").cast("long").alias("__words")
            if "word_count" in rows.columns
            else F.lit(None).cast("long").alias("__words"),
        )
    )
    by_source = parts.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("num_parts"), (F.max("part") + 1).alias("__ids"), *totals
    )
    header = count_up(by_source, "__ids", "part", "source_file").drop("__ids")
    return parts.drop("__chunks", "__pages", "__words").join(header, ["source_file", "part"])


def book_documents(results: DataFrame, part_chunks: int = PART_CHUNKS) -> DataFrame:
    """Merged books: chunk results in order, with the book's totals.

    From :func:`chunk_metrics`, which has no pages, this is the outline of the books.
    """
    fields = [name for name in CHUNK_RESULT.names if name in results.columns]
    nested = in_parts(
        results,
        fields,
        [
            F.sum("__chunks").alias("num_chunks"),
            F.sum("__pages").alias("total_pages"),
            F.coalesce(F.sum("__words"), F.lit(0)).alias("total_word_count"),
        ],
        part_chunks,
    )
    return nested.select(
        "source_file", "part", "num_parts", "num_chunks", "chunks", "total_pages", "total_word_count"
    )


def manifest_documents(
    manifest: DataFrame, chunk_size: int, part_chunks: int = PART_CHUNKS * 64
) -> DataFrame:
    """Manifests with their descriptors nested in order."""
    nested = in_parts(
        manifest,
        ["chunk_id", "path", "source_file", "start_page", "end_page", "page_count"],
        [F.sum("__chunks").alias("num_chunks"), F.sum("__pages").alias("total_pages")],
        part_chunks,
    )
    return nested.select(
        "source_file",
        "part",
        "num_parts",
        "total_pages",
        F.lit(chunk_size).cast("long").alias("chunk_size"),
        "num_chunks",
        "chunks",
    )


def unnest_chunks(books: DataFrame) -> DataFrame:
    """The chunk rows of merged books."""
    return books.select(F.explode("chunks").alias("chunk")).select("chunk.*")


def unnest_pages(results: DataFrame) -> DataFrame:
    """The page rows of chunk results."""
    return results.select("source_file", "chunk_id", F.explode("pages").alias("page")).select(
        "source_file", "chunk_id", "page.*"
    )


def chunk_report(chunks: DataFrame) -> DataFrame:
    """Printable lines: zero-padded id, right-aligned span, grouped thousands."""
    words = F.lpad(F.format_number("word_count", 0), 6, " ")
    chars = F.lpad(F.format_number("char_count", 0), 7, " ")
    line = F.concat(
        F.lit("Chunk "),
        F.format_string("%02d", "chunk_id"),
        F.lit(": Pages "),
        F.format_string("%3d-%3d", "start_page", "end_page"),
        F.lit(" | "),
        words,
        F.lit(" words | "),
        chars,
        F.lit(" chars"),
    )
    return chunks.select(
        "source_file", "chunk_id", "start_page", "end_page", "word_count", "char_count", line.alias("line")
    )
