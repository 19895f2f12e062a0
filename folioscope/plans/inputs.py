"""The given tables as pages, vectors and queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.embedding import embed_words
from folioscope.functions.text import or_empty, word_count, words
from folioscope.operators.bm25 import WordIndex
from folioscope.operators.search import in_source
from folioscope.operators.trigrams import TrigramIndex
from folioscope.schemas import PAGE_KEY, PAGES_TABLE
from folioscope.session import scratch_path
from folioscope.sources.paged import page_table
from folioscope.sources.store import PageStore, page_vectors

STORED_PAGES = T.StructType([*PAGES_TABLE.fields, T.StructField("document_id", T.LongType())])
_STORED: dict[tuple[str, str, str], tuple[tuple, str]] = {}
CREATED = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """The table for heavy work per row. Where the session sets ``spark.folioscope.spread``, as
    one on a single machine with few small files does, rows are shuffled over all cores."""
    rows = table(spark, folder, name)
    return rows.repartition(key) if spark.conf.get("spark.folioscope.spread", "false") == "true" else rows


def pages(spark: SparkSession, folder: str, only: str | None = None, **more: Column) -> DataFrame:
    """The page table over ``documents``: one source per ``source``, one page per row.
    ``more`` columns are taken from the documents before these are numbered."""
    keep: dict[str, Column] = {"document_id": F.col("doc_id"), "created_at": F.expr(CREATED), **more}
    return page_table(table(spark, folder, "documents"), "source", "doc_id", keep=keep, only=only)


def _version(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at a path: another version, another store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def _kept(spark: SparkSession, folder: str, name: str, make: Callable[[str], None]) -> str:
    """The path of something derived from ``documents``, made when the first query of an
    application asks for it, and again when the table has changed."""
    version = _version(spark, f"{folder}/documents.parquet")
    key = (spark.sparkContext.applicationId, folder, name)
    if key in _STORED and _STORED[key][0] == version and PageStore(spark, _STORED[key][1]).exists():
        return _STORED[key][1]
    path = scratch_path(spark, name)
    make(path)
    _STORED[key] = (version, path)
    return path


def page_store(spark: SparkSession, folder: str) -> PageStore:
    """The page table over ``documents`` with vectors in a page store: texts are numbered,
    measured and embedded once, and all searches read it."""

    def make(path: str) -> None:
        rows = page_vectors(pages(spark, folder), embed_words)
        PageStore(spark, path, schema=STORED_PAGES).replace_sources(rows)

    return PageStore(spark, _kept(spark, folder, "stored-pages", make), schema=STORED_PAGES)


def stored_pages(spark: SparkSession, folder: str) -> DataFrame:
    return page_store(spark, folder).read()


def trigram_index(spark: SparkSession, folder: str) -> TrigramIndex:
    """The trigrams of the stored pages."""

    def make(path: str) -> None:
        TrigramIndex(spark, path).build(stored_pages(spark, folder).select(*PAGE_KEY, "text"))

    return TrigramIndex(spark, _kept(spark, folder, "trigrams", make))


def word_index(spark: SparkSession, folder: str) -> WordIndex:
    """The words of the pages, which need no vectors for it."""

    def make(path: str) -> None:
        WordIndex(spark, path).build(pages(spark, folder).select(*PAGE_KEY, "text"))

    return WordIndex(spark, _kept(spark, folder, "words", make))


def stored_vectors(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Vectors of the stored pages by page key, with further columns."""
    return stored_pages(spark, folder).select(*PAGE_KEY, "embedding", *columns)


def page_contents(spark: SparkSession, folder: str) -> DataFrame:
    """Text, word count and time by ``document_id``."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("document_id"),
        or_empty("text").alias("text"),
        word_count("text").alias("word_count"),
        F.expr(CREATED).alias("created_at"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def located_vectors(spark: SparkSession, folder: str, only: str | None = None, *columns: str) -> DataFrame:
    """The stored pages with the given embedding of the same id; pages without one have
    NULL."""
    vectors = embeddings(spark, folder).select(F.col("vec_id").alias("document_id"), "embedding")
    rows = in_source(stored_pages(spark, folder), only).select(*PAGE_KEY, "document_id", *columns)
    return rows.join(vectors, "document_id", "left")


def query_vector(spark: SparkSession, folder: str, vec_id: int = 0) -> list[float]:
    """One stored vector as the query of a single search."""
    row = embeddings(spark, folder).filter(F.col("vec_id") == vec_id).select("embedding").first()
    return list(row["embedding"])


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of ``benchmark`` as search queries, embedded like the pages."""
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", embed_words("text").alias("embedding")
    )


def question_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Each text of ``benchmark`` whole and as its two halves: three ways to ask."""
    half = F.expr("size(w) div 2")
    forms = (
        table(spark, folder, "benchmark")
        .select(F.col("item_id"), words("text").alias("w"))
        .select(
            "item_id",
            F.posexplode(
                F.array(
                    F.array_join("w", " "),
                    F.array_join(F.slice("w", 1, half), " "),
                    F.array_join(F.slice("w", half + 1, F.size("w")), " "),
                )
            ).alias("form", "text"),
        )
    )
    return forms.select(
        (F.col("item_id") * 3 + F.col("form")).alias("query_id"),
        "item_id",
        embed_words("text").alias("embedding"),
    )


def label_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """One query per label: the mean vector of its rows."""
    elements = embeddings(spark, folder).select("label", F.posexplode("embedding").alias("pos", "x"))
    means = elements.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda e: e["x"]).alias("embedding")
    )
