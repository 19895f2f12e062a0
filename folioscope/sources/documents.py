"""JSON documents: manifests, chunk results and merged books.

One JSON object per line, compressed by Spark's writer options if wanted. A cluster
writes many files per folder; the name a single chunk would have is its ``chunk_path``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from folioscope.schemas import BOOK_DOCUMENT, CHUNK_RESULT, MANIFEST_DOCUMENT


def write_documents(documents: DataFrame, path: str, partition: str | None = None, **options) -> None:
    """Write as JSON lines, replacing what is there.

    NULL fields are written, so that every object has all keys. ``partition`` (such as
    ``source_file``) gives each value its own folder, split when it is large.
    """
    if partition:
        documents = documents.hint("rebalance", partition)
    writer = documents.write.mode("overwrite").option("ignoreNullFields", "false").options(**options)
    if partition:
        writer = writer.partitionBy(partition)
    writer.json(path)


def read_documents(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Read with a fixed schema; a malformed document fails the job."""
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
    )


def read_chunk_results(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_documents(spark, path, CHUNK_RESULT, multi_line)


def read_books(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_documents(spark, path, BOOK_DOCUMENT, multi_line)


def read_manifests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_documents(spark, path, MANIFEST_DOCUMENT, multi_line)
