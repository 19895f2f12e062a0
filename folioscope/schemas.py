"""Column contracts of the tables and JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_CHUNK_SIZE = 20
DEFAULT_DIMENSION = 384
STORED_TEXT_LIMIT = 5000

PAGE_KEY = ("source_file", "page_number")
CHUNK_KEY = ("source_file", "chunk_id")

PAGES_TABLE = T.StructType(
    [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("page_number", T.IntegerType(), False),
        T.StructField("chunk_id", T.LongType(), False),
        T.StructField("text", T.StringType(), False),
        T.StructField("word_count", T.IntegerType(), True),
        T.StructField("char_count", T.IntegerType(), True),
        T.StructField("embedding", T.ArrayType(T.FloatType()), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)

PAGE_RECORD = T.StructType(
    [
        T.StructField("page_number", T.IntegerType()),
        T.StructField("char_count", T.IntegerType()),
        T.StructField("word_count", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)

CHUNK_RESULT = T.StructType(
    [
        T.StructField("chunk_id", T.LongType()),
        T.StructField("chunk_path", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("start_page", T.LongType()),
        T.StructField("end_page", T.LongType()),
        T.StructField("page_count", T.LongType()),
        T.StructField("word_count", T.LongType()),
        T.StructField("char_count", T.LongType()),
        T.StructField("processed_at", T.DoubleType()),
        T.StructField("pages", T.ArrayType(PAGE_RECORD)),
    ]
)

CHUNK_DESCRIPTOR = T.StructType(
    [
        T.StructField("chunk_id", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("start_page", T.LongType()),
        T.StructField("end_page", T.LongType()),
        T.StructField("page_count", T.LongType()),
    ]
)

BOOK_DOCUMENT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("num_parts", T.LongType()),
        T.StructField("num_chunks", T.LongType()),
        T.StructField("chunks", T.ArrayType(CHUNK_RESULT)),
        T.StructField("total_pages", T.LongType()),
        T.StructField("total_word_count", T.LongType()),
    ]
)

MANIFEST_DOCUMENT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("num_parts", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("chunk_size", T.LongType()),
        T.StructField("num_chunks", T.LongType()),
        T.StructField("chunks", T.ArrayType(CHUNK_DESCRIPTOR)),
    ]
)


def required(name: str) -> Column:
    """The column ``name``, failing the job on a NULL."""
    message = F.lit(f"column {name} must not be NULL")
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))


def conform(df: DataFrame, schema: T.StructType = PAGES_TABLE) -> DataFrame:
    """Project ``df`` onto ``schema``: cast, add missing nullable columns as NULL,
    fail on a NULL where the schema forbids it (files read back are always nullable,
    so the contract has to be enforced by an expression)."""
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name not in present:
            if not field.nullable:
                raise ValueError(f"missing column {field.name}")
            value = F.lit(None)
        else:
            value = F.col(field.name) if field.nullable else required(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
