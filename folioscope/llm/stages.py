"""The stages of the corpus pipeline, each one operator whose decisions take effect."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import bpe, decontaminate, resemblance, simhash
from folioscope.llm import language as languages
from folioscope.llm import secrets as credentials
from folioscope.llm.common import table


def language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop texts without a letter and texts whose language no one can tell."""
    return languages.with_known_language(docs, languages.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near copies: 0.8 of their five-word shingles."""
    return simhash.one_of_each(docs, grouped=resemblance.near_copies)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drop documents that leak an item of ``benchmark``."""
    return decontaminate.without_leaks(docs, table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Blank live credentials; widely copied examples stay."""
    return credentials.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document: ``doc_id, n_tokens, ids``."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN)
