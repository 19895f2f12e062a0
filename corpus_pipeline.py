"""A corpus, prepared for training in stages.

``STAGES`` lists name and function of each stage. A function takes the session, the
documents that the stage before kept, and the folder of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import stages
from folioscope.session import scratch_path

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secrets", stages.secrets),
    ("tokens", stages.tokens),
]

#: Trained models, fingerprints and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{at}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
