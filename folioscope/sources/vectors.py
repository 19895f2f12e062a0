"""Vectors kept by the content of their text: a text is embedded once, however often it comes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import or_empty

KEPT = T.StructType([T.StructField("digest", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


class VectorCache:
    """Vectors by the SHA-256 of their text, at ``path``; for one model.

    Texts of one digest are reduced to one before any text is shuffled further, and only those
    without a vector reach the model. New vectors are appended; a write that is repeated
    after a failure may add a vector again, which readers reduce to one.
    """

    def __init__(self, spark: SparkSession, path: str, embed: Callable[[str], Column]):
        self.spark, self.path, self.embed = spark, path.rstrip("/"), embed

    def kept(self) -> DataFrame:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], KEPT)
        return self.spark.read.schema(KEPT).parquet(self.path)

    def learn(self, texts: DataFrame, text: str = "text") -> None:
        """Embed the distinct texts that have no vector yet."""
        rows = texts.select(F.sha2(or_empty(text), 256).alias("digest"), or_empty(text).alias("text"))
        unseen = rows.join(self.kept().select("digest"), "digest", "left_anti")
        once = unseen.groupBy("digest").agg(F.first("text").alias("text"))
        vectors = once.select("digest", self.embed("text").cast(KEPT["embedding"].dataType).alias("embedding"))
        vectors.write.mode("append").parquet(self.path)

    def embedded(self, rows: DataFrame, text: str = "text") -> DataFrame:
        """``rows`` with ``embedding``, from the kept vectors after :meth:`learn`.

        Vectors meet the rows by digest. A text that very many rows share is one row on its
        side of the join and a skewed key on the other, which adaptive execution splits.
        """
        self.learn(rows, text)
        vectors = self.kept().groupBy("digest").agg(F.first("embedding").alias("embedding"))
        keyed = rows.withColumn("digest", F.sha2(or_empty(text), 256))
        return keyed.join(vectors, "digest").select(*rows.columns, "embedding")
