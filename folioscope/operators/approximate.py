"""Approximate search and topics, by clusters of directions (``pyspark.ml``)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions.matrices import to_matrix, unit_rows
from folioscope.functions.text import words
from folioscope.functions.vectors import is_finite, is_zero, normalize
from folioscope.operators.blocks import BLOCK_QUERIES, CELL_ROWS, meet, result_schema
from folioscope.operators.search import DEFAULT_TOP_K, rank_order, ranked, top_k
from folioscope.schemas import PAGE_KEY

SEED = 42
#: Cells are fitted on about so many rows, taken at random; all rows are indexed.
FIT_ROWS = 100_000
#: Words of a topic are ranked in so many shares first.
SHARES = 64
#: Rows without a direction are in a cell of their own.
NO_CELL = -1


def unit_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with a direction, with ``unit``: the vector at unit length."""
    present = rows.filter(F.col(vector).isNotNull() & is_finite(vector) & ~is_zero(vector))
    return present.withColumn("unit", array_to_vector(normalize(vector).cast("array<double>")))


def recall(approximate: DataFrame, exact: DataFrame, key: Sequence[str] = PAGE_KEY) -> DataFrame:
    """Share of the exact hits that the approximate hits contain."""
    found = exact.select(*key).join(
        approximate.select(*key, F.lit(1).alias("found")), list(key), "left"
    )
    return found.agg(F.avg(F.coalesce("found", F.lit(0))).alias("recall"))


def _fit(rows: DataFrame, k: int, vector: str, name: str, fit_rows: int) -> KMeansModel:
    share = fit_rows / max(1, rows.count())
    units = unit_vectors(rows, vector).select("unit").sample(min(1.0, share), seed=SEED)
    units = units.persist()  # the fit passes over its rows many times
    try:
        return KMeans(k=k, seed=SEED, featuresCol="unit", predictionCol=name).fit(units)
    finally:
        units.unpersist()


def nearest_cells(vector: Column | str, centres: np.ndarray, probes: int) -> Column:
    """The numbers of the nearest cells, nearest first; ``NO_CELL`` without a direction."""

    @F.arrow_udf("array<int>")
    def cells(vectors: pa.Array) -> pa.Array:
        units = unit_rows(to_matrix(vectors, centres.shape[1]))
        distance = ((centres**2).sum(axis=1) - 2 * units @ centres.T).argsort(axis=1, kind="stable")
        missing = np.isnan(units).any(axis=1)
        lists = [[NO_CELL] if lost else row[:probes] for row, lost in zip(distance, missing)]
        return pa.array(lists, pa.list_(pa.int32()))

    return cells(F.col(vector) if isinstance(vector, str) else vector)


class CellIndex:
    """Vectors clustered into cells, one directory per cell.

    A search looks at the ``probes`` cells whose centres are nearest to the query and
    ranks their rows exactly; the other directories are not read. Hits in other cells
    are missed, unless all cells are probed: then the hits are those of the exact search.
    Large cells are written as several files. New rows are added to the cells as they
    are; build anew when the directions have shifted.
    """

    def __init__(self, spark: SparkSession, path: str, vector: str = "embedding"):
        self.spark, self.path, self.vector = spark, path.rstrip("/"), vector
        self.centres = np.array(KMeansModel.load(f"{self.path}/model").clusterCenters())

    @classmethod
    def build(
        cls, rows: DataFrame, path: str, cells: int, vector: str = "embedding", fit_rows: int = FIT_ROWS
    ) -> CellIndex:
        _fit(rows, cells, vector, "cell", fit_rows).write().overwrite().save(f"{path}/model")
        index = cls(rows.sparkSession, path, vector)
        index._write(rows, "overwrite")
        return index

    load = classmethod(lambda cls, spark, path, vector="embedding": cls(spark, path, vector))

    def add(self, rows: DataFrame) -> None:
        """Put further rows into the cells."""
        self._write(rows, "append")

    def _write(self, rows: DataFrame, mode: str) -> None:
        placed = rows.withColumn("cell", nearest_cells(self.vector, self.centres, 1)[0])
        writer = placed.hint("rebalance", "cell").write.mode(mode)
        writer.partitionBy("cell").parquet(f"{self.path}/cells")

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def top_k(
        self, query: Sequence[float], k: int = DEFAULT_TOP_K, probes: int = 1, **options
    ) -> DataFrame:
        """As :func:`folioscope.operators.search.top_k`, over the probed cells."""
        rows = self.rows
        if probes < len(self.centres):
            direction = np.asarray(query, dtype=float)
            direction = direction / (np.sqrt(direction @ direction) or 1.0)
            distance = ((self.centres - direction) ** 2).sum(axis=1)
            near = [int(cell) for cell in np.argsort(distance, kind="stable")[:probes]]
            rows = rows.filter(F.col("cell").isin(near))
        return top_k(rows, query, k, vector=self.vector, **options).drop("cell")

    def batch_top_k(
        self,
        queries: DataFrame,
        k: int = DEFAULT_TOP_K,
        probes: int = 1,
        threshold: float | None = None,
        key: Sequence[str] = PAGE_KEY,
        query_id: str = "query_id",
        parts: int | None = None,
    ) -> DataFrame:
        """As :func:`folioscope.operators.blocks.batch_top_k`, each query over its
        ``probes`` nearest cells.

        Rows and queries meet by cell, so a table is compared with itself without
        comparing all its rows. Every cell is cut into parts of about ``CELL_ROWS`` rows, into
        ``parts`` at least, and the queries that probe it into blocks of about ``BLOCK_QUERIES``;
        each part meets each block on its own, so no task holds a whole cell or all queries.
        """
        key, rows = list(key), self.rows
        schema = result_schema(rows, queries, key, query_id)
        left = rows.select(*key, F.col(self.vector).alias("__vector"), F.col("cell").alias("__row_block"))
        asked = queries.select(
            F.col(query_id).alias("query_id"),
            F.col(self.vector).alias("__query_vector"),
            F.explode(nearest_cells(self.vector, self.centres, probes)).alias("__row_block"),
        )
        in_parts = _cuts(left, CELL_ROWS, parts or 1)
        in_blocks = _cuts(asked.select("__row_block"), BLOCK_QUERIES, 1)

        def everywhere(count: Column) -> Column:
            return F.explode(F.sequence(F.lit(0), count - 1).cast("array<long>"))

        # One number for a part of a cell and a block of its queries.
        left = left.withColumn("__part", F.pmod(F.xxhash64(*key), in_parts)).withColumn("__block", everywhere(in_blocks))
        asked = asked.withColumn("__block", F.pmod(F.xxhash64("query_id"), in_blocks)).withColumn("__part", everywhere(in_parts))
        number = (F.col("__part") * in_blocks + F.col("__block")).cast("long")
        left, asked = (side.withColumn("__query_block", number).drop("__part", "__block") for side in (left, asked))
        best = meet(left, asked, (k, key, threshold, None), schema)
        window = Window.partitionBy("query_id").orderBy(*rank_order(key))
        return best.withColumn("rank", F.row_number().over(window).cast("long")).filter(F.col("rank") <= k)


def _cuts(rows: DataFrame, most: int, least: int) -> Column:
    """Into how many of about ``most`` rows each ``__row_block`` is cut, ``least`` at least."""
    sizes = rows.groupBy("__row_block").count().collect()  # a row for each cell
    cut = [(row["__row_block"], max(least, -(-row["count"] // most))) for row in sizes] or [(NO_CELL, least)]
    cuts = F.create_map(*(F.lit(x) for pair in cut for x in pair))
    return F.coalesce(F.element_at(cuts, F.col("__row_block").cast("int")), F.lit(least))


def topics(rows: DataFrame, k: int, vector: str = "embedding") -> tuple[DataFrame, list[list[float]]]:
    """Rows with ``topic``, their cluster by direction (rows without one are left out),
    and the centres of the ``k`` topics in order. Centres are fitted on a bounded sample,
    all rows are placed."""
    model = _fit(rows, k, vector, "topic", FIT_ROWS)
    centres = [[float(x) for x in centre] for centre in model.clusterCenters()]
    return model.transform(unit_vectors(rows, vector)).drop("unit"), centres


def topic_words(texts: DataFrame, k: int, topic: str = "topic", text: str = "text") -> DataFrame:
    """``topic, word, weight, rank``: the ``k`` words that mark each topic.

    The weight is the word's share of the topic's words, times ``ln(1 + mean / all)`` of the mean
    number of words of a topic and the word's number in all. Words are in lower case; they
    are counted once, by topic, and everything else comes from these counts. Equals by word.
    """
    found = texts.select(F.col(topic).alias("topic"), F.explode(words(F.lower(F.col(text)))).alias("word"))
    counts = found.groupBy("topic", "word").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("topic").agg(F.sum("n").alias("size"))
    everywhere = counts.groupBy("word").agg(F.sum("n").alias("all"))
    mean = sizes.agg(F.avg("size")).first()[0] or 0.0
    weight = F.col("n") / F.col("size") * F.log1p(F.lit(mean) / F.col("all"))
    weighed = counts.join(everywhere, "word").join(sizes, "topic").select("topic", "word", F.round(weight, 9).alias("weight"))
    share = F.pmod(F.xxhash64("word"), F.lit(SHARES))
    order = [F.desc("weight"), F.asc("word")]
    some = ranked(weighed.withColumn("share", share), order, per=["topic", "share"]).filter(F.col("rank") <= k)
    return ranked(some.drop("rank", "share"), order, per=["topic"]).filter(F.col("rank") <= k)
