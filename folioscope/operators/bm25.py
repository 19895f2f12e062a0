"""Word search ranked by BM25, over whole lists, without scoring what cannot be a hit.

The index keeps, for every list of a term in a block of pages, the greatest number of times
and the least length, which bound the score of any page of the block. The blocks that
promise most are scored first; of the others only those whose bound reaches the ``k``-th
score are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.operators.search import DEFAULT_TOP_K, ranked
from folioscope.schemas import PAGE_KEY
from folioscope.sources.postings import DEFAULT_GROUPS, PostingTable, word_terms

K1, B = 1.2, 0.75
ROUNDING = 6
#: Blocks that are scored first; so many keys travel as literals.
FIRST_BLOCKS = 64


class WordIndex:
    """The words of the pages of a store, at ``path``. A word is a run without white space,
    in lower case; the length of a page is its number of words."""

    def __init__(self, spark: SparkSession, path: str, groups: int = DEFAULT_GROUPS):
        self.table = PostingTable(spark, path, word_terms, T.StringType(), groups)
        self.spark, self.build, self.refresh = spark, self.table.build, self.table.refresh
        self.groups_of = self.table.groups_of

    def weights(self, text: str) -> dict[str, float]:
        """The words of a query that some page holds, with their inverse frequencies; a word
        that stands twice in the query counts twice."""
        folded = self.spark.range(1).select(F.lower(F.lit(text)).alias("text")).first()["text"]
        words, times, _ = word_terms(folded)
        if not words:
            return {}
        pages, _ = self.table.totals()
        counts = self.table.counts(words)
        return {
            word: count * math.log(1 + (pages - counts[word] + 0.5) / (counts[word] + 0.5))
            for word, count in zip(words, times)
            if word in counts
        }

    def scores(self, text: str) -> DataFrame:
        """``source_file, page_number, score`` of all pages with a word of the query."""
        weights = self.weights(text)
        return self._scored(self.table.of_terms(weights), weights)

    def _parts(self, weights: dict[str, float]) -> tuple[Column, float]:
        weight = F.element_at(F.create_map(*(F.lit(x) for pair in weights.items() for x in pair)), F.col("term"))
        pages, length = self.table.totals()
        return weight, (length / pages if pages else 0.0) or 1.0

    def _scored(self, lists: DataFrame, weights: dict[str, float]) -> DataFrame:
        if not weights:
            return self.spark.createDataFrame([], "source_file string, page_number int, score double")
        weight, mean = self._parts(weights)
        entries = lists.select(
            "source_file", weight.alias("weight"), F.inline(F.arrays_zip("pages", "times", "lengths"))
        )
        found = entries.groupBy("source_file", F.col("pages").alias("page_number"))
        return found.agg(F.round(F.sum(gain("weight", "times", "lengths", mean)), ROUNDING).alias("score"))

    def bounds(self, weights: dict[str, float]) -> DataFrame:
        """``source_file, part, bound``: what no page of a block can exceed, read from the
        heads of the lists, without their arrays."""
        weight, mean = self._parts(weights)
        lists = self.table.of_terms(weights).groupBy("term", "source_file", "part")
        heads = lists.agg(F.max("most").alias("most"), F.min("least").alias("least"))
        heads = heads.withColumn("weight", weight)
        return heads.groupBy("source_file", "part").agg(F.sum(gain("weight", "most", "least", mean)).alias("bound"))

    def top_k(self, text: str, k: int = DEFAULT_TOP_K, source: str | None = None) -> DataFrame:
        """``source_file, page_number, score, rank``: the best ``k`` pages with a word of the
        query; equals by key. Scores are rounded first; a block is left out only if its
        bound, rounded up, is below the ``k``-th score, so the hits are those of all lists.
        """
        weights = self.weights(text)
        if not weights or k < 1:
            return ranked(self._scored(None, {}).limit(0), _order())
        lists, bounds = self.table.of_terms(weights), self.bounds(weights)
        if source:
            lists, bounds = (rows.filter(F.col("source_file") == source) for rows in (lists, bounds))
        head = bounds.orderBy(F.desc("bound"), "source_file", "part").limit(FIRST_BLOCKS + 1).collect()
        first = [(row["source_file"], row["part"]) for row in head[:FIRST_BLOCKS]]
        block = F.struct("source_file", "part")
        near = lists.filter(F.col("source_file").isin([s for s, _ in first])).filter(block.isin([F.struct(F.lit(s), F.lit(p)) for s, p in first]))
        best = self._scored(near, weights).orderBy(*_order()).limit(k)
        if len(head) <= FIRST_BLOCKS:
            return ranked(best, _order())
        known = best.collect()
        enough = known[-1]["score"] if len(known) == k else None
        if enough is not None:
            slack = 10.0**-ROUNDING
            bounds = bounds.filter(F.col("bound") >= enough - slack)
            if head[FIRST_BLOCKS]["bound"] < enough - slack:
                return ranked(best, _order())
        hopeful = lists.join(bounds.select("source_file", "part"), ["source_file", "part"], "left_semi")
        return ranked(self._scored(hopeful, weights).orderBy(*_order()).limit(k), _order())


def _order() -> Sequence[Column]:
    return [F.desc("score"), *[F.asc(name) for name in PAGE_KEY]]


def gain(weight: str, times: str, length: str, mean: float) -> Column:
    """What a word adds to the score of a page; grows with ``times``, falls with ``length``."""
    norm = K1 * (1 - B + B * F.col(length) / mean)
    return F.col(weight) * F.col(times) * (K1 + 1) / (F.col(times) + norm)
