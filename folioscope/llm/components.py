"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import settled


def _down(links: DataFrame) -> DataFrame:
    """Links to another node, each from the larger to the smaller."""
    return links.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )


def _both(links: DataFrame) -> DataFrame:
    """Each link from either end; a second branch of the plan would read all twice."""
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return links.select(F.explode(ends).alias("x")).select("x.u", "x.v")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbours."""
    both = _both(links)
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    joined = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them; links go down."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    linked = F.explode(F.array("u", "v")).alias("u")
    return links.join(least, "u").select(linked, F.col("least").alias("v")).filter(F.col("u") != F.col("v"))


def _not_stars(links: DataFrame) -> DataFrame:
    """Nodes with a smaller neighbour and another one."""
    down = F.count(F.when(F.col("v") < F.col("u"), 1))
    return _both(links).groupBy("u").agg(down.alias("down"), F.count(F.lit(1)).alias("n")).filter("down > 0 and n > 1")


def roots(links: DataFrame) -> DataFrame:
    """``u, v``: each node that is not the least of its component, and that least node.

    ``links`` has two columns ``u`` and ``v`` of one orderable type. The two star steps
    alternate until all components are stars; minima are taken with map-side combine, and a
    node with very many links is a skewed join key, which adaptive execution splits.
    """
    current = settled(_down(links))
    while True:
        current = settled(_small_star(_large_star(current)).distinct())
        if not _not_stars(current).head(1):
            return current
