"""Nearest neighbours of all rows by local joins: neighbours of neighbours are neighbours.

The first lists come from blocks of rows that several random projections put side by side.
Then, in rounds, each row brings its neighbours together, those it lists and the best of those that
list it; they are compared with one another, and all keep the best they have met. Those that
the same row brought together in the round before are not compared again, and a row that brings no
one new sits out. A round costs a fixed number of comparisons a row at most; nothing compares all
rows with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.matrices import pair_scores, round_half_up, to_matrix, unit_rows
from folioscope.functions.vectors import ROUNDING, is_finite, is_zero
from folioscope.session import scratch_path

SEED = 42
#: Neighbours kept while the graph is made, and rows that list a row brought to a join.
WIDTH, REVERSE = 24, 24
PROJECTIONS, BLOCK_ROWS = 6, 32
#: Sign bits of a projection: rows of equal bits are sorted by one more direction.
BITS = 8
MOST_ROUNDS = 8
#: Rounds end when fewer than this share of the listed neighbours is new.
LEAST_CHANGE = 0.005


def _written(rows: DataFrame, name: str) -> DataFrame:
    """The rows from the shared scratch folder: computed once, lineage cut."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _local_join(rows: DataFrame, dimension: int, width: int, blocks: bool) -> DataFrame:
    """``id, near, similarity`` of the best pairs among the rows of each group, for either end.

    ``rows`` have ``place, id, vector, floor, fresh``, groups side by side in their partitions:
    those of one place, or with ``blocks`` every ``BLOCK_ROWS`` rows. A row's pairs at or below its
    floor are left out: it has better ones; so are pairs of rows neither of which is fresh.
    """
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("near", kind), T.StructField("similarity", T.DoubleType())])

    def pairs_of(held: pa.Table) -> pa.RecordBatch:
        matrix = to_matrix(held["vector"], dimension)
        units, floor = unit_rows(matrix), held["floor"].to_numpy()
        stale = ~held["fresh"].to_numpy()
        place = np.arange(len(matrix)) // BLOCK_ROWS if blocks else held["place"].to_numpy()
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        left, right = [], []
        for start, stop in zip(starts, np.append(starts[1:], len(place))):
            scores = units[start:stop] @ units[start:stop].T
            np.fill_diagonal(scores, -2)
            known = np.flatnonzero(stale[start:stop])
            scores[known[:, None], known] = -2
            if stop - start > width:
                least = np.partition(scores, -width, axis=1)[:, -width]
                scores[scores < least[:, None]] = -2
            a, b = np.nonzero(scores > np.maximum(floor[start:stop, None], -1.5))
            left.append(a + start)
            right.append(b + start)
        a, b = np.concatenate(left), np.concatenate(right)
        ids = held["id"].combine_chunks()
        exact = round_half_up(pair_scores(matrix[a], matrix[b]), ROUNDING)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b)), pa.array(exact)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch])
            if rest is not None:
                held = pa.concat_tables([rest, held])
            if blocks:
                cut = len(held) // BLOCK_ROWS * BLOCK_ROWS
            else:  # the last group may go on
                place = held["place"].to_numpy()
                cut = int(np.searchsorted(place, place[-1])) if len(place) else 0
            if cut:
                yield pairs_of(held.slice(0, cut))
            rest = held.slice(cut)
        if rest is not None and len(rest):
            yield pairs_of(rest)

    return rows.select("place", "id", "vector", "floor", "fresh").mapInArrow(run, schema)


def _best(pairs: DataFrame, width: int) -> DataFrame:
    """The best ``width`` neighbours of each row, by similarity and then id; each once."""
    once = pairs.groupBy("id", "near").agg(F.max("similarity").alias("similarity"))
    order = Window.partitionBy("id").orderBy(F.desc("similarity"), "near")
    return once.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= width)


def _projected(vectors: DataFrame, dimension: int, number: int) -> DataFrame:
    """Rows beside others of the same sign bits and a like place on one more direction."""
    directions = np.random.default_rng([SEED, number]).normal(size=(dimension, BITS + 1))

    @F.arrow_udf("struct<bits:int,along:double>")
    def place(values: pa.Array) -> pa.Array:
        shadow = np.nan_to_num(unit_rows(to_matrix(values, dimension))) @ directions
        bits = (shadow[:, :BITS] > 0) @ (1 << np.arange(BITS))
        return pa.StructArray.from_arrays([pa.array(bits.astype(np.int32)), pa.array(shadow[:, BITS])], names=["bits", "along"])

    rows = vectors.withColumn("p", place(F.col("vector")))
    order = ["p.bits", "p.along", "id"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.select(
        F.lit(0).cast("long").alias("place"), "id", "vector", F.lit(-2.0).alias("floor"), F.lit(True).alias("fresh")
    )


def neighbour_graph(
    rows: DataFrame, key: str, k: int = 3, vector: str = "embedding", width: int = WIDTH, rounds: int = MOST_ROUNDS
) -> tuple[DataFrame, dict]:
    """``query_id, <key>, similarity, rank``: for each row with a direction its ``k`` nearest
    others, nearly always; and what it took: ``rounds``, ``rows`` and ``comparisons`` a row.

    ``key`` is one column, of any type that sorts, unique and not NULL. Vectors must have one
    length; others, and rows without a direction, take no part. A row that very many others
    list brings its best ``REVERSE`` of them together, and is itself a bounded member of each group.
    """
    present = rows.filter(F.col(vector).isNotNull() & is_finite(vector) & ~is_zero(vector))
    sizes = present.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    if len(sizes) > 1:
        raise ValueError("vectors must have one length")
    dimension, count = (sizes[0]["n"], sizes[0]["count"]) if sizes else (0, 0)
    width = max(width, k)
    vectors = _written(present.select(F.col(key).alias("id"), F.col(vector).alias("vector")), "graph-vectors")
    compared, lists = 0, None
    for number in range(PROJECTIONS):
        found = _local_join(_projected(vectors, dimension, number), dimension, width, True)
        lists = found if lists is None else lists.unionByName(found)
        compared += count * (BLOCK_ROWS - 1) // 2
    lists = _written(_best(lists, width), "graph-0")
    done, known = 0, None
    for done in range(1, rounds + 1):
        back = Window.partitionBy("near").orderBy(F.desc("similarity"), "id")
        reverse = lists.withColumn("r", F.row_number().over(back)).filter(F.col("r") <= REVERSE)
        members = (
            lists.select(F.col("id").alias("centre"), F.col("near").alias("id"))
            .union(reverse.select(F.col("near").alias("centre"), "id"))
            .union(vectors.select(F.col("id").alias("centre"), "id"))
            .distinct()
        )
        if known is not None:
            members = members.join(known.withColumn("known", F.lit(True)), ["centre", "id"], "left")
            members = members.select("centre", "id", F.col("known").isNull().alias("fresh"))
        else:
            members = members.withColumn("fresh", F.lit(True))
        members = _written(members, f"graph-members-{done}")
        known = members.select("centre", "id")
        active = members.filter("fresh").select("centre").distinct()
        floors = lists.filter(F.col("at") == width).select("id", F.col("similarity").alias("worst"))
        held = vectors.join(floors, "id", "left").select("id", "vector", F.coalesce("worst", F.lit(-2.0)).alias("floor"))
        brought = members.join(active, "centre", "left_semi")
        size = brought.groupBy("centre").agg(F.count(F.lit(1)).alias("m"), F.count_if(~F.col("fresh")).alias("o"))
        compared += size.agg(F.sum(F.expr("m * (m - 1) div 2 - o * (o - 1) div 2"))).first()[0] or 0
        met = brought.join(held, "id").withColumn("place", F.xxhash64("centre"))
        side_by_side = met.repartition("place").sortWithinPartitions("place", "id")
        found = _local_join(side_by_side, dimension, width, False)
        before = lists.select("id", "near", F.lit(1).alias("old"))
        lists = _written(_best(found.unionByName(lists.select(*found.columns)), width), f"graph-{done}")
        new = lists.join(before, ["id", "near"], "left").agg(F.count_if(F.col("old").isNull())).first()[0]
        if new <= LEAST_CHANGE * count * width:
            break
    best = lists.filter(F.col("at") <= k).select(
        F.col("id").alias("query_id"), F.col("near").alias(key), "similarity", F.col("at").cast("long").alias("rank")
    )
    return best, {"rounds": done, "rows": count, "comparisons": compared / max(count, 1)}
