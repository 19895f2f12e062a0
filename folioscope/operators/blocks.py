"""Exact top-k for many query vectors, by blocks of matrix products.

Each task multiplies blocks of its rows with a matrix of queries and keeps the best
``k`` rows per query, so it emits at most ``queries * k`` rows, never all pairs; one
window over those picks the final hits. Which way the queries travel is an argument, and
the hits are the same:

* without ``blocks`` the queries are fetched and sent with the tasks; vectors of more than
  ``MAX_QUERY_BYTES`` in all are refused;
* with ``blocks=(q, r)`` queries are cut into q blocks and rows into r, and every pair of
  blocks meets in one cogroup. :func:`blocks_for` sizes them.

Matrix products only preselect, with a margin. The scores of the rows that are left come
from the same expression as in a search with one query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.matrices import pair_scores, round_half_up, to_matrix, unit_rows
from folioscope.functions.vectors import ROUNDING
from folioscope.operators.search import DEFAULT_TOP_K, rank_order
from folioscope.schemas import PAGE_KEY

MAX_QUERY_BYTES = 64 << 20
BLOCK_CELLS = 1 << 20
BLOCK_QUERIES = 4096
CELL_ROWS = 1 << 16
#: Rows that are held as doubles, and candidates that are scored, at a time.
STEP_ROWS, STEP_PAIRS = 1 << 13, 1 << 14
# Preselected scores may be off by rounding to ROUNDING places, and by a little more.
SLACK = 1.1 * 10.0**-ROUNDING


class _Best:
    """The best ``k`` rows so far for each of some queries of equal length."""

    def __init__(self, block: pa.Table, k: int, key: Sequence[str], threshold, source: str | None):
        self.queries = to_matrix(block["__query_vector"], pc.list_value_length(block["__query_vector"])[0].as_py() or 0)
        self.units = unit_rows(self.queries).T
        self.ids = block["query_id"].combine_chunks()
        self.k, self.key, self.threshold, self.source = k, list(key), threshold, source
        self.wanted = block["__query_source"].combine_chunks() if source else None
        self.floor = np.full(len(self.ids), -np.inf)
        self.kept: pa.Table | None = None

    def add(self, keys: pa.Table, vectors: pa.Array) -> None:
        step = min(STEP_ROWS, max(1, BLOCK_CELLS // max(1, len(self.ids))))
        for start in range(0, len(vectors), step):
            self._add_block(keys.slice(start, step), to_matrix(vectors.slice(start, step), self.queries.shape[1]))

    def _allowed(self, keys: pa.Table) -> np.ndarray | None:
        """Rows x queries: is the row of the source that the query asks for?"""
        if self.wanted is None:
            return None
        named = pc.fill_null(self.wanted, "")
        mine = pc.index_in(keys[self.source], value_set=named.unique())
        row = pc.fill_null(mine, -1).to_numpy()[:, None]
        return (row == pc.index_in(named, value_set=named.unique()).to_numpy()[None, :]) | (
            pc.equal(named, "").to_numpy(zero_copy_only=False)[None, :]
        )

    def _add_block(self, keys: pa.Table, matrix: np.ndarray) -> None:
        if self.queries.shape[1]:
            exact = unit_rows(matrix) @ self.units
            np.copyto(exact, -np.inf, where=np.isnan(exact))
        else:
            exact = np.full((len(matrix), len(self.ids)), -np.inf)
        allowed = self._allowed(keys)
        candidates = exact >= self.floor - SLACK
        if allowed is not None:
            np.copyto(exact, -np.inf, where=~allowed)
        if np.count_nonzero(candidates) > 4 * self.k * len(self.ids) and len(exact) > self.k:
            # A row clearly below the k-th best of its own block is not among the best.
            candidates &= exact >= np.partition(exact, -self.k, axis=0)[-self.k] - SLACK
        if allowed is not None:
            candidates &= allowed
        row, query = np.nonzero(candidates)
        # Rows that tie for the last place are all candidates, so there may be very many.
        scores = np.concatenate(
            [
                pair_scores(matrix[row[at : at + STEP_PAIRS]], self.queries[query[at : at + STEP_PAIRS]])
                for at in range(0, max(len(row), 1), STEP_PAIRS)
            ]
        )
        if self.threshold is not None:
            good = scores >= self.threshold
            row, query, scores = row[good], query[good], scores[good]
        if not len(row):
            return
        scores = np.where(np.isnan(scores), -np.inf, round_half_up(scores, ROUNDING))
        found = keys.select(self.key).take(pa.array(row))
        found = found.append_column("__query", pa.array(query))
        found = found.append_column("__score", pa.array(scores))
        if self.kept is not None:
            found = pa.concat_tables([self.kept, found])
        order = [("__query", "ascending"), ("__score", "descending")]
        found = found.sort_by(order + [(name, "ascending") for name in self.key])
        query = found["__query"].to_numpy()
        first = np.searchsorted(query, query, side="left")
        position = np.arange(len(query)) - first
        self.kept = found.take(pa.array(np.flatnonzero(position < self.k))).combine_chunks()
        last = np.flatnonzero(position == self.k - 1)
        self.floor[query[last]] = found["__score"].to_numpy()[last]

    def result(self) -> pa.RecordBatch | None:
        if self.kept is None:
            return None
        score = self.kept["__score"].to_numpy()
        columns = [self.ids.take(self.kept["__query"].combine_chunks())]
        columns += [self.kept[name].combine_chunks() for name in self.key]
        columns += [pa.array(score, mask=np.isneginf(score))]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", *self.key, "similarity"])


def _by_length(block: pa.Table) -> list[pa.Table]:
    """Queries of different lengths apart, each against all rows: none spoils another."""
    lengths = pc.fill_null(pc.list_value_length(block["__query_vector"]), -1)
    return [block.filter(pc.equal(lengths, length)) for length in pc.unique(lengths)]


def _bests(block: pa.Table, k, key, threshold, source) -> list[_Best]:
    return [_Best(part, k, key, threshold, source) for part in _by_length(block)]


def blocks_for(rows: DataFrame, queries: DataFrame) -> tuple[int, int]:
    """Blocks of queries and of rows of a bounded size; counts both."""
    return -(-queries.count() // BLOCK_QUERIES) or 1, -(-rows.count() // CELL_ROWS) or 1


def result_schema(rows: DataFrame, queries: DataFrame, key: Sequence[str], query_id: str) -> T.StructType:
    return T.StructType(
        [T.StructField("query_id", queries.schema[query_id].dataType)]
        + [T.StructField(name, rows.schema[name].dataType) for name in key]
        + [T.StructField("similarity", T.DoubleType())]
    )


def batch_top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_TOP_K,
    threshold: float | None = None,
    key: Sequence[str] = PAGE_KEY,
    query_id: str = "query_id",
    vector: str = "embedding",
    source: str | None = None,
    source_column: str = "source_file",
    blocks: tuple[int, int] | str | None = None,
) -> DataFrame:
    """``(query_id, *key, similarity, rank)``: the best ``k`` rows for each query.

    ``blocks="auto"`` takes :func:`blocks_for` where the queries are too large to travel.

    ``source`` names a column of ``queries``: the source that a query is limited to (NULL
    or empty: none). A query whose vector has another length than a row's, or none, has
    no similarity with it.
    """
    key = list(key)
    schema = result_schema(rows, queries, key, query_id)
    if k < 1:
        return rows.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0).cast("long"))
    asked = [F.col(query_id).alias("query_id"), F.col(vector).alias("__query_vector")]
    if source:
        asked.append(F.col(source).cast("string").alias("__query_source"))
    questions = queries.select(*asked)
    names = list(dict.fromkeys([*key, *([source_column] if source else [])]))
    table = rows.select(*names, F.col(vector).alias("__vector"))
    options = (k, key, threshold, source_column if source else None)
    if blocks == "auto":
        blocks = None if _bytes(questions) <= MAX_QUERY_BYTES else blocks_for(rows, queries)
    if blocks is None:
        best = _scan(table, questions, options, schema)
    else:
        best = _meet(table, questions, options, schema, *blocks)
    window = Window.partitionBy("query_id").orderBy(*rank_order(key))
    return best.withColumn("rank", F.row_number().over(window).cast("long")).filter(F.col("rank") <= k)


def _bytes(questions: DataFrame) -> int:
    return questions.agg(F.sum(F.size("__query_vector").cast("long") * 8 + 64)).first()[0] or 0


def fetched(questions: DataFrame) -> pa.Table:
    """The queries on the driver, after a look at their size."""
    size = _bytes(questions)
    if size > MAX_QUERY_BYTES:
        raise ValueError(f"{size} bytes of query vectors: pass blocks, for example blocks_for(rows, queries)")
    return questions.toArrow()


def _scan(table, questions, options, schema) -> DataFrame:
    block = fetched(questions)

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = _bests(block, *options)
        for batch in batches:
            keys = pa.Table.from_batches([batch]).drop_columns(["__vector"])
            for best in bests:
                best.add(keys, batch.column("__vector"))
        yield from filter(None, (best.result() for best in bests))

    return table.mapInArrow(local_best, schema)


def _meet(table, questions, options, schema, query_blocks, row_blocks) -> DataFrame:
    key = options[1]
    left = table.withColumns(
        {
            "__row_block": F.pmod(F.xxhash64(*key), F.lit(row_blocks)).cast("long"),
            "__query_block": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")),
        }
    )
    right = questions.withColumns(
        {
            "__query_block": F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("long"),
            "__row_block": F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)).cast("array<long>")),
        }
    )
    return meet(left, right, options, schema)


def meet(left: DataFrame, right: DataFrame, options, schema: T.StructType) -> DataFrame:
    """The best rows for the queries of the same ``(__row_block, __query_block)``."""
    key = options[1]

    def cell_best(rows: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and block.num_rows:
            keys = rows.drop_columns(["__vector"])
            for best in _bests(block, *options):
                best.add(keys, rows["__vector"])
                found.append(best.result())
        batches = [*filter(None, found)]
        if batches:
            return pa.Table.from_batches(batches)
        kinds = [block["query_id"].type, *[rows[name].type for name in key], pa.float64()]
        names = ["query_id", *key, "similarity"]
        return pa.table([pa.array([], kind) for kind in kinds], names=names)

    cells = ["__row_block", "__query_block"]
    return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(cell_best, schema)
