"""Approximate search over vectors of a few bytes, with exact scores for a shortlist.

A direction is cut into subspaces, and each part is replaced by the number of the nearest
of 256 centres: one byte. The product of a query with all centres is a small table, so the
score of a row is a sum of look-ups. The rows that score best are read whole and ranked
exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.matrices import pair_scores, round_half_up, to_matrix, unit_rows
from folioscope.functions.vectors import ROUNDING
from folioscope.operators.blocks import fetched
from folioscope.operators.search import DEFAULT_TOP_K, rank_order, top_k
from folioscope.schemas import PAGE_KEY

SUBSPACES, CENTRES = 16, 256
SEED = 42
#: Centres are fitted on so many rows at most, taken at random; all rows are indexed.
FIT_ROWS = 20_000
FIT_ROUNDS = 12
#: Rows that are scored exactly for a query.
SHORTLIST = 300
#: Codes that a task compares with the queries at a time, and hits that it hands on at a time.
HELD_CODES, HELD_HITS = 1 << 18, 1 << 16
#: Rows of a page of the vector files, so that a look-up by key reads little else.
PAGE_ROWS = 256


def fit_centres(rows: np.ndarray, count: int = CENTRES) -> np.ndarray:
    """``count`` centres of the rows by k-means from a random start; fewer rows are repeated."""
    rng = np.random.default_rng(SEED)
    centres = rows[rng.permutation(len(rows))[:count]] if len(rows) >= count else np.resize(rows, (count, rows.shape[1]))
    for _ in range(FIT_ROUNDS):
        nearest = nearest_centres(rows, centres)
        size = np.bincount(nearest, minlength=count)
        sums = np.stack([np.bincount(nearest, column, count) for column in rows.T], axis=1)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest_centres(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def bounds(dimension: int, subspaces: int) -> list[int]:
    return [dimension * at // subspaces for at in range(subspaces + 1)]


def encode(matrix: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """Codes of the directions of the rows; rows without one get zeros."""
    units = np.nan_to_num(unit_rows(matrix))
    ends = bounds(matrix.shape[1], len(books))
    parts = [nearest_centres(units[:, a:b], book) for a, b, book in zip(ends, ends[1:], books)]
    return np.stack(parts, axis=1).astype(np.uint8)


def look_ups(query: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """For each subspace the products of the query's part with all centres."""
    ends = bounds(len(query), len(books))
    return np.stack([book @ query[a:b] for a, b, book in zip(ends, ends[1:], books)])


def approximate(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The approximate products of rows with a query, from its table."""
    return reduce(np.add, (table[at][codes[:, at]] for at in range(len(table))))


def code_matrix(codes: pa.Array, subspaces: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes as rows, and which rows have one."""
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    known = codes.is_valid().to_numpy(zero_copy_only=False)
    held = codes.drop_null().cast(pa.binary())
    matrix = np.zeros((len(codes), subspaces), np.uint8)
    if len(held):  # the bytes of all codes lie one after the other
        ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
        matrix[known] = np.frombuffer(held.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, subspaces)
    return matrix, known


class CodeIndex:
    """Codes and vectors of rows, at ``path``.

    A search reads all codes, a byte a subspace, and the vectors of the shortlist: of these
    it reads the file pages that have them, as the vectors are stored in order of the key, in
    small pages. Rows without a direction have no code; they are last in any ranking, and
    no search through codes finds them.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str] = PAGE_KEY, vector: str = "embedding"):
        self.spark, self.path, self.key, self.vector = spark, path.rstrip("/"), list(key), vector
        rows = spark.read.parquet(f"{self.path}/centres").orderBy("subspace", "centre").collect()
        books: dict[int, list] = {}
        for row in rows:
            books.setdefault(row["subspace"], []).append(row["values"])
        self.books = [np.array(books[at]) for at in sorted(books)]
        self.dimension = sum(book.shape[1] for book in self.books)

    @classmethod
    def build(
        cls,
        rows: DataFrame,
        path: str,
        key: Sequence[str] = PAGE_KEY,
        vector: str = "embedding",
        subspaces: int = SUBSPACES,
        fit_rows: int = FIT_ROWS,
    ) -> CodeIndex:
        """Write the vectors in order of the key, fit the centres and write the codes."""
        spark, path = rows.sparkSession, path.rstrip("/")
        (
            rows.select(*key, vector)
            .repartitionByRange(*key)
            .sortWithinPartitions(*key)
            .write.mode("overwrite")
            .option("parquet.page.row.count.limit", PAGE_ROWS)
            .parquet(f"{path}/vectors")
        )
        stored = spark.read.parquet(f"{path}/vectors")
        count = stored.count()
        some = stored.select(vector).filter(F.size(vector) > 0)
        sample = some.sample(min(1.0, 1.2 * fit_rows / max(count, 1)), seed=SEED).limit(fit_rows).toArrow()
        sizes = [len(value) for value in sample.column(vector).to_pylist()]
        dimension = max(sizes, key=sizes.count, default=subspaces)
        units = unit_rows(to_matrix(sample.column(vector), dimension))
        units = units[~np.isnan(units).any(axis=1)]
        if not len(units):
            units = np.zeros((1, dimension))
        ends = bounds(dimension, min(subspaces, dimension))
        centres = [
            (at, centre, [float(x) for x in values])
            for at, (a, b) in enumerate(zip(ends, ends[1:]))
            for centre, values in enumerate(fit_centres(units[:, a:b]))
        ]
        schema = "subspace int, centre int, values array<double>"
        spark.createDataFrame(centres, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
        index = cls(spark, path, key, vector)
        index._encoded(stored).write.mode("overwrite").parquet(f"{path}/codes")
        return index

    def add(self, rows: DataFrame) -> None:
        """Index further rows with the centres there are."""
        staged = rows.select(*self.key, self.vector).repartitionByRange(*self.key).sortWithinPartitions(*self.key)
        known = self.spark.read.parquet(f"{self.path}/vectors").schema
        path = f"{self.path}/added"
        staged.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)
        more = self.spark.read.schema(known).parquet(path)
        more.write.mode("append").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(f"{self.path}/vectors")
        self._encoded(more).write.mode("append").parquet(f"{self.path}/codes")

    def _encoded(self, rows: DataFrame) -> DataFrame:
        books, dimension = self.books, self.dimension

        @F.arrow_udf("binary")
        def code(vectors: pa.Array) -> pa.Array:
            matrix = to_matrix(vectors, dimension)
            lost = np.isnan(unit_rows(matrix)).any(axis=1)
            codes = encode(np.nan_to_num(matrix), books)
            return pa.array([None if gone else row.tobytes() for row, gone in zip(codes, lost)], pa.binary())

        return rows.select(*self.key, code(F.col(self.vector)).alias("code"))

    @property
    def codes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/codes")

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def _direction(self, query: Sequence[float]) -> np.ndarray:
        value = np.asarray(query, float)
        if len(value) != self.dimension:
            raise ValueError(f"expected {self.dimension} dimensions, not {len(value)}")
        return value / (np.sqrt(value @ value) or 1.0)

    def shortlist(self, query: Sequence[float], size: int = SHORTLIST) -> DataFrame:
        """The keys of the ``size`` rows with the best approximate scores."""
        table, subspaces = look_ups(self._direction(query), self.books), len(self.books)

        @F.arrow_udf("double")
        def score(codes: pa.Array) -> pa.Array:
            matrix, known = code_matrix(codes, subspaces)
            return pa.array(approximate(matrix, table), mask=~known)

        scored = self.codes.select(*self.key, score(F.col("code")).alias("approximate")).filter("approximate IS NOT NULL")
        return scored.orderBy(F.desc("approximate"), *self.key).limit(size).select(*self.key)

    def top_k(self, query: Sequence[float], k: int = DEFAULT_TOP_K, shortlist: int = SHORTLIST, **options) -> DataFrame:
        """As :func:`folioscope.operators.search.top_k`, over a shortlist of rows."""
        keys = self.shortlist(query, max(shortlist, k)).collect()
        rows = self.vectors.filter(one_of(self.key, [tuple(row) for row in keys]))
        return top_k(rows, query, k, key=self.key, vector=self.vector, **options)

    def batch_top_k(
        self, queries: DataFrame, k: int = DEFAULT_TOP_K, shortlist: int = SHORTLIST, query_id: str = "query_id"
    ) -> DataFrame:
        """``(query_id, *key, similarity, rank)``: the same for each row of ``queries`` (up to 64 MB
        of vectors). Each task tells a shortlist a query of some codes at a time; the best of
        these meet their vectors. Codes are held, of 16 bytes, not what was found for all queries."""
        asked = queries.select(F.col(query_id).alias("query_id"), F.col(self.vector).alias("__query_vector"))
        block = fetched(asked)
        ids = block["query_id"].combine_chunks()
        units = np.nan_to_num(unit_rows(to_matrix(block["__query_vector"], self.dimension)))
        key, books, subspaces, size = self.key, self.books, len(self.books), max(shortlist, k)
        names = ["query_id", *key, "approximate"]
        codes = self.codes
        schema = T.StructType(
            [
                T.StructField("query_id", queries.schema[query_id].dataType),
                *(codes.schema[name] for name in key),
                T.StructField("approximate", T.DoubleType()),
            ]
        )

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0
            for batch in batches:
                held.append(batch)
                count += len(batch)
                if count >= HELD_CODES:
                    yield from hits(pa.Table.from_batches(held))
                    held, count = [], 0
            if count:
                yield from hits(pa.Table.from_batches(held))

        def hits(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            matrix, known = code_matrix(rows["code"], subspaces)
            matrix, places = matrix[known], np.flatnonzero(known)
            keys = rows.select(key).combine_chunks()
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

            def told() -> pa.RecordBatch:
                own, place, scores = map(np.concatenate, zip(*found))
                found.clear()
                taken = keys.take(pa.array(place))
                columns = [taken[name].combine_chunks() for name in key]
                return pa.RecordBatch.from_arrays([ids.take(pa.array(own)), *columns, pa.array(scores)], names=names)

            for at, unit in enumerate(units):
                scores = approximate(matrix, look_ups(unit, books))
                few = np.arange(len(scores))
                if len(scores) > size:  # of equals the first, which have the lowest keys
                    last = np.partition(scores, -size)[-size]
                    above = np.flatnonzero(scores > last)
                    few = np.append(above, np.flatnonzero(scores == last)[: size - len(above)])
                found.append((np.full(len(few), at), places[few], scores[few]))
                if size * len(found) >= HELD_HITS:
                    yield told()
            if found:
                yield told()

        order = Window.partitionBy("query_id").orderBy(F.desc("approximate"), *key)
        listed = codes.mapInArrow(best, schema).withColumn("__at", F.row_number().over(order)).filter(F.col("__at") <= size)
        met = listed.select("query_id", *key).join(self.vectors, key).join(asked, "query_id")

        @F.arrow_udf("double")
        def exact(vectors: pa.Array, questions: pa.Array) -> pa.Array:
            dimension = self_dimension
            scores = pair_scores(to_matrix(vectors, dimension), to_matrix(questions, dimension))
            return pa.array(np.where(np.isnan(scores), 0, round_half_up(scores, ROUNDING)), mask=np.isnan(scores))

        self_dimension = self.dimension
        scored = met.select("query_id", *key, exact(F.col(self.vector), F.col("__query_vector")).alias("similarity"))
        window = Window.partitionBy("query_id").orderBy(*rank_order(key))
        return scored.withColumn("rank", F.row_number().over(window).cast("long")).filter(F.col("rank") <= k)


def one_of(key: Sequence[str], values: Sequence[tuple]) -> Column:
    """A condition on the key that scans can use. Of one column it is a list: it reaches the
    file pages whole if ``spark.sql.parquet.pushdown.inFilterThreshold`` allows that many
    values, else by its ends. Of several columns it is a balanced tree of equalities."""
    if not values:
        return F.lit(False)
    if len(key) == 1:
        return F.col(key[0]).isin([value for (value,) in values])
    tests = [reduce(lambda a, b: a & b, (F.col(name) == v for name, v in zip(key, value))) for value in values]
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[at : at + 2]) for at in range(0, len(tests), 2)]
    return tests[0]
