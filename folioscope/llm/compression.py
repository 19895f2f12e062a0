"""Quality by compression: does a text compress better beside good text or beside bad?

Two zstandard dictionaries hold raw labelled text, one good, one bad. A text is cut into
windows of even size, each is compressed with either dictionary, and the difference of the
summed sizes, as a share of the larger, is the evidence. A logistic curve, fitted on
labelled texts that are in no dictionary, turns it into a score; it also sees how far the
text compresses at all, as windows that shrink to nothing leave no difference to measure,
and the length, as short texts leave little.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import strings, whole

LEVEL = 9
#: Bytes of a window, about.
WINDOW = 500
#: Bytes of a dictionary, and of one text in it at most; the excerpt comes from its windows
#: at even distances.
DICTIONARY_BYTES = 1 << 19
EXCERPT_BYTES = 600
#: At most so many labelled rows of each class fill a dictionary, and as many of both
#: classes fit the curve.
DICTIONARY_ROWS = DICTIONARY_BYTES // EXCERPT_BYTES
CURVE_ROWS = 4000
#: From this score a text counts as good.
LEAST_SCORE = 0.3
#: The score of every text if the labels do not have both classes.
UNKNOWN = 0.5


def windows_of(data: bytes) -> list[bytes]:
    """The whole text in windows of nearly equal size; an empty text is one."""
    count = max(1, round(len(data) / WINDOW))
    ends = [len(data) * k // count for k in range(count + 1)]
    return [data[start:end] for start, end in zip(ends, ends[1:])]


def excerpt_of(data: bytes, size: int = EXCERPT_BYTES) -> bytes:
    """A text that is not longer, or pieces of it at even distances."""
    if len(data) <= size:
        return data
    pieces = 4
    step = size // pieces
    starts = [(len(data) - step) * k // (pieces - 1) for k in range(pieces)]
    return b"\n".join(data[start : start + step] for start in starts)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """One that begins with ``content`` as if it had just been compressed."""
    if len(content) < 8:  # no dictionary is that short
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


class Compressors:
    """The two compressors of a task."""

    def __init__(self, bad: bytes, good: bytes):
        self.bad, self.good = compressor(bad), compressor(good)

    def measure(self, text: str) -> tuple[float, float, float]:
        """The normalised difference of sizes (positive: nearer to good text), the share of
        the text that the better dictionary leaves, and the logarithm of its bytes."""
        data = text.encode()
        cut = windows_of(data)
        bad = sum(len(self.bad.compress(window)) for window in cut)
        good = sum(len(self.good.compress(window)) for window in cut)
        return (bad - good) / max(bad, good), min(bad, good) / max(len(data), 1), float(np.log1p(len(data)))


def terms_of(measures: np.ndarray) -> np.ndarray:
    """What the curve sees: the measures, their products with the difference, a square."""
    apart, left, size = measures.T
    return np.stack([apart, left, size, apart * size, apart * left, left * left], axis=1)


@dataclass
class Curve:
    """A logistic curve over standardised terms."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, measures: np.ndarray, target: np.ndarray, ridge: float = 0.01) -> Curve:
        """By Newton's method, with a little shrinkage, so that separable classes end too."""
        terms = terms_of(measures)
        mean, spread = terms.mean(axis=0), terms.std(axis=0) + 1e-9
        rows = np.column_stack([(terms - mean) / spread, np.ones(len(terms))])
        weights = np.zeros(rows.shape[1])
        penalty = ridge * np.eye(len(weights))
        for _ in range(60):
            chance = _logistic(rows @ weights)
            slope = rows.T @ (chance - target) + ridge * weights
            curvature = (rows * (chance * (1 - chance))[:, None]).T @ rows + penalty
            step = np.linalg.solve(curvature, slope)
            step *= min(1.0, 4 / max(np.abs(step).max(), 1e-12))  # no step past the bend
            weights -= step
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, spread, weights[:-1], float(weights[-1]))

    def score(self, measures: np.ndarray) -> np.ndarray:
        return _logistic((terms_of(measures) - self.mean) / self.spread @ self.weights + self.bias)


def _logistic(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -40, 40)))


@dataclass
class Classifier:
    """Two dictionaries and the curve."""

    bad: bytes
    good: bytes
    curve: Curve


def is_held_out(id_column: Column) -> Column:
    """A fifth of the rows, by the checksum of the id as text. A NULL id is not held out."""
    checksum = F.crc32(id_column.cast("string").cast("binary"))
    return F.coalesce(checksum % 5 == 0, F.lit(False))


def _sampled(docs: DataFrame, chosen: DataFrame, id_column: str, text: str) -> DataFrame:
    """One text for each chosen id: ``doc_id, quality, text``. ``chosen`` is a bounded
    number of ids, so it travels to the documents, and not these to it."""
    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> Classifier | None:
    """A classifier from labelled documents that are not held out, or None if these do not
    have both classes.

    The samples are bounded and chosen by the hash of the id: of either class
    ``DICTIONARY_ROWS`` for its dictionary, out of three quarters by another hash, and of the
    last quarter ``CURVE_ROWS`` for the curve. A document with contradicting labels counts as
    bad; labels other than 0 and 1 and NULL ids are ignored.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .withColumn("quarter", F.pmod(F.xxhash64(F.lit("quarter"), "doc_id"), F.lit(4)))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]

    def first(rows: DataFrame, count: int) -> DataFrame:
        return rows.orderBy(*order).limit(count).select("doc_id", "quality")

    def dictionary(quality: int) -> bytes:
        rows = first(known.filter((F.col("quarter") > 0) & (F.col("quality") == quality)), DICTIONARY_ROWS)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pieces = [excerpt_of(value.encode()) for value in strings(batch, "text")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.string()), pa.array(pieces, pa.binary())], names=["doc_id", "piece"]
                )

        sample = _sampled(docs, rows, id_column, text).mapInArrow(run, "doc_id string, piece binary")
        found = sample.toArrow().sort_by("doc_id").column("piece").to_pylist()
        return b"\n".join(found)[:DICTIONARY_BYTES]

    bad, good = dictionary(0), dictionary(1)
    rows = _sampled(docs, first(known.filter(F.col("quarter") == 0), CURVE_ROWS), id_column, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Compressors(bad, good)
        for batch in batches:
            found = [both.measure(value) for value in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()),
                    batch.column("quality").cast(pa.int32()),
                    pa.array(found, pa.list_(pa.float64())),
                ],
                names=["doc_id", "quality", "measures"],
            )

    sample = rows.mapInArrow(run, "doc_id string, quality int, measures array<double>").toArrow().sort_by("doc_id")
    target = sample.column("quality").to_numpy().astype(float)
    if not bad or not good or len(np.unique(target)) < 2:
        return None
    measures = sample.column("measures").combine_chunks().flatten().to_numpy().reshape(len(target), 3)
    return Classifier(bad, good, Curve.fit(measures, target))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Texts are compressed whole, so equal texts get equal scores; a NULL text is an empty
    one, which scores as what its length says. Repeated rows are scored each, an empty
    table gives no rows, further columns are ignored. Without documents of both labels
    every score is 0.5.
    """
    model = learn(docs, labels, id_column, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Compressors(model.bad, model.good) if model else None
        for batch in batches:
            if both is None or not len(batch):
                scores = np.full(len(batch), UNKNOWN)
            else:
                scores = model.curve.score(np.array([both.measure(value) for value in strings(batch, "text")]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= least_score).cast("int").alias("predicted"),
    )
