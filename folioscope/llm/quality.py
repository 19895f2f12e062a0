"""Quality rules: a base rule over word counts, and boosted trees over text statistics."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm import boosting
from folioscope.llm.common import settled, strings, whole

WORD_GAPS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"

#: Statistics that the trees see, and how the score may depend on each: only up (1), only
#: down (-1), or either (0).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_char": -1,
    "repeated_line_share": -1,
    "repeated_word_share": -1,
    "distinct_word_share": 1,
    "upper_share": -1,
    "digit_share": -1,
    "exclamations_per_word": -1,
    "words_per_line": 0,
}

#: At most so many labelled rows are used to fit the trees.
TRAINING_ROWS = 20_000
#: A text is rejected if the trees give it a lower chance to be of good quality.
LEAST_SCORE = 0.4

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more. ``ids`` number the words."""
    count = len(ids)
    if count < 4:
        return 0
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 2_000_000:  # three numbers no longer fit 64 bits
        firsts, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * distinct + ids[2:]
    in_order = np.sort(windows)
    twice = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(windows, twice)
    covered = np.zeros(count, bool)
    for shift in range(3):
        covered[shift : count - 2 + shift] |= hit
    return int(covered.sum())


def measure(text: str) -> tuple[list[int], list[float]]:
    """The counts of the base rule and the statistics for the trees."""
    data = text.encode()
    index: dict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    ids = np.array(array("q", map(index.__getitem__, data.split())), np.int64)
    words, distinct = len(ids), len(index)
    chars = len(text) - sum(map(text.count, WORD_GAPS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(WORD_GAPS)]
    twice = len(lines) - len(set(lines))
    repeated = repeated_words(ids, distinct)
    size = max(len(data), 1)
    features = [
        float(np.log1p(words)),
        chars / max(words, 1),
        symbols / max(chars, 1),
        twice / max(len(lines), 1),
        repeated / max(words, 1),
        distinct / max(words, 1),
        (len(data) - len(data.translate(None, UPPER))) / size,
        (len(data) - len(data.translate(None, DIGITS))) / size,
        text.count("!") / max(words, 1),
        words / max(len(lines), 1),
    ]
    return [words, chars, symbols, twice, repeated], features


def measured(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the counts and the statistics (``features``) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(value) for value in strings(batch, "text")]
            columns = zip(*(counts for counts, _ in found)) if found else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(column, pa.int64()) for column in columns),
                    pa.array([features for _, features in found], pa.list_(pa.float64())),
                ],
                names=["doc_id", *COUNTS, "features"],
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType(
        [
            rows.schema["doc_id"],
            *(T.StructField(name, T.LongType()) for name in COUNTS),
            T.StructField("features", T.ArrayType(T.DoubleType())),
        ]
    )
    return rows.mapInArrow(run, schema)


def fit_quality(
    stats: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS
) -> boosting.Trees | None:
    """Trees for the labels 1 (good) and 0, from a bounded sample: the ``training_rows``
    documents whose ids hash lowest. None if the labels do not have both classes.

    A document with contradicting labels counts as bad; other labels are ignored.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    sample = (
        stats.join(known, "doc_id")
        .select("features", "quality", "doc_id", F.xxhash64("doc_id").alias("order"))
        .orderBy("order", "doc_id", "features")
        .limit(training_rows)
        .select("features", "quality")
        .toArrow()
    )
    target = sample.column("quality").to_numpy().astype(float)
    if len(np.unique(target)) < 2:
        return None
    rows = sample.column("features").combine_chunks().flatten().to_numpy().reshape(len(target), -1)
    return boosting.fit(rows, target, list(FEATURES.values()))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    training_rows: int = TRAINING_ROWS,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the counts, ``base_failed, score, kept``.

    The base rule fails texts of under 50 words and texts of which over half the words
    stand in 3-word windows that occur twice. The others are kept if the trees score them
    at ``least_score`` or more. NULL and empty texts have no words and fail. Without
    labels of both classes (an empty table, say) the score is NULL and the base rule
    decides alone. NULL and repeated ids are judged row by row; texts are read whole;
    further columns are ignored. Equal texts get equal scores.
    """
    stats = settled(measured(docs, id_column, text))
    model = fit_quality(stats, labels, training_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = None
            if model is not None and len(batch):
                rows = batch.column("features").flatten().to_numpy()
                scores = model.score(rows.reshape(len(batch), -1))
            score = pa.nulls(len(batch), pa.float64()) if scores is None else pa.array(scores)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in ("doc_id", *COUNTS)), score],
                names=["doc_id", *COUNTS, "score"],
            )

    schema = T.StructType([*stats.drop("features").schema.fields, T.StructField("score", T.DoubleType())])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passed = F.col("score").isNull() | (F.col("score") >= least_score)
    return stats.mapInArrow(run, schema).select(
        "doc_id", *COUNTS, failed.alias("base_failed"), "score", (~failed & passed).alias("kept")
    )
