"""Language identification by a small convolutional network over bytes.

Bytes are folded into classes (letters without case, white space, digits, the parts of
UTF-8 sequences). Filters of several widths run over windows of a fixed length; each keeps
its maximum in a window; a softmax over these maxima gives the languages. Training and
prediction are numpy. In prediction a filter of width w is a sum of table rows, two
neighbouring bytes at a time, and all windows of many texts go through in one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import portions, strings, whole, with_columns

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
UNKNOWN = "und"

#: At most so many labelled documents of each language are learned from, and of each at
#: most so many characters, spread over the whole text.
DOCUMENTS_PER_LANGUAGE = 400
PIECES, PIECE_CHARS = 4, 240

#: More labels than these are taken for an error.
MOST_LANGUAGES = 1000

#: A text is rejected if no language gets so much more than an even share: 0 is the share
#: that every language has of a text that tells nothing, 1 is certainty.
LEAST_MARGIN = 1 / 15

#: Bytes that go through the network at a time.
BATCH_BYTES = 1 << 18


def _byte_classes() -> np.ndarray:
    """Byte -> class. 0 is white space and padding."""
    kind = np.zeros(256, np.uint8)
    for value in range(256):
        if chr(value).isalpha() and value < 128:
            kind[value] = 1 + (value | 32) - ord("a")
        elif 48 <= value < 58:
            kind[value] = 27
        elif value > 32 and value < 128:
            kind[value] = 28
        elif 128 <= value < 192:
            kind[value] = 32 + value - 128
        elif value >= 192:
            kind[value] = 96 + (value - 192) // 2
    return kind


CLASSES = 128
CLASS_OF = _byte_classes()


@dataclass
class Network:
    """``filters``: width -> (width, CLASSES, FILTERS) weights; ``dense``, ``bias``: to the
    languages, whose names ``labels`` has."""

    labels: list[str]
    filters: dict[int, np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    @staticmethod
    def new(labels: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        filters = {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS}
        width = FILTERS * len(WIDTHS)
        dense = rng.normal(0, 0.3, (width, len(labels))).astype(np.float32)
        return Network(labels, filters, dense, np.zeros(len(labels), np.float32))

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of classes (rows) -> maxima of all filters, and where they lie."""
        tops, places = [], []
        for width, weights in self.filters.items():
            span = windows.shape[1] - width + 1
            values = np.zeros((len(windows), span, FILTERS), np.float32)
            for shift in range(width):
                values += weights[shift][windows[:, shift : shift + span]]
            place = values.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(values, place[:, None, :], 1)[:, 0])
        return np.concatenate(tops, axis=1), np.concatenate(places, axis=1)

    def train(self, windows: np.ndarray, target: np.ndarray, rounds: int = 6, seed: int = 7) -> None:
        """Gradient steps (Adam) on the cross entropy, in small batches."""
        rng = np.random.default_rng(seed)
        parts = [*self.filters.values(), self.dense, self.bias]
        means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), 64):
                rows = order[at : at + 64]
                slopes = self._slopes(windows[rows], target[rows])
                step += 1
                for part, slope, mean, square in zip(parts, slopes, means, squares):
                    mean += 0.1 * (slope - mean)
                    square += 0.001 * (slope**2 - square)
                    size = np.sqrt(square / (1 - 0.999**step)) + 1e-8
                    part -= 0.01 * mean / (1 - 0.9**step) / size

    def _slopes(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        top, place = self.pooled(windows)
        active = np.maximum(top, 0)
        error = softmax(active @ self.dense + self.bias)
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        back = (error @ self.dense.T) * (top > 0)
        slopes = []
        row = np.arange(len(windows))[:, None]
        for at, (width, weights) in enumerate(self.filters.items()):
            mine = slice(at * FILTERS, (at + 1) * FILTERS)
            slope = np.zeros_like(weights)
            for shift in range(width):
                seen = windows[row, place[:, mine] + shift]
                np.add.at(slope[shift], (seen, np.arange(FILTERS)[None, :]), back[:, mine])
            slopes.append(slope)
        return [*slopes, active.T @ error, error.sum(axis=0)]

    def tables(self) -> dict[int, tuple[list[np.ndarray], np.ndarray | None]]:
        """For each width the filters by pairs of classes, and the last one if it is odd."""
        out = {}
        for width, weights in self.filters.items():
            pairs = [
                (weights[s][:, None, :] + weights[s + 1][None, :, :]).reshape(-1, FILTERS)
                for s in range(0, width - 1, 2)
            ]
            out[width] = (pairs, weights[-1] if width % 2 else None)
        return out

    def probabilities(self, windows: np.ndarray, tables: dict) -> np.ndarray:
        """The same as through :meth:`pooled`, by pair tables."""
        flat = windows.astype(np.int32)
        couples = flat[:, :-1] * CLASSES + flat[:, 1:]
        tops = []
        for width, (pairs, last) in tables.items():
            span = windows.shape[1] - width + 1
            values = pairs[0].take(couples[:, :span], axis=0)
            for at, pair in enumerate(pairs[1:], 1):
                values += pair.take(couples[:, 2 * at : 2 * at + span], axis=0)
            if last is not None:
                values += last.take(flat[:, width - 1 :], axis=0)
            tops.append(values.max(axis=1))
        return softmax(np.maximum(np.concatenate(tops, axis=1), 0) @ self.dense + self.bias)


def softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """Rows of ``WINDOW`` classes that cover all bytes; the last one is padded."""
    count = max(1, -(-len(data) // WINDOW))
    padded = np.zeros(count * WINDOW, np.uint8)
    padded[: len(data)] = CLASS_OF[np.frombuffer(data, np.uint8)]
    return padded.reshape(count, WINDOW)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def is_held_out(id_column: Column) -> Column:
    """A third of the rows, by the checksum of the id as text. A NULL id is not held out."""
    checksum = F.crc32(id_column.cast("string").cast("binary"))
    return F.coalesce(checksum % 3 == 1, F.lit(False))


def learn(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network for the languages of the labelled documents outside the held-out third.

    The sample is bounded: of each language the ``DOCUMENTS_PER_LANGUAGE`` documents whose
    ids and texts hash lowest, equal ones taken once; of each ``PIECES`` pieces of
    ``PIECE_CHARS`` characters at even distances. None if no labelled document has a text
    with a letter. More than ``MOST_LANGUAGES`` languages are refused: that is no label.
    """
    known = docs.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(id_column).alias("id")
    ).filter(~is_held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.withColumn("h", F.xxhash64("id", "text"))
    # The hash up to which documents are taken, from languages and hashes alone: tasks keep
    # only the lowest ranks of each language before the shuffle.
    by_hash = Window.partitionBy("lang").orderBy("h")
    lowest = known.select("lang", "h", F.dense_rank().over(by_hash).alias("at"))
    bounds = lowest.filter(F.col("at") <= DOCUMENTS_PER_LANGUAGE).groupBy("lang").agg(F.max("h")).take(MOST_LANGUAGES + 1)
    if len(bounds) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang}")
    if not bounds:
        return None
    bound = F.create_map(*(F.lit(x) for pair in bounds for x in pair))
    step = F.greatest((F.length("text") - PIECE_CHARS) / (PIECES - 1), F.lit(0))
    cut = [F.substr("text", (step * k).cast("int") + 1, F.lit(PIECE_CHARS)) for k in range(PIECES)]
    sample = (
        known.filter(F.col("h") <= F.element_at(bound, F.col("lang")))
        .select("lang", "h", F.array(*cut).alias("pieces"))
        .groupBy("lang", "h")
        .agg(F.min("pieces").alias("pieces"))
        .toArrow()
        .sort_by([("lang", "ascending"), ("h", "ascending")])
    )
    if not sample.num_rows:
        return None
    labels = sorted(set(sample.column("lang").to_pylist()))
    rows, target = [], []
    for name, pieces in zip(sample.column("lang").to_pylist(), sample.column("pieces").to_pylist()):
        for piece in dict.fromkeys(pieces):
            rows.append(windows_of(piece.encode())[:1])
            target.append(labels.index(name))
    network = Network.new(labels)
    network.train(np.concatenate(rows), np.array(target))
    return network


def predict_batch(texts: list[str], network: Network, tables: dict) -> tuple[list[str], list[float]]:
    """Language and score of each text: the mean over its windows, weighted by bytes."""
    data = [text.encode() for text in texts]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    spoken = [at for at, text in enumerate(texts) if has_letter(text)]
    for part in portions([len(data[at]) for at in spoken], BATCH_BYTES):
        rows = spoken[part]
        sums = np.zeros((len(rows), len(network.labels)))
        cut = [windows_of(data[at]) for at in rows]
        owner = np.repeat(np.arange(len(rows)), [len(windows) for windows in cut])
        windows = np.concatenate(cut)
        weight = np.concatenate(
            [np.minimum(WINDOW, len(data[at]) - WINDOW * np.arange(len(c))) for at, c in zip(rows, cut)]
        )
        for start in range(0, len(windows), BATCH_BYTES // WINDOW):
            some = slice(start, start + BATCH_BYTES // WINDOW)
            chance = network.probabilities(windows[some], tables)
            np.add.at(sums, owner[some], chance * weight[some, None])
        sums /= sums.sum(axis=1, keepdims=True)
        for at, best, score in zip(rows, sums.argmax(axis=1), sums.max(axis=1)):
            names[at], scores[at] = network.labels[best], min(1.0, float(score))
    return names, scores


def identify(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` added at the end.

    Every byte of a text lies in a window. NULL texts and texts without a letter are
    ``und`` with score 0, as is everything without a network. The row itself passes
    through unchanged; existing columns of the two names are replaced.
    """
    added = ("lang_pred", "score")
    rows = docs.drop(*added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network is not None else {}
        for batch in batches:
            texts = strings(batch, text)
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if network is not None:
                names, scores = predict_batch(texts, network, tables)
            yield with_columns(
                batch, (), lang_pred=pa.array(names, pa.string()), score=pa.array(scores, pa.float64())
            )

    schema = T.StructType(
        [*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)


def with_known_language(
    docs: DataFrame, network: Network | None, text: str = "text", least_score: float | None = None
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text has a letter and whose
    language is told with a score of ``least_score`` or more, by default ``LEAST_MARGIN``
    above an even share. Without a network only the letter counts. Rows are judged where
    they lie, without a shuffle."""
    if least_score is None and network is not None:
        even = 1 / len(network.labels)
        least_score = even + LEAST_MARGIN * (1 - even)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network is not None else {}
        for batch in batches:
            texts = strings(batch, text)
            if network is None:
                known = [has_letter(value) for value in texts]
            else:
                names, scores = predict_batch(texts, network, tables)
                known = [n != UNKNOWN and s >= least_score for n, s in zip(names, scores)]
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_of_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``, predicted by a
    network that learned from the documents outside the held-out third. Repeated rows are
    predicted each; an empty table gives no rows; further columns are ignored."""
    network = learn(docs, id_column, text, lang)
    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("__text"))
    found = identify(rows, network, "__text")
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
