"""Embedding a text column through a pluggable model.

A model is given as a *factory*: a function without arguments that loads the model
and returns ``encode(texts) -> matrix``. Spark ships the factory, each Python worker
calls it once, and Arrow batches of texts run through the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import is_blank
from folioscope.schemas import DEFAULT_DIMENSION

Encoder = Callable[[list[str]], np.ndarray]
ModelFactory = Callable[[], Encoder]
#: Rows and bytes of text that a model is given at a time, whatever the size of an Arrow batch.
SLICE_ROWS, SLICE_BYTES = 512, 2 << 20


def embed(
    text: Column | str,
    factory: ModelFactory,
    dimension: int,
    prepare: Callable[[Column], Column] | None = None,
) -> Column:
    """One vector per text. A blank or missing text gets the zero vector and is never
    passed to the model. ``prepare`` is applied to the other texts before, in the JVM."""
    text = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf("array<float>")
    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = factory()
        for batch in batches:
            vectors = np.zeros((len(batch), dimension), dtype=np.float32)
            for some in _slices(batch):
                encoded = np.asarray(encode(batch.take(pa.array(some)).to_pylist()))
                if encoded.shape != (len(some), dimension):
                    raise ValueError(f"the model returned {encoded.shape}, expected dimension {dimension}")
                vectors[some] = encoded
            starts = np.arange(0, vectors.size + 1, dimension, dtype=np.int32)
            yield pa.ListArray.from_arrays(starts, vectors.reshape(-1))

    return encode_batches(F.when(~is_blank(text), prepare(text) if prepare else text))


def _slices(batch: pa.Array) -> Iterator[np.ndarray]:
    """The places of the texts that there are, a bounded number and size at a time; a text
    that is longer comes alone."""
    filled = np.flatnonzero(batch.is_valid().to_numpy(zero_copy_only=False))
    sizes = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)[filled].astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(filled):
        before = ends[start] - sizes[start]
        stop = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
        stop = min(max(stop, start + 1), start + SLICE_ROWS)
        yield filled[start:stop]
        start = stop


class _Buckets(dict):
    """The bucket of each word, computed when a word is first seen and kept for a while."""

    def __init__(self, dimension: int, most: int = 1 << 17):
        super().__init__()
        self.dimension, self.most = dimension, most

    def __missing__(self, word: str) -> int:
        bucket = int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % self.dimension
        if len(self) >= self.most:
            self.clear()
        self[word] = bucket
        return bucket


def hashed_words(dimension: int = DEFAULT_DIMENSION) -> ModelFactory:
    """A stand-in model: a hashed bag of words at unit length.

    The bucket of a word is the number in the first four hex digits of its MD5,
    modulo ``dimension``. It measures shared words, not meaning. It expects lower-case
    texts; :func:`embed_words` prepares them.
    """

    def load() -> Encoder:
        bucket = _Buckets(dimension).__getitem__

        def encode(texts: list[str]) -> np.ndarray:
            counts = np.zeros((len(texts), dimension))
            for row, text in enumerate(texts):
                slots = np.fromiter(map(bucket, text.split()), np.int64)
                counts[row] = np.bincount(slots, minlength=dimension)
            length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return counts / np.where(length > 0, length, 1.0)

        return encode

    return load


def embed_words(text: Column | str, dimension: int = DEFAULT_DIMENSION) -> Column:
    """Embed with :func:`hashed_words`."""
    return embed(text, hashed_words(dimension), dimension, F.lower)
