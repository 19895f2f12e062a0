"""Inverted lists over pages: which pages hold a term, kept as files next to a page store."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import or_empty
from folioscope.schemas import PAGE_KEY

GROUP_COLUMN = "source_group"
DEFAULT_GROUPS = 64
#: A list covers so many consecutive page numbers of a source at most, as a power of two.
PART_BITS = 13
#: Characters of text that a task turns into lists at a time.
HELD_CHARS = 8 << 20

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

#: Distinct terms of a text (codes or words), how often each occurs, the text's length.
Terms = tuple[Sequence, Sequence[int], int]


def word_terms(text: str) -> Terms:
    """The words of a text in lower case, as runs without white space."""
    counts = Counter(text.split())
    return list(counts), list(counts.values()), counts.total()


def trigram_terms(text: str) -> Terms:
    """The distinct runs of three characters, 21 bits each."""
    codes = np.unique(trigram_codes(text))
    return codes, np.ones(len(codes), np.int64), len(text)


def trigram_codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return points[:-2] << 42 | points[1:-1] << 21 | points[2:] if len(points) > 2 else np.zeros(0, np.int64)


class _Lists:
    """Pages that a task holds, to be turned into lists."""

    def __init__(self) -> None:
        self.groups: list[int] = []
        self.bare: list[int] = []
        self.blocks: dict[tuple, int] = {}
        self.numbers: dict[object, int] = {}
        self.block, self.page, self.length = [], [], []
        self.terms: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, group: int, source: str, page: int, terms: Terms) -> None:
        found, times, length = terms
        if not isinstance(found, np.ndarray):
            number = self.numbers
            found = np.array([number.setdefault(term, len(number)) for term in found], np.int64)
        self.block.append(self.blocks.setdefault((group, source, page >> PART_BITS), len(self.blocks)))
        self.page.append(page)
        self.length.append(length)
        self.groups.append(group)
        self.terms.append(found)
        self.times.append(np.asarray(times, np.int64))

    def totals(self) -> list[tuple[int, int | None, int | None]]:
        """Group, pages and length of all; groups that are only named have neither."""
        count, length = Counter(self.groups), Counter()
        for group, size in zip(self.groups, self.length):
            length[group] += size
        return [(group, count[group], length[group]) for group in count] + [(group, None, None) for group in self.bare]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(self.page)), np.array([len(terms) for terms in self.terms], np.int64))
        terms = np.concatenate([np.zeros(0, np.int64), *self.terms])
        times = np.concatenate([np.zeros(0, np.int64), *self.times])
        page, length, block = (np.array(x, np.int64)[owner] for x in (self.page, self.length, self.block))
        order = np.lexsort((page, block, terms))
        terms, times, page, length, block = (x[order] for x in (terms, times, page, length, block))
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        offsets = pa.array(np.append(first, len(terms)).astype(np.int32))

        def lists(values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))

        names = list(self.numbers)
        blocks = list(self.blocks)
        held = [blocks[at] for at in block[first]]
        least = np.minimum.reduceat(length, first) if len(first) else length
        most = np.maximum.reduceat(times, first) if len(first) else times
        totals = self.totals()
        none = [None] * len(totals)
        columns = {
            GROUP_COLUMN: [group for group, _, _ in held] + [group for group, _, _ in totals],
            "term": ([names[at] for at in terms[first]] if names else terms[first].tolist()) + none,
            "source_file": [source for _, source, _ in held] + none,
            "part": [part for _, _, part in held] + none,
            "n": np.diff(np.append(first, len(terms))).tolist() + [pages for _, pages, _ in totals],
            "most": most.tolist() + none,
            "least": least.tolist() + [size for _, _, size in totals],
        }
        arrays = [pa.array(values, schema.field(name).type) for name, values in columns.items()]
        empty = pa.nulls(len(totals), pa.list_(pa.int32()))
        arrays += [pa.concat_arrays([lists(values), empty]) for values in (page, times, length)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session, for one write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class PostingTable:
    """Lists of the pages that hold a term, at ``path``.

    A row is a term in up to ``2**13`` consecutive pages of a source: ``term, source_file,
    part, n, most, least`` and the arrays ``pages, times, lengths``; ``most`` is the
    greatest number of times, ``least`` the least length among them. So no list grows with
    the corpus, and a term that all pages hold has many rows. Of a block there may be several
    rows of a term. Rows without a term have the number and the total length of the pages.

    Sources are hashed into groups, a directory each, and a refresh replaces whole groups.
    Files have runs in order of term, one for each ``HELD_CHARS`` of text: a look-up of terms skips
    most of the pages of a file by their least and greatest term, and reads the arrays only
    where they are asked for.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        terms: Callable[[str], Terms],
        kind: T.DataType,
        groups: int = DEFAULT_GROUPS,
    ):
        self.spark, self.path, self.terms, self.groups = spark, path.rstrip("/"), terms, groups
        whole = T.ArrayType(T.IntegerType())
        self.schema = T.StructType(
            [
                T.StructField("term", kind),
                T.StructField("source_file", T.StringType()),
                T.StructField("part", T.IntegerType()),
                T.StructField("n", T.LongType()),
                T.StructField("most", T.LongType()),
                T.StructField("least", T.LongType()),
                *(T.StructField(name, whole) for name in ("pages", "times", "lengths")),
                T.StructField(GROUP_COLUMN, T.IntegerType()),
            ]
        )

    def _group(self, source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.lit(self.groups)).cast("int")

    def build(self, pages: DataFrame) -> None:
        """Index all ``pages`` (``source_file, page_number, text``) anew."""
        self._write(pages, list(range(self.groups)))

    def groups_of(self, sources: DataFrame) -> list[int]:
        """The groups of the sources; at most ``groups`` numbers."""
        return [row[0] for row in sources.select(self._group(F.col("source_file"))).distinct().collect()]

    def refresh(self, pages: DataFrame, groups: Sequence[int]) -> None:
        """Index the pages of some groups anew; ``pages`` are all that there are now."""
        self._write(pages.filter(self._group(F.col("source_file")).isin(list(groups))), list(groups))

    def _write(self, pages: DataFrame, groups: list[int]) -> None:
        # Lists weigh far more than texts, as most terms stand on few pages, and sorting a task's
        # lists takes several times its texts. So the texts of a group are brought together, and
        # lists go to the files as they are made, in runs in order of term: with several files
        # open in a task Spark asks for no order by directory.
        texts = pages.select(
            self._group(F.col("source_file")).alias("g"), *PAGE_KEY, F.lower(or_empty("text")).alias("text")
        )
        # Every group gets a row, so that one without pages is replaced as well.
        nothing = self.spark.createDataFrame([(group,) for group in groups], "g int")
        rows = texts.unionByName(nothing, allowMissingColumns=True).hint("rebalance", "g")
        with _setting(self.spark, OPEN_FILES, str(self.groups)):
            (
                self._lists(rows)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(GROUP_COLUMN)
                .parquet(self.path)
            )

    def _lists(self, texts: DataFrame) -> DataFrame:
        """The lists of ``g, source_file, page_number, text``; a group without a page is named."""
        terms_of = self.terms
        kinds = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
        names = [GROUP_COLUMN, *self.schema.names[:-1]]
        out = T.StructType([self.schema[name] for name in names])
        schema = pa.schema([pa.field(f.name, kinds[f.dataType.simpleString()]) for f in out.fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, chars = _Lists(), 0
            for batch in batches:
                columns = (batch.column(name).to_pylist() for name in ("g", *PAGE_KEY, "text"))
                for group, source, page, text in zip(*columns):
                    if page is None:
                        held.bare.append(group)
                        continue
                    held.add(group, source, page, terms_of(text))
                    chars += len(text)
                    if chars >= HELD_CHARS:
                        yield held.batch(schema)
                        held, chars = _Lists(), 0
            if held.page or held.bare:
                yield held.batch(schema)

        return texts.mapInArrow(run, out)

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def of_terms(self, terms: Iterable) -> DataFrame:
        """The rows of some terms, by a filter that the scan can use."""
        return self.rows.filter(F.col("term").isin(list(terms)))

    def counts(self, terms: Iterable) -> dict:
        """How many pages hold each of the terms, from the counts of the lists alone."""
        counted = self.of_terms(terms).groupBy("term").agg(F.sum("n").alias("n"))
        return {row["term"]: row["n"] for row in counted.collect()}

    def totals(self) -> tuple[int, int]:
        """The number of pages and their total length."""
        whole = self.rows.filter(F.col("term").isNull())
        pages, length = whole.agg(F.sum("n"), F.sum("least")).first()
        return pages or 0, length or 0


def literal_keys(keys: Iterable[tuple[str, int]]) -> Column:
    """A condition on the page key that scans can use; for a bounded number of keys."""
    parts = [
        (F.col("source_file") == source) & F.col("page_number").isin([page for _, page in group])
        for source, group in itertools.groupby(sorted(keys), key=lambda key: key[0])
    ]
    condition = F.lit(False)
    for part in parts:
        condition = condition | part
    return condition
