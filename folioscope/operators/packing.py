"""Chunks of whole pages under a budget of words, cut greedily, in parallel.

Where a chunk ends depends on where it begins, page after page. But where a chunk would
end if it began at a page is known from the running totals alone: before the first page
whose total exceeds the total before that page by more than the budget. So every page
has a pointer to the next beginning, and the beginnings are the pages on the path from the
first page. Partitions of pages in order follow their pointers to where these leave the
partition; only pages that pointers from elsewhere hit matter then, and among these the path is
found by doubling.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.running import running_total
from folioscope.session import scratch_path


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


#: Row of a sorted list: the end of a page, or the limit of a chunk that begins at one.
END, LIMIT = 0, 1


def _in_parts(rows: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """The rows in order, with ``part``, written."""
    spread = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    """``part, source, arrays`` of the rows of one part and source side by side."""
    key, held = None, []
    for batch in batches:
        parts, sources = (batch.column(name).to_pylist() for name in ("part", "source_file"))
        arrays = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
        start = 0
        for mine, group in itertools.groupby(zip(parts, sources)):
            stop = start + sum(1 for _ in group)
            if key is not None and mine != key:
                yield (*key, [np.concatenate(column) for column in zip(*held)])
                held = []
            key = mine
            held.append([array[start:stop] for array in arrays])
            start = stop
    if key is not None:
        yield (*key, [np.concatenate(column) for column in zip(*held)])


def _batch(columns: dict[str, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def next_starts(totals: DataFrame, budget: int, partitions: int | None = None) -> DataFrame:
    """``source_file, page_number, next``: where the next chunk begins if one begins at the
    page; NULL if the rest fits. ``totals`` has ``words_before`` and ``word_count``.

    Ends of pages and limits of chunks are sorted together: the answer to a limit is the
    next end. Past the last end of a partition it is the first end of a later one.
    """
    after = F.col("words_before") + F.coalesce("word_count", F.lit(0))
    marks = F.array(
        F.struct(after.alias("value"), F.lit(END).alias("kind")),
        F.struct((F.col("words_before") + budget).alias("value"), F.lit(LIMIT).alias("kind")),
    )
    rows = totals.select("source_file", F.col("page_number").cast("long").alias("page_number"), F.explode(marks).alias("m"))
    rows = rows.select("source_file", "m.value", "m.kind", "page_number")
    sorted_rows = _written(_in_parts(rows, ["source_file", "value", "kind", "page_number"], partitions), "limits")
    first = sorted_rows.filter(F.col("kind") == END).groupBy("source_file", "part").agg(
        F.min(F.struct("value", "page_number")).alias("end")
    )
    spans = sorted_rows.groupBy("source_file").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b")
    # A source lies in several parts only where these begin: fewer rows than parts.
    later: dict[str, list[tuple[int, int]]] = {}
    for row in first.join(spans, "source_file").select("source_file", "part", "end.page_number").collect():
        later.setdefault(row[0], []).append((row[1], row[2]))
    for found in later.values():
        found.sort()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, source, (kind, page) in _runs(batches, ("kind", "page_number")):
            limits = np.flatnonzero(kind == LIMIT)
            ends = np.flatnonzero(kind == END)
            place = np.searchsorted(ends, limits)
            beyond = next((p for other, p in later.get(source, ()) if other > part), 0)
            found = np.append(page[ends], beyond)[place]
            # A page that exceeds the budget alone still fills its chunk.
            found = np.where(found > 0, np.maximum(found, page[limits] + 1), 0)
            yield _batch(
                {
                    "source_file": ([source] * len(limits), pa.string()),
                    "page_number": (page[limits], pa.int64()),
                    "next": (pa.array(found, mask=found == 0), pa.int64()),
                }
            )

    read = sorted_rows.repartition("part").sortWithinPartitions("part", "source_file", "value", "kind", "page_number")
    return read.select("part", "source_file", "kind", "page_number").mapInArrow(
        run, "source_file string, page_number long, next long"
    )


def _leave(page: np.ndarray, following: np.ndarray) -> np.ndarray:
    """For each page of a run the first pointer on its path that leaves the run (0: the end)."""
    where = np.searchsorted(page, following)
    inside = (where < len(page)) & (following > 0)
    inside[inside] &= page[where[inside]] == following[inside]
    out = following.copy()
    for at in range(len(page) - 1, -1, -1):
        if inside[at]:
            out[at] = out[where[at]]
    return out


def _starts(page: np.ndarray, following: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Which pages of a run lie on the path from the pages marked ``entry``."""
    on = entry.astype(bool).copy()
    where = np.searchsorted(page, following)
    for at in range(len(page)):
        to = where[at]
        if on[at] and following[at] > 0 and to < len(page) and page[to] == following[at]:
            on[to] = True
    return on


def assign_chunks_greedily(pages: DataFrame, budget: int, partitions: int | None = None) -> DataFrame:
    """Add ``words_before`` and ``chunk_id``: 0, 1, ... for chunks that take pages in order while their
    words do not exceed ``budget``. No chunk does, unless it is one page.

    Pages are numbered from 1 without gaps in each source. A source may hold most pages: it spreads over
    partitions, and ``log2`` of their number rounds join the pages where paths
    enter a partition.
    """
    if budget < 1:
        raise ValueError("a word budget is at least one word")
    pages = pages.drop("chunk_id")
    words = F.col("word_count")
    totals = running_total(pages, ["source_file"], "page_number", "words_before", words)
    numbers = _written(totals.select("source_file", "page_number", "words_before", "word_count"), "totals")
    pointers = _written(
        _in_parts(next_starts(numbers, budget, partitions), ["source_file", "page_number"], partitions), "pointers"
    )
    by_part = pointers.withColumn("next", F.coalesce("next", F.lit(0)))

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, source, (page, following) in _runs(batches, ("page_number", "next")):
            yield _batch(
                {
                    "source_file": ([source] * len(page), pa.string()),
                    "page_number": (page, pa.int64()),
                    "leave": (_leave(page, following), pa.int64()),
                }
            )

    ordered = by_part.repartition("part").sortWithinPartitions("part", "source_file", "page_number")
    paths = ordered.select("part", "source_file", "page_number", "next").mapInArrow(
        leave, "source_file string, page_number long, leave long"
    )
    page = ["source_file", "page_number"]
    paths = _written(paths, "paths")
    firsts = numbers.groupBy("source_file").agg(F.min("page_number").cast("long").alias("page_number"))
    crossed = paths.filter("leave > 0").select("source_file", F.col("leave").alias("page_number"))
    hit = crossed.union(firsts).distinct()
    levels = [_written(paths.join(hit, page), "jumps")]
    span = levels[0].groupBy("source_file").count().agg(F.max("count")).first()[0] or 0
    while 1 << len(levels) <= span:
        one = levels[-1]
        two = one.select("source_file", F.col("page_number").alias("leave"), F.col("leave").alias("further"))
        doubled = one.join(two, ["source_file", "leave"]).select(*page, F.col("further").alias("leave"))
        levels.append(_written(doubled.filter("leave > 0"), "jumps"))
    entries = firsts
    for jumps in reversed(levels):
        reached = jumps.join(entries, page, "left_semi").filter("leave > 0")
        entries = _written(entries.union(reached.select("source_file", F.col("leave"))).distinct(), "entries")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, source, (number, following, entry) in _runs(batches, ("page_number", "next", "entry")):
            yield _batch(
                {
                    "source_file": ([source] * len(number), pa.string()),
                    "page_number": (number, pa.int64()),
                    "starts": (_starts(number, following, entry).astype(np.int64), pa.int64()),
                }
            )

    flagged = by_part.join(entries.withColumn("entry", F.lit(1)), page, "left").withColumn(
        "entry", F.coalesce("entry", F.lit(0))
    )
    flagged = flagged.repartition("part").sortWithinPartitions("part", "source_file", "page_number")
    marked = flagged.select("part", "source_file", "page_number", "next", "entry").mapInArrow(
        mark, "source_file string, page_number long, starts long"
    )
    counted = running_total(marked, ["source_file"], "page_number", "chunks_before", F.col("starts"))
    chunks = counted.select(*page, (F.col("chunks_before") + F.col("starts") - 1).alias("chunk_id"))
    chunks = _written(chunks.join(numbers.select(*page, "words_before"), page), "chunks")
    return pages.join(chunks, page).select(*pages.columns, "words_before", "chunk_id")
