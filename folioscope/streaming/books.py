"""Books from chunks that arrive in any order: a book is told when its last chunk is there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

COMPLETE, MISSING = "complete", "missing"
#: Rows that leave a task at a time.
ROWS = 10_000

TOLD = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("chunk_id", T.LongType()),
        T.StructField("num_chunks", T.LongType()),
        T.StructField("total_pages", T.LongType()),
        T.StructField("total_word_count", T.LongType()),
    ]
)

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Completion(StatefulProcessor):
    """The chunks of a source that have arrived, and what is known of the whole.

    Chunks are entries of a map in the state store, so a source of any number of them is
    never held in memory; sums are kept beside them. A chunk that arrives again replaces its
    counts. A source is told when its last chunk arrives, and again if a later version
    of a chunk changes its sums. ``wait`` milliseconds after its last news a source that
    is not complete tells its missing chunks, and once more after each later timer.
    """

    def __init__(self, wait: int | None):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk_id long", "pages long, words long")
        self.sums = handle.getValueState("sums", "expected long, arrived long, pages long, words long, told boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.sums.get() if self.sums.exists() else (0, 0, 0, 0, False)
        expected, arrived, pages, words, told = known
        before = (expected, pages, words)
        for frame in rows:
            columns = (frame[name].tolist() for name in ("num_chunks", "chunk_id", "page_count", "word_count"))
            for total, chunk, n_pages, n_words in zip(*columns):
                expected = max(expected, int(total))
                old = self.chunks.getValue((chunk,)) if self.chunks.containsKey((chunk,)) else None
                arrived += old is None
                pages += int(n_pages) - (old[0] if old else 0)
                words += int(n_words) - (old[1] if old else 0)
                self.chunks.updateValue((chunk,), (int(n_pages), int(n_words)))
        complete = arrived == expected
        news = complete and not (told and before == (expected, pages, words))
        self.sums.update((expected, arrived, pages, words, told or complete))
        if self.wait is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if not complete:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait)
        if news:
            yield _rows([(key[0], COMPLETE, None, expected, pages, words)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expected, arrived, pages, words, _ = self.sums.get()
        lost = []
        for chunk in range(expected if arrived < expected else 0):
            if not self.chunks.containsKey((chunk,)):
                lost.append((key[0], MISSING, chunk, expected, pages, words))
            if len(lost) == ROWS:
                yield _rows(lost)
                lost = []
        if lost:
            yield _rows(lost)

    def close(self) -> None:
        pass


def _rows(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=TOLD.names)
    return frame.astype({name: "Int64" for name in TOLD.names[2:]})


def completed_books(chunks: DataFrame, wait_ms: int | None = None) -> DataFrame:
    """News of sources from a stream of chunk results: a row ``complete`` with the totals when all
    chunks of a source have arrived, and rows ``missing`` when they have not after a wait.

    ``chunks`` has ``source_file, num_chunks`` (of the whole source, from its manifest), ``chunk_id,
    page_count, word_count``. Order and repeats do not matter.
    """
    rows = chunks.select("source_file", "num_chunks", "chunk_id", "page_count", "word_count")
    return rows.groupBy("source_file").transformWithStateInPandas(
        Completion(wait_ms), outputStructType=TOLD, outputMode="Update", timeMode="None" if wait_ms is None else "ProcessingTime"
    )


def merge_stream(
    spark: SparkSession, chunks: DataFrame, path: str, checkpoint: str, wait_ms: int | None = None, **trigger
) -> StreamingQuery:
    """Write the news to ``path``, one directory a batch: a batch that is run again after a failure
    replaces its own. State is kept in RocksDB, which the state map needs.

    With a wait the query goes on for its timers and is stopped by the caller; without one
    it ends with the rows there are, and a restart reads on.
    """

    def store(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(number).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return (
            completed_books(chunks, wait_ms)
            .writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or ({"availableNow": True} if wait_ms is None else {"processingTime": "1 second"})))
            .start()
        )
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def told(spark: SparkSession, path: str) -> DataFrame:
    """All news, with ``batch_id``."""
    return spark.read.schema(T.StructType([*TOLD.fields, T.StructField("batch_id", T.LongType())])).parquet(path)


def finished_books(spark: SparkSession, path: str) -> DataFrame:
    """The latest totals of the sources that are complete."""
    done = told(spark, path).filter(F.col("status") == COMPLETE)
    latest = F.max(F.struct("batch_id", "num_chunks", "total_pages", "total_word_count")).alias("x")
    return done.groupBy("source_file").agg(latest).select(
        "source_file", "x.num_chunks", "x.total_pages", "x.total_word_count"
    )


def lost_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, chunk_id`` reported missing of sources that are not complete since."""
    news = told(spark, path)
    done = news.filter(F.col("status") == COMPLETE).select("source_file").distinct()
    lost = news.filter(F.col("status") == MISSING).select("source_file", "chunk_id").distinct()
    return lost.join(done, "source_file", "left_anti")
