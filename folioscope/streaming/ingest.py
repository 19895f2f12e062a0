"""Incremental ingest: pages are measured and stored as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from folioscope.operators.chunking import assign_chunks
from folioscope.schemas import DEFAULT_CHUNK_SIZE, PAGE_KEY
from folioscope.sources.paged import with_metrics
from folioscope.sources.store import PageStore

BATCH_COLUMN = "batch_id"


def measured_pages(
    arriving: DataFrame,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Counts and chunk of each arriving ``(source_file, page_number, text)``.

    Stateless. ``enrich`` is the hook for heavier work per page, such as an embedding.
    """
    pages = assign_chunks(with_metrics(arriving), chunk_size)
    return enrich(pages) if enrich else pages


def store_stream(pages: DataFrame, store: PageStore, checkpoint: str, **trigger) -> StreamingQuery:
    """Bring every micro-batch into the page store, where searches find it at once.

    A page that is there already is replaced, so a batch that is run again after a failure
    changes nothing. Of several versions of a page in one batch the one of the latest
    ``arrived`` time counts, if the pages have such a column, else the greatest.
    Each batch rewrites the directories it touches: the store is compact at all times.
    """

    def take_in(batch: DataFrame, number: int) -> None:
        first = ["arrived"] if "arrived" in batch.columns else []
        others = [name for name in batch.columns if name not in (*PAGE_KEY, *first)]
        newest = F.max(F.struct(*first, *others)).alias("row")
        once = batch.groupBy(*PAGE_KEY).agg(newest).select(*PAGE_KEY, *[f"row.{name}" for name in others])
        store.replace_pages(once)

    return (
        pages.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_stream(pages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write every micro-batch to its own ``batch_id`` directory.

    A batch that is run again after a failure overwrites its directory, so each page is
    stored once per arrival. Nothing stored before is read or rewritten.
    """

    def store(batch: DataFrame, number: int) -> None:
        (
            batch.withColumn(BATCH_COLUMN, F.lit(number).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_COLUMN)
            .parquet(path)
        )

    return (
        pages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_pages(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str] = PAGE_KEY
) -> DataFrame:
    """Stored pages by natural key; of several arrivals the last one counts.

    Keys that arrived more than once are found from the keys alone. Usually they are few:
    then both joins broadcast them and no text is shuffled. However often one page
    arrived, its versions meet in an aggregate with map-side combine.
    """
    stored = T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])
    rows = spark.read.schema(stored).parquet(path)
    others = [name for name in schema.names if name not in key]
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    single = rows.join(repeated, list(key), "left_anti").select(*key, *others)
    newest = F.max(F.struct(BATCH_COLUMN, *others)).alias("row")
    several = rows.join(repeated, list(key), "left_semi").groupBy(*key).agg(newest)
    return single.unionByName(several.select(*key, *[f"row.{name}" for name in others]))


def running_totals(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Pages, words and characters per source so far, as a Parquet table at ``path`` that
    every micro-batch replaces.

    There is no event time, so the state keeps one row per source.
    """
    totals = pages.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("total_pages"),
        F.sum("word_count").cast("long").alias("total_words"),
        F.sum("char_count").cast("long").alias("total_chars"),
    )
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
