"""Counts kept beside a page store: equal to counts of its pages, whatever is written."""

import pytest
from pyspark.sql import functions as F
from test_store import pages

from folioscope.library import Library
from folioscope.operators import listing
from folioscope.sources.store import PageStore
from folioscope.sources.summaries import StoreSummaries


def same(store):
    kept = store.summaries
    counted, listed = listing.table_stats(store.read()).collect(), listing.list_documents(store.read()).collect()
    assert kept.table_stats().collect() == counted
    assert sorted(kept.list_documents().collect()) == sorted(listed)
    sizes = store.read().groupBy(F.length(F.bin("word_count")).cast("long").alias("size_class"))
    sizes = sizes.agg(F.count(F.lit(1)).alias("pages"), F.sum("word_count").alias("words"))
    assert sorted(kept.page_sizes().collect(), key=str) == sorted(sizes.collect(), key=str)
    return {row.source_file: row.pages for row in listed}


def test_counts_follow_every_write(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/pages", groups=4, compact_after=5)
    store.summaries.build()
    assert same(store) == {}
    store.replace_sources(pages(spark, {"a": 3, "b": 2, "ü=%": 4}))
    assert same(store) == {"a": 3, "b": 2, "ü=%": 4}
    # Another object of the same store keeps them as well.
    other = PageStore(spark, store.path, groups=4, compact_after=5)
    other.replace_pages(pages(spark, {"a": 5, "new": 1}, word="more words here"))
    assert same(store) == {"a": 5, "b": 2, "ü=%": 4, "new": 1}
    store.replace_sources(pages(spark, {"a": 1}))
    store.delete((F.col("source_file") == "b") | (F.col("page_number") == 4))
    assert same(store) == {"a": 1, "ü=%": 3, "new": 1}
    store.replace_pages(pages(spark, {"late": 2}))  # the fifth write: recent rows are merged
    assert not store._has(store.recent) or store._changes().count() == 0
    assert same(store) == {"a": 1, "ü=%": 3, "new": 1, "late": 2}
    store.delete(F.lit(True))
    assert same(store) == {}


def test_a_write_that_ended_early_is_counted_later(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/pages", groups=4)
    store.replace_sources(pages(spark, {"a": 3, "b": 2}))
    store.summaries.build()
    with monkeypatch.context() as patch:
        patch.setattr(StoreSummaries, "_count", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace_pages(pages(spark, {"c": 2}))
    assert same(store) == {"a": 3, "b": 2, "c": 2}  # a reader counts it
    with monkeypatch.context() as patch:
        patch.setattr(StoreSummaries, "_count", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.delete(F.col("source_file") == "a")
    store.replace_pages(pages(spark, {"d": 1}))  # so does the next write
    assert same(store) == {"b": 2, "c": 2, "d": 1}
    with monkeypatch.context() as patch:  # a mark whose write never came
        patch.setattr(StoreSummaries, "settle", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace_pages(pages(spark, {"e": 1}))
    store.summaries.settle()
    files, mark = store._folder(f"{store.summaries.due}/99")
    files.mkdirs(mark)
    assert same(store) == {"b": 2, "c": 2, "d": 1}


def test_listings_read_no_pages(spark, tmp_path):
    library = Library(spark, f"{tmp_path}/library", groups=8)
    library.ingest(pages(spark, {"a": 3, "b": 2}).drop("chunk_id"))
    before = [sorted(library.stats().collect()), sorted(library.list_documents().collect()), library.document_info("a").collect()]
    library.keep_summaries()
    frames = [library.stats(), library.list_documents(), library.document_info("a")]
    assert [sorted(frame.collect()) for frame in frames] == before
    for frame in (*frames, library.list_documents("b")):
        files = frame.inputFiles()
        assert files and all("/summaries/" in name for name in files)
    assert library.document_info("nope").collect() == []


def test_documents_by_number(spark, tmp_path):
    for groups in (None, 8):
        library = Library(spark, f"{tmp_path}/{groups}", groups=groups)
        library.ingest(pages(spark, {"a": 3, "b": 2}).drop("chunk_id"))
        number = spark.range(1).select(F.xxhash64(F.lit("b"))).first()[0]
        assert library.document_info(number).collect()[0][1:] == library.document_info("b").collect()[0][1:]
        assert library.document_info(number).first().document_id == number
        assert library.document_info(7).collect() == []
