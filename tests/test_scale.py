"""Vector codes, the neighbour graph, greedy chunks, split files and arriving books."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.operators import graph, packing, quantised
from folioscope.operators.approximate import recall
from folioscope.operators.blocks import batch_top_k
from folioscope.operators.search import top_k
from folioscope.plans import inputs, queries
from folioscope.sources.paged import read_page_text, split_pages
from folioscope.sources.vectors import VectorCache
from folioscope.streaming import books

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vectors(spark):
    return inputs.embeddings(spark, FOLDER).cache()


def test_codes_find_the_exact_hits(spark, vectors, tmp_path):
    index = quantised.CodeIndex.build(vectors, f"{tmp_path}/codes", ["vec_id"])
    asked = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = batch_top_k(vectors, asked, 5, key=["vec_id"])
    assert recall(index.batch_top_k(asked, 5, 60), exact, ["query_id", "vec_id"]).first()[0] >= 0.9
    every = index.batch_top_k(asked, 5, vectors.count())
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.collect()))
    query = inputs.query_vector(spark, FOLDER, 7)
    found = index.top_k(query, 5).select("vec_id", "similarity", "rank").collect()
    assert found == top_k(vectors, query, 5, key=["vec_id"]).select("vec_id", "similarity", "rank").collect()
    with pytest.raises(ValueError, match="dimensions"):
        index.top_k([1.0], 5)
    plan = index.top_k(query, 1, 20)._jdf.queryExecution().executedPlan().toString()
    assert "In(vec_id, [" in plan.split("PushedFilters:")[1]
    assert index.codes.agg(F.max(F.length("code"))).first()[0] == 16


def test_codes_of_added_and_odd_rows(spark, vectors, tmp_path):
    index = quantised.CodeIndex.build(vectors.filter("vec_id % 2 = 0"), f"{tmp_path}/codes", ["vec_id"])
    index.add(vectors.filter("vec_id % 2 = 1"))
    schema = vectors.select("vec_id", "embedding").schema
    index.add(spark.createDataFrame([(-1, [0.0] * 64), (-2, None), (-3, [1.0])], schema))
    assert index.codes.count() == index.vectors.count() == vectors.count() + 3
    assert index.codes.filter("code IS NULL").count() == 3
    query = inputs.query_vector(spark, FOLDER, 9)
    assert [r.vec_id for r in index.top_k(query, 3).collect()] == [r.vec_id for r in top_k(vectors, query, 3, key=["vec_id"]).collect()]
    none = quantised.CodeIndex.build(vectors.limit(0), f"{tmp_path}/none", ["vec_id"])
    assert none.codes.count() == 0


def test_neighbour_graph(spark, vectors):
    exact = queries._similar(spark, FOLDER).cache()
    found, cost = graph.neighbour_graph(vectors, "vec_id", 3)
    assert recall(found, exact, ["query_id", "vec_id"]).first()[0] >= 0.9
    assert found.count() == 3 * vectors.count() and cost["rows"] == vectors.count()
    right = exact.join(found.select("query_id", "vec_id", F.col("similarity").alias("s")), ["query_id", "vec_id"])
    assert right.filter("abs(similarity - s) > 1.5e-6").count() == 0


def test_comparisons_a_row_do_not_grow(spark):
    """Clustered rows, a third of them equal: a hot place in every projection."""
    rng = np.random.default_rng(1)
    costs = []
    for count in (600, 2400):
        centres = rng.normal(size=(count // 20, 8))
        rows = [(i, [float(x) for x in (centres[0] if i % 3 == 0 else centres[i % len(centres)] + 0.1 * rng.normal(size=8))]) for i in range(count)]
        frame = spark.createDataFrame([*rows, (-1, [0.0] * 8), (-2, None)], "vec_id long, embedding array<double>")
        found, cost = graph.neighbour_graph(frame, "vec_id", 2, width=8)
        costs.append(cost["comparisons"])
        exact = batch_top_k(frame.filter("vec_id >= 0"), frame.filter("vec_id % 40 = 1").withColumnRenamed("vec_id", "query_id"), 3, key=["vec_id"])
        exact = exact.filter("query_id <> vec_id AND query_id % 3 <> 0")  # equal rows have many equal neighbours
        assert recall(found.filter("query_id % 40 = 1"), exact, ["query_id", "vec_id"]).first()[0] >= 0.9
    assert costs[1] < 1.6 * costs[0]


def test_rows_that_met_are_not_compared_again(spark):
    rows = [(1, i, [1.0, float(i)], -2.0, i > 2) for i in range(1, 5)]
    held = spark.createDataFrame(rows, "place long, id long, vector array<double>, floor double, fresh boolean").coalesce(1)
    found = {(r.id, r.near) for r in graph._local_join(held, 2, 8, False).collect()}
    assert found == {(a, b) for a in range(1, 5) for b in range(1, 5) if a != b and {a, b} != {1, 2}}
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(500)], "vec_id long, embedding array<double>")
    costs = [graph.neighbour_graph(frame, "vec_id", 2, width=8, rounds=rounds)[1]["comparisons"] for rounds in (0, 1, 3)]
    assert costs[2] - costs[1] < costs[1] - costs[0]


def greedy(words, budget):
    out, used, chunk = [], 0, -1
    for n in words:
        if chunk < 0 or used + n > budget:
            used, chunk = 0, chunk + 1
        used += n
        out.append(chunk)
    return out


@pytest.mark.parametrize("partitions", [None, 1, 17])
def test_greedy_chunks(spark, partitions):
    rng = random.Random(partitions or 0)
    sources = {"hot": 900, "one": 1, "few": 7, "blank": 60, "large": 40}
    words = {s: [rng.choice([0, 0, rng.randint(1, 30), rng.randint(1, 120)]) for _ in range(n)] for s, n in sources.items()}
    words["blank"] = [0] * 60
    words["large"] = [150] * 20 + [0] * 5 + [100] * 15
    rows = [(s, p, n, "x") for s, column in words.items() for p, n in enumerate(column, 1)]
    pages = spark.createDataFrame(rows, "source_file string, page_number int, word_count int, text string").repartition(4)
    found = packing.assign_chunks_greedily(pages, 100, partitions).collect()
    chunks = {(r.source_file, r.page_number): r.chunk_id for r in found}
    assert len(found) == len(rows)
    for source, column in words.items():
        assert [chunks[source, p] for p in range(1, len(column) + 1)] == greedy(column, 100), source
    assert packing.assign_chunks_greedily(pages.limit(0), 5).count() == 0


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(2)
    texts = {"big": "\f".join(f"page {p}\n" + "é word " * rng.randint(0, 400) for p in range(3000)) + "\f", "small": "one\f\ftwo", "none": "", "break": "\f"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300k")
    try:
        pages = read_page_text(spark, str(tmp_path))
        plan_parts = spark.read.option("lineSep", "\f").text(str(tmp_path)).rdd.getNumPartitions()
        found = sorted((r.source_file.rsplit("/", 1)[1], r.page_number, r.text, r.chunk_id) for r in pages.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert plan_parts > 10
    whole = split_pages(spark.createDataFrame(list(texts.items()), "source string, text string"), "source")
    assert found == sorted((r.source_file, r.page_number, r.text, r.chunk_id) for r in whole.collect())


CHUNKS = "source_file string, num_chunks long, chunk_id long, page_count long, word_count long"


def feed(spark, base, rows, **options):
    spark.createDataFrame(rows, CHUNKS).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(CHUNKS).parquet(f"{base}/in")
    return books.merge_stream(spark, stream, f"{base}/out", f"{base}/progress", **options)


def finished(spark, base):
    return {r.source_file: tuple(r)[1:] for r in books.finished_books(spark, f"{base}/out").collect()}


def test_books_leave_with_their_last_chunk_over_restarts(spark, tmp_path):
    feed(spark, tmp_path, [("a", 3, 2, 1, 10), ("b", 1, 0, 5, 50), ("a", 3, 0, 2, 20), ("a", 3, 2, 1, 10)]).awaitTermination()
    assert finished(spark, tmp_path) == {"b": (1, 5, 50)}
    feed(spark, tmp_path, [("a", 3, 0, 2, 20), ("c", 2, 1, 1, 1), ("b", 1, 0, 5, 50)]).awaitTermination()
    assert finished(spark, tmp_path) == {"b": (1, 5, 50)}
    feed(spark, tmp_path, [("a", 3, 1, 4, 40), ("b", 1, 0, 6, 60)]).awaitTermination()  # b has a new version
    assert finished(spark, tmp_path) == {"a": (3, 7, 70), "b": (1, 6, 60)}
    assert books.told(spark, f"{tmp_path}/out").count() == 3


def test_lost_chunks_are_reported_after_a_wait(spark, tmp_path):
    query = feed(spark, tmp_path, [("a", 4, 2, 1, 10), ("a", 4, 0, 1, 10), ("b", 1, 0, 5, 50)], wait_ms=1500)
    try:
        end = time.time() + 60
        while time.time() < end and not query.exception():
            time.sleep(1)
            if query.lastProgress and len(books.told(spark, f"{tmp_path}/out").filter("status = 'missing'").collect()) >= 2:
                break
    finally:
        query.stop()
    assert {tuple(r) for r in books.lost_chunks(spark, f"{tmp_path}/out").collect()} == {("a", 1), ("a", 3)}
    assert finished(spark, tmp_path) == {"b": (1, 5, 50)}


def test_one_call_of_the_model_for_each_distinct_text(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<float>")
    def model(text):
        calls.add(1)
        return [float(len(text)), 1.0]

    cache = VectorCache(spark, f"{tmp_path}/kept", lambda text: model(F.col(text)))
    rows = [(i, None if i % 7 == 0 else f"text {i % 5}") for i in range(70)]
    frame = spark.createDataFrame(rows, "n int, text string").repartition(4)
    for _ in range(3):
        found = cache.embedded(frame).collect()
        assert len(found) == 70 and all(r.embedding == [float(len(r.text or "")), 1.0] for r in found)
        assert calls.value == 6
    cache.embedded(spark.createDataFrame([(1, "new"), (2, "text 1")], "n int, text string")).collect()
    assert calls.value == 7 and cache.kept().count() == 7


def test_shortlists_of_some_codes_at_a_time(spark, vectors, tmp_path, monkeypatch):
    index = quantised.CodeIndex.build(vectors, f"{tmp_path}/codes", ["vec_id"])
    asked = vectors.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding")
    whole = {(r.query_id, r.rank): r.similarity for r in index.batch_top_k(asked, 5).collect()}
    monkeypatch.setattr(quantised, "HELD_CODES", 100)
    monkeypatch.setattr(quantised, "HELD_HITS", 500)
    # A shortlist from every hundred codes or more finds what one of all codes does.
    assert {(r.query_id, r.rank): r.similarity for r in index.batch_top_k(asked, 5).collect()} == whole
