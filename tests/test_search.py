import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioscope.functions.embedding import embed_words
from folioscope.functions.matrices import pair_scores
from folioscope.functions.vectors import search_similarity
from folioscope.operators import approximate, results
from folioscope.operators import blocks
from folioscope.operators.blocks import batch_top_k
from folioscope.operators.search import attach_rows, semantic_search, top_k
from folioscope.plans import inputs
from folioscope.plans import queries as registered

KEY = ["source_file", "page_number"]
SCHEMA = "source_file string, page_number int, embedding array<float>"


def brute(rows, query, k, threshold=None):
    """Plain loops: score all, sort by (rounded score descending, missing last, key)."""
    scored = []
    for source, page, vector in rows:
        score = None
        if vector is not None and len(vector) == len(query):
            a, b = np.array(vector, dtype=float), np.array(query, dtype=float)
            scale = np.sqrt(a @ a) * np.sqrt(b @ b)
            score = float(a @ b / scale) if scale > 0 else None
            score = None if score is None or np.isnan(score) else score
        if threshold is not None and (score is None or score < threshold):
            continue
        scored.append((source, page, None if score is None else round(score, 6)))
    scored.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))
    return [(s, p, v, i) for i, (s, p, v) in enumerate(scored[:k], 1)]


def fixture(n=400, dim=6, seed=5):
    """Random vectors; a third are copies of one vector, some are zero, missing, short or NaN."""
    rng = np.random.default_rng(seed)
    hot = rng.normal(size=dim)
    rows = []
    for i in range(n):
        vector = [float(x) for x in np.float32(hot if i % 3 == 0 else rng.normal(size=dim))]
        if i % 50 == 1:
            vector = [0.0] * dim
        if i % 50 == 2:
            vector = None
        if i % 50 == 4:
            vector = vector[:-1]
        if i % 50 == 5:
            vector[0] = float("nan")
        rows.append((f"s{i % 4}", i, vector))
    return rows, [float(x) for x in np.float32(hot)]


@pytest.fixture(scope="module")
def table(spark):
    rows, hot = fixture()
    return rows, hot, spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def taken(frame, *names):
    return [tuple(r) for r in frame.select(*KEY, *names, "similarity", "rank").orderBy("rank").collect()]


def same(got, expected):
    assert [(g[0], g[1], g[3]) for g in got] == [(e[0], e[1], e[3]) for e in expected]
    assert np.allclose(
        [np.nan if g[2] is None else g[2] for g in got],
        [np.nan if e[2] is None else e[2] for e in expected],
        equal_nan=True,
        atol=1.5e-6,
    )


@pytest.mark.parametrize("k", [0, 1, 5, 200, 1000])
def test_top_k(table, k):
    rows, hot, frame = table
    same(taken(top_k(frame, hot, k)), brute(rows, hot, k))


def test_top_k_in_the_jvm_is_the_same(table):
    rows, hot, frame = table
    same(taken(top_k(frame, hot, 9, score=search_similarity)), brute(rows, hot, 9))


def test_scores_are_computed_once(table):
    _, hot, frame = table
    plan = top_k(frame, hot, 9, source="s1", threshold=0.3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_threshold_is_inclusive_and_drops_missing(spark):
    frame = spark.createDataFrame(
        [("a", 1, [1.0, 0.0]), ("a", 2, [0.0, 1.0]), ("a", 3, [0.0, 0.0]), ("a", 4, None), ("a", 5, [3.0, 4.0])],
        SCHEMA,
    )
    assert [r.page_number for r in semantic_search(frame, [1.0, 0.0], 9, 0.0).orderBy("rank").collect()] == [1, 5, 2]
    assert [r.page_number for r in semantic_search(frame, [1.0, 0.0], 9, 1.0).collect()] == [1]
    assert semantic_search(frame, [0.0, 0.0], 9, 0.0).count() == 0


@pytest.mark.parametrize("source", ["s1", "unknown"])
def test_source_filter(table, source):
    rows, hot, frame = table
    expected = brute([r for r in rows if r[0] == source], hot, 5)
    same(taken(top_k(frame, hot, 5, source=source)), expected)


@pytest.mark.parametrize("source", [None, ""])
def test_no_source_means_all(table, source):
    rows, hot, frame = table
    same(taken(top_k(frame, hot, 7, source=source)), brute(rows, hot, 7))


def queries(rows, hot):
    """Vectors of the table, of every kind: also short ones, missing ones and NaN."""
    asked = [(i, r[2]) for i, r in enumerate(rows)][:60]
    return [*asked, (1000, hot), (1001, [0.0] * len(hot)), (1002, [])]


@pytest.mark.parametrize("cut", [None, (9, 5), (1, 1)])
@pytest.mark.parametrize("k,threshold", [(1, None), (7, None), (500, None), (7, 0.3)])
def test_batch_equals_brute_force_both_ways(spark, table, cut, k, threshold):
    rows, hot, frame = table
    asked = queries(rows, hot)
    question_frame = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    hits = batch_top_k(frame, question_frame, k, threshold, blocks=cut)
    got = {}
    for r in hits.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.source_file, r.page_number, r.similarity, r["rank"]))
    for query_id, vector in asked:
        same(got.get(query_id, []), brute(rows, vector if vector is not None else [], k, threshold))


@pytest.mark.parametrize("cut", [None, (2, 3)])
def test_batch_with_a_source_for_each_query(spark, table, cut):
    rows, hot, frame = table
    asked = [(0, hot, "s1"), (1, hot, None), (2, hot, ""), (3, hot, "unknown"), (4, rows[9][2], "s3")]
    asked_frame = spark.createDataFrame(asked, "query_id long, embedding array<float>, wanted string")
    got = {}
    for r in batch_top_k(frame, asked_frame, 6, source="wanted", blocks=cut).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.source_file, r.page_number, r.similarity, r["rank"]))
    for query_id, vector, source in asked:
        same(got.get(query_id, []), brute([r for r in rows if not source or r[0] == source], vector, 6))


def test_single_and_batch_search_agree_to_the_last_place(spark):
    # Unit vectors (a, b) against (1, 0): scores on half units of the sixth place.
    rows = []
    for i in range(400):
        a = (2 * i + 1) / 2e6 + 0.25
        rows.append(("s", i, [a, float(np.sqrt(1 - a * a))]))
    rows += [("s", 900, [1e39, 1e38]), ("s", 901, [1e-30, 1e-31]), ("s", 902, [float("inf"), 1.0])]
    frame = spark.createDataFrame(rows, "source_file string, page_number int, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    single = taken(top_k(frame, [1.0, 0.0], 403))
    assert single == taken(batch_top_k(frame, asked, 403)) == taken(batch_top_k(frame, asked, 403, blocks=(2, 3)))
    assert single[:2] == [("s", 900, single[0][2], 1), ("s", 901, single[0][2], 2)]
    assert single[-1][1:3] == (902, None)


def test_too_many_query_bytes_are_refused(spark, table, monkeypatch):
    _, hot, frame = table
    monkeypatch.setattr(blocks, "MAX_QUERY_BYTES", 100)
    asked = spark.createDataFrame([(i, hot) for i in range(9)], "query_id long, embedding array<float>")
    with pytest.raises(ValueError, match="pass blocks"):
        batch_top_k(frame, asked, 5)
    assert batch_top_k(frame, asked, 5, blocks=blocks.blocks_for(frame, asked)).count() == 45


def test_batch_of_nothing(spark, table):
    _, hot, frame = table
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert batch_top_k(frame, none, 5).count() == 0
    one = spark.createDataFrame([(1, hot)], "query_id long, embedding array<float>")
    assert batch_top_k(frame, one, 0).count() == 0
    assert batch_top_k(frame.limit(0), one, 5).count() == 0


def test_batch_emits_few_rows_per_task(table, spark):
    _, hot, frame = table
    one = spark.createDataFrame([(1, hot)], "query_id long, embedding array<float>")
    plan = batch_top_k(frame, one, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_attach_rows(spark, table):
    _, hot, frame = table
    hits = top_k(frame, hot, 6)
    rows = frame.select(F.concat("source_file", F.lit("!")).alias("text"), *KEY)
    got = attach_rows(hits, rows)
    assert got.columns == [*hits.columns, "text"]
    assert got.count() == 6
    assert all(r.text == r.source_file + "!" for r in got.collect())
    assert attach_rows(hits.limit(0), rows).count() == 0


def sentences(spark, rows):
    frame = spark.createDataFrame(rows, "source_file string, page_number int, text string")
    return frame.withColumn("embedding", embed_words("text"))


def ask(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    return frame.withColumn("embedding", embed_words("text"))


def invented(topic, count):
    """Words that no other topic has."""
    return [f"{topic}{n}word" for n in range(count)]


def test_shared_words_decide_the_order(spark):
    # Page n of a topic has n of the ten words that the query has, and fillers to the same length.
    pages = []
    for topic in ("p", "q"):
        for n in (2, 6, 10):  # far enough apart for words that share a bucket
            pages.append((topic, n, " ".join(invented(topic, n) + invented(f"{topic}{n}filler", 10 - n))))
    for topic in ("p", "q"):
        hits = batch_top_k(sentences(spark, pages), ask(spark, " ".join(invented(topic, 10))), 2).orderBy("rank")
        assert [(r.source_file, r.page_number) for r in hits.collect()] == [(topic, 10), (topic, 6)]


def test_agreement(spark):
    words = invented("x", 8)
    pages = sentences(spark, [("a", 1, " ".join(words)), ("a", 2, " ".join(invented("y", 8)))])
    # Any part of a page's words finds this page, so three parts agree; parts of two pages do not.
    parts = [" ".join(words[at : at + 3]) for at in (0, 2, 5)]
    asked = ask(spark, *parts, " ".join(words[:2]), " ".join(invented("y", 2))).withColumn(
        "topic", F.when(F.col("query_id") < 3, "one").otherwise("mixed")
    )
    got = {r.topic: r for r in results.agreement(batch_top_k(pages, asked, 1), asked, KEY, "topic").collect()}
    assert got["one"].agree and got["one"].num_queries == 3 and got["one"].top_rows == 1
    assert not got["mixed"].agree and got["mixed"].num_queries == 2


def test_precision(spark):
    hits = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 12, 1), (4, 99, 1), (4, 98, 2), (4, 10, 3)],
        "query_id int, vec_id int, rank int",
    )
    labels = spark.createDataFrame([(10, "x"), (11, "x"), (12, "y"), (98, None)], "vec_id int, label string")
    asked = spark.createDataFrame([(n, "x") for n in (1, 2, 3, 4)], "query_id int, expected_label string")
    got = {r.query_id: r for r in results.precision(hits, labels, asked, ["vec_id"]).collect()}
    assert (got[1].num_results, got[1].precision, got[1].top_hit_right) == (3, 0.666667, True)
    assert (got[2].num_results, got[2].precision, got[2].top_hit_right) == (1, 0.0, False)
    assert (got[3].num_results, got[3].precision, got[3].top_hit_right) == (0, 0.0, False)
    assert (got[4].num_results, got[4].precision, got[4].top_hit_right) == (3, 0.333333, False)


def test_compare(spark):
    hits = spark.createDataFrame(
        [(1, "b", 2, 0.5), (1, "a", 1, 0.9), (1, "c", 3, None)],
        "query_id int, page string, rank int, similarity double",
    )
    asked = spark.createDataFrame([(1,), (2,)], "query_id int")
    rows = {r.query_id: tuple(r) for r in results.compare_results(hits, asked, ["page"]).collect()}
    assert rows == {1: (1, 3, 0.466667, "a"), 2: (2, 0, 0.0, None)}
    nested = {r.query_id: r for r in results.compare_results(hits, asked, ["page"], nested=True).collect()}
    assert [(hit["rank"], hit.page) for hit in nested[1].results] == [(1, "a"), (2, "b"), (3, "c")]
    assert nested[2].results == []


def test_context(spark):
    hits = spark.createDataFrame([(1, 2, "second"), (1, 1, "first")], "query_id int, rank int, text string")
    row = results.context_by_query(hits).withColumn("p", results.prompt(F.lit("why?"))).first()
    assert row.context == "first\nsecond"
    assert row.p == "Context: first\nsecond\nQuestion: why?\nAnswer:"


def test_fusion(spark):
    schema = "source_file string, page_number int, rank long"
    left = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], schema)
    right = spark.createDataFrame([("a", 2, 1), ("a", 3, 2)], schema)
    got = results.fuse(left, right, KEY, 5).orderBy("rank").collect()
    assert [r.page_number for r in got] == [2, 1, 3]
    assert got[0].score == round(1 / 62 + 1 / 61, 9)


def test_neighbours_without_self(spark):
    rows = [(i, [1.0, 0.0]) for i in range(5)] + [(9, [0.0, 1.0])]
    copies = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    asked = copies.select(F.col("vec_id").alias("query_id"), "embedding")
    hits = results.without_self(batch_top_k(copies, asked, 3, key=["vec_id"]), "vec_id", 2)
    got = {}
    for r in hits.orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert got[0] == [(1, 1), (2, 2)] and got[1] == [(1, 0), (2, 2)] and got[4] == [(1, 0), (2, 1)]
    assert got[9] == [(1, 0), (2, 1)]


def cells_fixture(spark, seed=2):
    rng = np.random.default_rng(seed)
    rows = [("s", i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(300)]
    rows += [("s", 999, [0.0] * 8), ("s", 998, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_cells(spark, tmp_path):
    rows, frame = cells_fixture(spark)
    index = approximate.CellIndex.build(frame, f"{tmp_path}/cells", cells=6)
    query = rows[7][2]
    same(taken(index.top_k(query, 400, probes=6)), brute(rows, query, 400))
    one = index.top_k(query, 3, probes=1)
    assert one.filter("rank = 1").first().page_number == 7
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "cell" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    again = approximate.CellIndex.load(spark, f"{tmp_path}/cells")
    assert taken(again.top_k(query, 3, probes=1)) == taken(one)


def test_rows_added_to_cells(spark, tmp_path):
    rows, frame = cells_fixture(spark)
    index = approximate.CellIndex.build(frame.filter("page_number % 3 = 0"), f"{tmp_path}/cells", cells=5, fit_rows=60)
    index.add(frame.filter("page_number % 3 <> 0"))
    assert index.rows.count() == len(rows)
    assert index.rows.filter("cell = -1").count() == 2
    same(taken(index.top_k(rows[8][2], 9, probes=5)), brute(rows, rows[8][2], 9))


@pytest.mark.parametrize("parts", [1, 3])
def test_batch_over_cells(spark, tmp_path, parts):
    rows, frame = cells_fixture(spark)
    index = approximate.CellIndex.build(frame, f"{tmp_path}/cells", cells=6)
    asked = frame.filter("page_number < 40").selectExpr("cast(page_number AS long) query_id", "embedding")
    whole = index.batch_top_k(asked, 4, 6, parts=parts)
    for query_id in (0, 7, 39):
        same(taken(whole.filter(F.col("query_id") == query_id)), brute(rows[:300], rows[query_id][2], 4))
    exact = batch_top_k(frame, asked, 4)
    few = index.batch_top_k(asked, 4, 2, parts=parts)
    key = ["query_id", "page_number"]
    assert 0.5 < approximate.recall(few, exact, key).first().recall <= 1
    assert approximate.recall(whole, exact, key).first().recall == 1


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_registered_probes_reach_the_recall_of_an_index(spark, tmp_path, folder):
    rows = inputs.embeddings(spark, folder)
    index = approximate.CellIndex.build(rows, f"{tmp_path}/cells", registered.CELLS)
    asked = rows.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding")
    found = index.batch_top_k(asked, 5, registered.PROBES, key=["vec_id"])
    exact = batch_top_k(rows, asked, 5, key=["vec_id"])
    assert approximate.recall(found, exact, ["query_id", "vec_id"]).first().recall >= 0.9


def test_topics_follow_direction(spark):
    rows = [("s", i, [1.0 + i % 3, 0.01 * i]) for i in range(20)] + [("s", 100 + i, [0.01 * i, 1.0 + i]) for i in range(20)]
    got = approximate.topics(spark.createDataFrame(rows, SCHEMA), 2)[0].collect()
    first = {r.topic for r in got if r.page_number < 100}
    second = {r.topic for r in got if r.page_number >= 100}
    assert len(got) == 40 and len(first) == len(second) == 1 and first != second


def test_queries_of_a_cell_come_in_blocks(spark, tmp_path, monkeypatch):
    """With all cells probed every query is in each cell; none is told all of them at once."""
    rows, frame = cells_fixture(spark)
    index = approximate.CellIndex.build(frame, f"{tmp_path}/cells", cells=6)
    asked = frame.filter("page_number < 200").selectExpr("cast(page_number AS long) query_id", "embedding")
    met = []
    monkeypatch.setattr(approximate, "BLOCK_QUERIES", 32, raising=False)
    plain = approximate.meet
    monkeypatch.setattr(approximate, "meet", lambda left, right, *rest: met.append(right) or plain(left, right, *rest))
    found = index.batch_top_k(asked, 4, 6, parts=2)
    most = met[0].groupBy("__row_block", "__query_block").count().agg(F.max("count")).first()[0]
    assert most < 100
    for query_id in (0, 7, 39, 150):
        same(taken(found.filter(F.col("query_id") == query_id)), brute(rows[:300], rows[query_id][2], 4))


def test_rows_that_tie_are_scored_some_at_a_time(monkeypatch):
    block = pa.table({"query_id": pa.array([1]), "__query_vector": pa.array([[1.0, 2.0]], pa.list_(pa.float64()))})
    sizes = []

    def scores(rows, queries):
        sizes.append(len(rows))
        return pair_scores(rows, queries)

    monkeypatch.setattr(blocks, "pair_scores", scores)
    best = blocks._Best(block, 3, ["id"], None, None)
    best.add(pa.table({"id": np.arange(50_000)[::-1]}), pa.array([[2.0, 4.0]] * 50_000, pa.list_(pa.float32())))
    assert max(sizes) <= 1 << 14
    assert best.result().column("id").to_pylist() == [0, 1, 2]
