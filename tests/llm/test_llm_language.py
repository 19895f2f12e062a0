"""The network: its gradient, its two forms, its held-out accuracy."""

from zlib import crc32

import numpy as np
import odd
import pytest

from folioscope.llm import language, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def predicted(spark):
    return queries.op9_language(spark, FOLDER).collect()


def test_held_out_accuracy(spark, predicted):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(predicted) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in predicted)
    held = [r for r in predicted if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in predicted)


def test_prediction_never_sees_labels(spark, predicted):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    network = language.learn(docs)
    names, scores = language.predict_batch(
        [r.text for r in docs.orderBy("doc_id").collect()], network, network.tables()
    )
    in_order = sorted(predicted, key=lambda r: r.doc_id)
    assert names == [r.lang_pred for r in in_order]
    assert np.allclose(scores, [r.score for r in in_order])


def test_pair_tables_equal_the_plain_network():
    network = language.Network.new(["a", "b", "c"])
    windows = np.random.default_rng(1).integers(0, language.CLASSES, (5, language.WINDOW)).astype(np.uint8)
    top, _ = network.pooled(windows)
    plain = language.softmax(np.maximum(top, 0) @ network.dense + network.bias)
    assert np.allclose(plain, network.probabilities(windows, network.tables()), atol=1e-5)


def test_gradient_equals_differences():
    network = language.Network.new(["a", "b"])
    windows = np.random.default_rng(2).integers(0, language.CLASSES, (4, 32)).astype(np.uint8)
    target = np.array([0, 1, 1, 0])

    def loss():
        top, _ = network.pooled(windows)
        chance = language.softmax(np.maximum(top, 0).astype(float) @ network.dense + network.bias)
        return -np.log(chance[np.arange(4), target]).mean()

    slopes = network._slopes(windows, target)
    parts = [*network.filters.values(), network.dense, network.bias]
    for part, slope in zip(parts, slopes):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before, step = part[at], 1e-3
        part[at] = before + step
        above = loss()
        part[at] = before - step
        below = loss()
        part[at] = before
        assert (above - below) / (2 * step) == pytest.approx(slope[at], rel=0.05, abs=1e-4)


def test_windows_cover_every_byte():
    for size in (0, 1, 255, 256, 257, 1000):
        windows = language.windows_of(b"a" * size)
        assert (windows == language.CLASS_OF[ord("a")]).sum() == size
        assert windows.shape == (max(1, -(-size // language.WINDOW)), language.WINDOW)


def test_odd_documents(spark):
    docs = odd.documents(spark, odd.ODD).repartition(3)
    rows = language.language_of_documents(docs).collect()
    assert len(rows) == len(odd.ODD)
    learned = {lang for _, _, lang, _ in odd.ODD} - {None}
    for row in rows:
        assert row.lang_pred in learned | {"und"}
    assert sorted(r.doc_id or 0 for r in rows if r.lang_pred == "und") == [0, 1, 2, 3]
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    kept = language.with_known_language(docs, language.learn(docs), least_score=0.0)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 6, 6, 7, 8, 9, 10, 11]


def test_nothing_to_learn_from(spark):
    docs = odd.documents(spark, [(1, "words", None, "a"), (2, "12", "en", "a"), (3, None, "en", "a")])
    assert language.learn(docs) is None
    rows = language.language_of_documents(docs).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert [r.doc_id for r in language.with_known_language(docs, None).collect()] == [1]
    assert language.language_of_documents(odd.documents(spark, [])).collect() == []


def test_held_out_rows_change_nothing_and_no_language_is_lost(spark):
    """A flood of odd rows of a language: held out, without a letter, or one id repeated."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    known = docs.filter("lang <> 'fr'")
    french = docs.filter("lang = 'fr'").filter(~language.is_held_out(docs.doc_id)).limit(20)
    french = spark.createDataFrame(french.collect(), french.schema)
    few = known.unionByName(french)
    before = language.learn(few)
    ids = spark.range(1_000_000, 1_100_000).withColumnRenamed("id", "doc_id")
    held = ids.filter(language.is_held_out(ids.doc_id)).selectExpr("doc_id", "'the same' AS text", "'fr' AS lang")
    blank = ids.selectExpr("doc_id", "'123' AS text", "'fr' AS lang")
    after = language.learn(few.unionByName(held).unionByName(blank).unionByName(french.limit(1).crossJoin(spark.range(5000)).drop("id")))
    assert before.labels == after.labels and "fr" in after.labels
    for one, two in zip([*before.filters.values(), before.dense], [*after.filters.values(), after.dense]):
        assert np.array_equal(one, two)


def test_the_bar_is_above_an_even_share(spark):
    docs = odd.documents(spark, odd.ODD)
    for labels in (["a", "b"], ["a", "b", "c"], ["a", "b", "c", "d", "e"]):
        network = language.Network.new(labels)
        network.dense[:], network.bias[:] = 0, 0  # tells nothing
        assert language.with_known_language(docs, network).count() == 0
