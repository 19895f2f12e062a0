"""Scores on held-out labels; what may not matter does not; odd tables."""

import zlib

import numpy as np
import odd

from folioscope.llm import compression, queries

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def test_query(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = queries.op12_quality_compression(spark, FOLDER).collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [row for row in rows if row.held_out and row.doc_id in labels]
    good = [row.predicted for row in held if labels[row.doc_id] == 1]
    bad = [row.predicted for row in held if labels[row.doc_id] == 0]
    assert len(bad) > 100
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1
    # Calibrated: the mean score is the share of good texts, and so it is in the upper half.
    truth = np.array([labels[row.doc_id] for row in held])
    score = np.array([row.score for row in held])
    assert abs(score.mean() - truth.mean()) < 0.02
    assert np.mean((score - truth) ** 2) < 0.02


def small(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return documents, spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    documents, labels = small(spark)
    known = compression.learn(documents, labels)
    held = compression.is_held_out(labels["doc_id"])
    other = labels.select("doc_id", (labels.quality.bitwiseXOR(held.cast("int"))).alias("quality"), "toxic")
    changed = documents.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source", "0 AS n_chars")
    again = compression.learn(changed, other)
    assert (again.bad, again.good) == (known.bad, known.good)
    assert np.array_equal(again.curve.weights, known.curve.weights)


def test_windows_cover_the_text_and_excerpts_are_bounded():
    for size in (0, 1, 499, 750, 751, 1000, 123_457):
        data = bytes(i * 7 % 251 for i in range(size))
        cut = compression.windows_of(data)
        assert b"".join(cut) == data
        assert max(map(len, cut)) - min(map(len, cut)) <= 1 and max(map(len, cut)) <= compression.WINDOW * 1.5
        assert len(compression.excerpt_of(data)) <= compression.EXCERPT_BYTES + 4


def test_differences_point_to_the_dictionary():
    bad = "".join(f"$$$ {n * 7919 % 1000} &&& ###\n" for n in range(200))
    good = "".join(f"The {n * 104729 % 1000} ships sailed on.\n" for n in range(200))
    both = compression.Compressors(bad.encode(), good.encode())
    assert both.measure(good[500:1500])[0] > 0.1 > -0.1 > both.measure(bad[500:1500])[0]
    assert both.measure("")[0] == 0


def test_curve_tells_overlapping_and_separable_classes():
    rng = np.random.default_rng(2)
    apart = rng.normal(size=4000)
    measures = np.stack([apart, rng.uniform(size=4000), rng.uniform(2, 9, 4000)], axis=1)
    chance = 1 / (1 + np.exp(-2 * apart))
    target = (rng.uniform(size=4000) < chance).astype(float)
    assert np.abs(compression.Curve.fit(measures, target).score(measures) - chance).mean() < 0.02
    separable = compression.Curve.fit(measures, (apart > 0).astype(float)).score(measures)
    assert np.isfinite(separable).all() and ((separable > 0.5) == (apart > 0)).mean() > 0.99


def test_odd_documents(spark):
    documents, labels = small(spark)
    docs = odd.documents(spark, odd.ODD)
    rows = compression.score_quality(docs, labels.limit(0)).collect()
    assert len(rows) == len(odd.ODD)
    assert all(row.score == 0.5 and row.predicted == 1 for row in rows)
    wide = documents.select("doc_id", "text").unionByName(docs.select((docs.doc_id + 10_000_000).alias("doc_id"), "text"))
    some = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 7, 0), (0, 1, 0), (0, 1, 0)], LABELS)
    rows = compression.score_quality(wide, labels.unionByName(some)).collect()
    odd_rows = [row for row in rows if row.doc_id is None or row.doc_id >= 10_000_000]
    assert len(odd_rows) == len(odd.ODD) and all(0 <= row.score <= 1 for row in odd_rows)
    assert len({row.score for row in odd_rows if row.doc_id in (10_000_001, 10_000_002, None)}) <= 2
    assert all(not row.held_out for row in odd_rows if row.doc_id is None)
    assert compression.score_quality(docs.limit(0), labels).count() == 0
