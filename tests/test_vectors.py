import math

import numpy as np
import pytest

from folioscope.functions import vectors as vx
from folioscope.functions.embedding import _Buckets, embed, embed_words, hashed_words
from folioscope.functions.matrices import batch_similarity

ROWS = [
    (0, [1.0, 0.0]),
    (1, [0.0, 2.0]),
    (2, [3.0, 4.0]),
    (3, [0.0, 0.0]),
    (4, None),
    (5, [1.0, 2.0, 3.0]),
    (6, [float("nan"), 1.0]),
    (7, [-1.0, 0.0]),
    (8, [float("inf"), 1.0]),
]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(ROWS, "id int, v array<float>").cache()


@pytest.mark.parametrize("score", [vx.search_similarity, batch_similarity])
def test_search_similarity(vectors, score):
    rows = vectors.select("id", score("v", [1.0, 0.0]).alias("s")).collect()
    got = {r.id: r.s for r in rows}
    assert got[0] == 1 and got[1] == 0 and got[7] == -1
    assert math.isclose(got[2], 0.6)
    assert [got[i] for i in (3, 4, 5, 6, 8)] == [None] * 5


@pytest.mark.parametrize("score", [vx.search_similarity, batch_similarity])
def test_zero_query_has_no_similarity(vectors, score):
    rows = vectors.select(score("v", [0.0, 0.0]).alias("s")).collect()
    assert {r.s for r in rows} == {None}


def test_cosine_helper_gives_zero_for_zero(spark):
    frame = spark.createDataFrame(
        [([1.0, 2.0], [2.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0, 0.0], [0.0, 1.0])],
        "a array<float>, b array<float>",
    )
    got = [r.s for r in frame.select(vx.cosine_similarity("a", "b").alias("s")).collect()]
    assert math.isclose(got[0], 1.0) and got[1:] == [0.0, 0.0]


def test_normalize(vectors):
    got = {r.id: r.u for r in vectors.select("id", vx.normalize("v").alias("u")).collect()}
    assert np.allclose(got[2], [0.6, 0.8]) and got[3] == [0.0, 0.0] and got[4] is None


def test_checks(vectors):
    got = {
        r.id: r
        for r in vectors.select(
            "id",
            vx.has_dimension("v", 2).alias("dim"),
            vx.is_finite("v").alias("fin"),
            vx.is_zero("v").alias("zero"),
        ).collect()
    }
    assert not got[5].dim and got[0].dim
    assert not got[6].fin and not got[8].fin and got[7].fin
    assert [i for i, r in got.items() if r.zero] == [3]


def test_wrong_dimension_fails(vectors):
    with pytest.raises(Exception, match="expected 2 dimensions, not 3"):
        vectors.select(vx.checked("v", 2)).collect()


def test_embedding(spark):
    # Text n shares n of its eight words with the last one, whatever their case and order.
    words = [f"W{n}q" for n in range(8)]
    others = [" ".join(words[:n][::-1] + [f"f{n}{m}" for m in range(8 - n)]).lower() for n in (6, 2)]
    texts = ["", "   \n\t   ", None, " ".join(words), *others]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = frame.select("i", embed_words("text").alias("e")).orderBy("i").collect()
    assert all(len(r.e) == 384 for r in rows)
    for blank in rows[:3]:
        assert not any(blank.e)
    for filled in rows[3:]:
        assert math.isclose(sum(x * x for x in filled.e), 1.0, rel_tol=1e-6)
    assert np.dot(rows[3].e, rows[4].e) > np.dot(rows[3].e, rows[5].e)
    alone = hashed_words(384)()([" ".join(words).lower()])[0]
    assert np.allclose(alone, rows[3].e)


def test_model_is_loaded_once_and_skips_blanks(spark):
    def factory():
        seen = []

        def encode(texts):
            assert all(t.strip() for t in texts)
            seen.append(len(texts))
            return np.array([[len(t), len(seen)] for t in texts], dtype=float)

        return encode

    frame = spark.createDataFrame([("ab",), (" ",), ("abcd",)], "text string").coalesce(1)
    rows = frame.select(embed("text", factory, 2).alias("e")).collect()
    assert [r.e for r in rows] == [[2.0, 1.0], [0.0, 0.0], [4.0, 1.0]]


def test_model_of_wrong_dimension_fails(spark):
    frame = spark.createDataFrame([("ab",)], "text string")
    with pytest.raises(Exception, match="expected dimension 3"):
        frame.select(embed("text", hashed_words(2), 3)).collect()


def test_models_get_a_bounded_number_of_texts(spark):
    def factory():
        def encode(texts):
            if len(texts) > 512 or (len(texts) > 1 and sum(map(len, texts)) > 2 << 20):
                raise ValueError(f"{len(texts)} texts at once")
            return np.array([[len(text), 1.0] for text in texts])

        return encode

    sizes = [1, 0, 5, None, 1 << 20, (1 << 20) + 1, 3 << 20] + [7] * 3000
    texts = spark.createDataFrame([(at, size) for at, size in enumerate(sizes)], "id int, n int").coalesce(1)
    got = texts.selectExpr("id", "repeat('x', n) AS t").select("id", embed("t", factory, 2).alias("v")).collect()
    assert {r.id: r.v for r in got} == {at: [float(n), 1.0] if n else [0.0, 0.0] for at, n in enumerate(sizes)}


def test_buckets_are_kept_for_a_while():
    buckets = _Buckets(384, most=10)
    first = [buckets[f"w{at}"] for at in range(50)]
    assert len(buckets) <= 10 and [buckets[f"w{at}"] for at in range(50)] == first
    assert _Buckets(384).most <= 1 << 17
