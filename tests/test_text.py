from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.functions import text as tx

EDGES = [
    "",
    "  \n\t ",
    None,
    "one",
    " one  two\nthree\t",
    "a\x1cb\x1dc\x1ed\x1fe",
    "a\x85b\xa0c　d\x0be\x0cf",
    "zero​width stays one",
    " line sep thin  x᠎y",
    "naïve Ωmega 🎉🎉 x",
]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")


def check(spark, values):
    got = (
        texts(spark, values)
        .select(
            "i",
            tx.word_count("text").alias("w"),
            tx.char_count("text").alias("c"),
            tx.strip(tx.or_empty("text")).alias("s"),
            tx.is_blank("text").alias("b"),
            tx.words("text").alias("list"),
        )
        .orderBy("i")
        .collect()
    )
    for row, value in zip(got, values):
        value = value or ""
        assert row.w == len(value.split()), repr(value)
        assert row.c == len(value)
        assert row.s == value.strip()
        assert row.b == (not value.strip())
        assert row.list == value.split()


def test_counts_equal_python(spark):
    check(spark, EDGES)


def test_counts_equal_python_on_generated_texts(spark):
    alphabet = st.sampled_from(list(" \t\n\x0b\x1c\x85\xa0 　​﻿abé語🎉"))

    @settings(max_examples=5, deadline=None, derandomize=True)
    @given(st.lists(st.text(alphabet, max_size=30), min_size=50, max_size=50))
    def run(values):
        check(spark, values)

    run()


def test_every_python_space_separates(spark):
    # Python's own split decides what a separator is.
    spaces = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not f"a{chr(c)}b".split()[0] == f"a{chr(c)}b"]
    assert sorted(spaces) == sorted(tx.SPACES)


def test_every_character_separates_as_in_python(spark):
    check(spark, [f"a{chr(c)}b" for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000])


def test_snippets(spark):
    text = "  " + "line one\nline two " * 30
    row = texts(spark, [text, "short"]).select(
        tx.snippet("text", 200, flat=True).alias("flat"), tx.snippet("text", 100).alias("raw")
    ).collect()
    assert row[0].flat == text.strip().replace("\n", " ")[:200] + "..."
    assert row[0].raw == text[:100] + "..."
    assert row[1].flat == "short..."


def test_html_text(spark):
    html = (
        "<html><style>p{}</style><SCRIPT>var x='</p>';</SCRIPT><!-- gone\n --><p>A&amp;lt; &lt;b&gt;</p>"
        "&copy;&nbsp;x&middot;y"
    )
    row = spark.createDataFrame([(html,), (None,)], "html string").select(tx.html_text("html").alias("t")).collect()
    assert row[0].t == "A&lt; <b> © x·y"
    assert row[1].t == ""


def test_iso_timestamp(spark):
    rows = spark.sql(
        "SELECT timestamp_ntz'2024-01-02 03:04:05' AS t UNION ALL SELECT timestamp_ntz'2024-01-02 03:04:05.12'"
    ).select(tx.iso_timestamp("t").alias("t"))
    assert sorted(r.t for r in rows.collect()) == ["2024-01-02T03:04:05", "2024-01-02T03:04:05.120000"]


def test_like_patterns(spark):
    frame = texts(spark, ["100% sure", "100 sure", "a_b", "axb", "back\\slash", "b"])

    def found(keyword, literal=False):
        rows = frame.filter(F.col("text").ilike(tx.like_pattern(keyword, literal))).collect()
        return sorted(r.i for r in rows)

    assert found("100%s") == [0, 1]
    assert found("100%", literal=True) == [0]
    assert found("a_b") == [2, 3]
    assert found("A_B", literal=True) == [2]
    assert found("\\", literal=True) == [4]
    assert found("\\b") == [2, 3, 4, 5]
    assert found("\\%") == [0]
