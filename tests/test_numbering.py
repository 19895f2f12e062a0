import random

import pytest
from pyspark.sql import functions as F

from folioscope.operators import running
from folioscope.operators.chunking import (
    assign_chunks,
    assign_chunks_by_words,
    manifest,
    manifest_from_counts,
    manifest_header,
)
from folioscope.sources.paged import page_table, read_paged_files, split_pages


def keys(spread, seed=3, n=3000):
    """Rows of three sources; one of them holds most rows. Keys up to ``spread``."""
    rng = random.Random(seed)
    rows = set()
    while len(rows) < n:
        rows.add((rng.choice("aaaaab") if rng.random() < 0.9 else "c", rng.randrange(-spread, spread)))
    return [(s, k, rng.randrange(0, 50)) for s, k in rows]


@pytest.mark.parametrize("spread,key_bits", [(5_000, 34), (5_000, 63), (1 << 40, 48), (1 << 40, 63), (1 << 62, 63)])
def test_numbers_and_totals_equal_plain_loops(spark, spread, key_bits):
    rows = keys(spread)
    frame = spark.createDataFrame(rows, "s string, k long, v int").repartition(7)
    numbered = running.row_numbers(frame, ["s"], "k", "n", key_bits)
    both = running.running_total(numbered, ["s"], "k", "before", F.col("v"), key_bits)
    expected, count, total = {}, {}, {}
    for s, k, v in sorted(rows):
        count[s] = count.get(s, 0) + 1
        expected[s, k] = (count[s], total.get(s, 0))
        total[s] = total.get(s, 0) + v
    got = {(r.s, r.k): (r.n, r.before) for r in both.collect()}
    assert got == expected


def test_no_window_over_a_whole_source(spark):
    frame = spark.range(10).select(F.lit("a").alias("s"), F.col("id").alias("k"), F.lit("x").alias("text"))
    plan = running.row_numbers(frame, ["s"], "k", "n")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert len(windows) == 1 and "__bucket" in windows[0].split("specifiedwindowframe")[0]


def test_keys_beyond_the_stated_bits_fail(spark):
    frame = spark.createDataFrame([("a", 1 << 34), ("a", 2)], "s string, k long")
    with pytest.raises(Exception, match="larger key_bits"):
        running.row_numbers(frame, ["s"], "k", "n").collect()
    assert running.row_numbers(frame, ["s"], "k", "n", key_bits=63).count() == 2


def test_hashed_ids_make_no_window_of_a_whole_source(spark):
    rows = spark.range(200_000).select(F.lit("a").alias("s"), F.xxhash64("id").alias("k"))
    numbered = running.row_numbers(rows, ["s"], "k", "n", key_bits=63)
    assert tuple(numbered.agg(F.max("n"), F.count_distinct("n")).first()) == (200_000, 200_000)


def test_manifest_and_header_agree_where_pages_are_missing(spark):
    frame = spark.createDataFrame([("a", p) for p in (1, 3, 50)], "source_file string, page_number int")
    chunks = manifest(frame, 20).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.start_page, r.end_page, r.page_count) for r in chunks] == [
        (0, 1, 20, 20),
        (1, 21, 40, 20),
        (2, 41, 50, 10),
    ]
    assert tuple(manifest_header(frame, 20).first()) == ("a", 50, 20, 3)


def test_missing_key_fails(spark):
    frame = spark.createDataFrame([("a", None, "x"), ("a", 1, "y")], "source string, k long, text string")
    with pytest.raises(Exception, match="must not be NULL"):
        page_table(frame, "source", "k").collect()


def page_rows(spark, counts):
    rows = [(s, p) for s, n in counts.items() for p in range(1, n + 1)]
    return spark.createDataFrame(rows, "source_file string, page_number int")


@pytest.mark.parametrize(
    "pages,size,expected",
    [
        (100, 20, [(i, i * 20 + 1, i * 20 + 20, 20) for i in range(5)]),
        (5, 2, [(0, 1, 2, 2), (1, 3, 4, 2), (2, 5, 5, 1)]),
        (5, 5, [(0, 1, 5, 5)]),
        (1, 20, [(0, 1, 1, 1)]),
        (0, 20, []),
    ],
)
def test_manifest(spark, pages, size, expected):
    frame = page_rows(spark, {"book": pages})
    counts = spark.createDataFrame([("book", pages)], "source_file string, total_pages long")
    for chunks in (manifest(frame, size), manifest_from_counts(counts, size)):
        rows = chunks.orderBy("chunk_id").collect()
        assert [(r.chunk_id, r.start_page, r.end_page, r.page_count) for r in rows] == expected
        assert all(r.path == f"chunk_{r.chunk_id:04d}" for r in rows)


def test_manifest_from_counts_of_a_long_source(spark):
    counts = spark.createDataFrame([("long", 100_001), ("none", 0)], "source_file string, total_pages long")
    chunks = manifest_from_counts(counts, 10).cache()
    assert chunks.count() == 10_001
    row = chunks.agg(F.sum("page_count").alias("pages"), F.count_distinct("chunk_id").alias("ids")).first()
    assert (row.pages, row.ids) == (100_001, 10_001)


def test_header(spark):
    rows = manifest_header(page_rows(spark, {"a": 5, "b": 4}), 2).orderBy("source_file").collect()
    assert [tuple(r) for r in rows] == [("a", 5, 2, 3), ("b", 4, 2, 2)]


@pytest.mark.parametrize("size", [0, -1])
def test_chunk_size_is_positive(spark, size):
    frame = page_rows(spark, {"a": 1})
    for function in (assign_chunks, manifest, manifest_header, assign_chunks_by_words):
        with pytest.raises(ValueError):
            function(frame, size)


def test_chunks_by_words(spark):
    rows = [("a", p, w) for p, w in enumerate([4, 4, 4, 30, 0, 1], 1)]
    frame = spark.createDataFrame(rows, "source_file string, page_number int, word_count int")
    got = assign_chunks_by_words(frame, 10).orderBy("page_number").collect()
    assert [r.words_before for r in got] == [0, 4, 8, 12, 42, 42]
    assert [r.chunk_id for r in got] == [0, 0, 0, 1, 4, 4]


def test_split_pages(spark):
    frame = spark.createDataFrame(
        [("a", "one two\fthree\f"), ("b", "only"), ("c", None), ("e", ""), ("d", "x\f\fy")], "source string, text string"
    )
    got = split_pages(frame, "source", chunk_size=2).orderBy("source_file", "page_number").collect()
    assert [(r.source_file, r.page_number, r.chunk_id, r.text, r.word_count) for r in got] == [
        ("a", 1, 0, "one two", 2),
        ("a", 2, 0, "three", 1),
        ("b", 1, 0, "only", 1),
        ("d", 1, 0, "x", 1),
        ("d", 2, 0, "", 0),
        ("d", 3, 1, "y", 1),
    ]


def test_files_through_an_extractor(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first page\fsecond\f")
    (tmp_path / "b.txt").write_bytes(b"")
    (tmp_path / "c.bin").write_bytes(b"\x02")
    texts = read_paged_files(spark, str(tmp_path), pattern="*.txt").orderBy("page_number").collect()
    assert [(r.source_file.rsplit("/", 1)[1], r.page_number, r.text, r.word_count) for r in texts] == [
        ("a.txt", 1, "first page", 2),
        ("a.txt", 2, "second", 1),
    ]

    def extractor(content):
        return [None] * content[0]

    blank = read_paged_files(spark, str(tmp_path), extractor, pattern="*.bin").collect()
    assert [(r.text, r.word_count, r.char_count) for r in blank] == [("", 0, 0)] * 2
