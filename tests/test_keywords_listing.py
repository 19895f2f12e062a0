import pytest
from pyspark.sql import functions as F

from folioscope.operators import keywords, listing
from folioscope.operators.rollup import chunk_metrics
from folioscope.sources import store

ROWS = [
    ("a", 1, "Harbour Price today"),
    ("a", 2, "nothing here"),
    ("b", 1, "price of 100% wool"),
    ("b", 2, "HARBOUR and price"),
    ("c", 1, None),
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(ROWS, "source_file string, page_number int, text string")
    return frame.withColumns(
        {
            "word_count": F.when(F.col("source_file") != "c", F.size(F.split("text", " "))),
            "char_count": F.length("text"),
            "chunk_id": F.lit(0).cast("long"),
            "created_at": F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(page_number)"),
        }
    ).cache()


def keys(frame):
    return [(r.source_file, r.page_number) for r in frame.orderBy("source_file", "page_number").collect()]


def test_any_keyword(pages):
    assert keys(keywords.any_keyword(pages, ["harbour", "wool"])) == [("a", 1), ("b", 1), ("b", 2)]
    assert keys(keywords.any_keyword(pages, ["harbour", "wool"], limit=2)) == [("a", 1), ("b", 1)]
    assert keys(keywords.any_keyword(pages, ["price"], source="b")) == [("b", 1), ("b", 2)]
    assert keys(keywords.any_keyword(pages, ["price"], limit=0)) == []
    assert keys(keywords.any_keyword(pages, [])) == []
    assert keys(keywords.any_keyword(pages, ["0%"], literal=True)) == [("b", 1)]


def test_each_keyword(pages):
    hits = keywords.each_keyword(pages, ["price", "HARbour", "missing", "price"], limit=2)
    got = [(r.keyword, r["rank"], r.source_file, r.page_number) for r in hits.collect()]
    assert sorted(got) == sorted(
        [("price", 1, "a", 1), ("price", 2, "b", 1)] * 2 + [("HARbour", 1, "a", 1), ("HARbour", 2, "b", 2)]
    )
    assert {r.text for r in hits.filter("source_file = 'b' AND page_number = 2").collect()} == {"HARBOUR and price..."}
    assert keywords.each_keyword(pages, []).count() == 0


def test_pages_by_number_of_matches(pages):
    hits = keywords.ranked_by_matches(pages.select("source_file", "page_number", "text"), ["price", "harbour", "wool"], 9)
    got = [(r["rank"], r.matches, r.source_file, r.page_number) for r in hits.orderBy("rank").collect()]
    assert got == [(1, 2, "a", 1), (2, 2, "b", 1), (3, 2, "b", 2)]
    assert keywords.ranked_by_matches(pages, [], 9).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 2000])
def test_a_frequent_keyword_is_ranked_in_shares(spark, limit):
    rows = spark.range(3000).selectExpr("concat('s', id % 7) source_file", "cast(id AS int) page_number", "'x' text")
    got = keywords.each_keyword(rows, ["x", "y"], limit).orderBy("rank").collect()
    expected = sorted((f"s{i % 7}", i) for i in range(3000))[:limit]
    assert [(r.source_file, r.page_number) for r in got] == expected
    plan = keywords.each_keyword(rows, ["x"], 2000)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert len(windows) == 2 and "__share" in windows[-1].split("specifiedwindowframe")[0]


def test_each_keyword_needs_no_join(pages):
    plan = keywords.each_keyword(pages, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "WindowGroupLimit" in plan


def test_listing(pages):
    got = {r.source_file: r.pages for r in listing.list_documents(pages).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}
    assert listing.list_documents(pages, "b").collect()[0].pages == 2
    assert listing.list_documents(pages, "nope").count() == 0


def test_stats_skip_missing_counts(pages):
    assert tuple(listing.table_stats(pages).first()) == (5, 3, 12)
    assert tuple(listing.table_stats(pages.limit(0)).first()) == (0, 0, 0)


def test_summary(pages):
    assert tuple(listing.document_summary(pages, "a", "source_file").first()) == ("a", 2, 5, 31)
    assert tuple(listing.document_summary(pages, "c", "source_file").first()) == ("c", 1, 0, 0)
    assert listing.document_summary(pages, "nope", "source_file").count() == 0


def test_first_page(pages):
    assert listing.first_page(pages, "b").first().page_number == 1
    assert listing.first_page(pages, "nope").count() == 0


def test_recent(pages):
    got = listing.recent_pages(pages, 3).orderBy("rank").collect()
    assert [(r.source_file, r.page_number, r.created_at) for r in got] == [
        ("a", 2, "2024-01-03T00:00:00"),
        ("b", 2, "2024-01-03T00:00:00"),
        ("a", 1, "2024-01-02T00:00:00"),
    ]


def test_pages_with_their_chunk(pages):
    joined = listing.with_document(pages, chunk_metrics(pages))
    row = joined.filter("source_file = 'a' AND page_number = 2").first()
    assert (row.word_count, row.chunk_word_count, row.end_page) == (2, 5, 2)


def test_without(pages, spark):
    assert keys(store.without_sources(pages, "_")) == []
    assert keys(store.without_sources(pages, "b%")) == [("a", 1), ("a", 2), ("c", 1)]
    gone = spark.createDataFrame([("a", 1), ("c", 1)], "source_file string, page_number int")
    assert keys(store.without_keys(pages, gone)) == [("a", 2), ("b", 1), ("b", 2)]
