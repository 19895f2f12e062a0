import json

import pytest
from pyspark.sql import functions as F

from folioscope.operators import rollup
from folioscope.operators.chunking import assign_chunks, chunk_pages, manifest
from folioscope.sources import documents
from folioscope.sources.paged import with_metrics

# Fixed values: (characters, words) of six measured pages, and the roll-up in chunks of two.
SIX_PAGES = [(4196, 493), (4636, 644), (4772, 676), (4725, 661), (4469, 600), (1549, 209)]
THREE_CHUNKS = [(0, 1, 2, 2, 1137, 8833), (1, 3, 4, 2, 1337, 9498), (2, 5, 6, 2, 809, 6019)]


@pytest.fixture(scope="module")
def six(spark):
    rows = [("book", p, c, w) for p, (c, w) in enumerate(SIX_PAGES, 1)]
    frame = spark.createDataFrame(rows, "source_file string, page_number int, char_count int, word_count int")
    return assign_chunks(frame, 2)


def pages(spark, texts, source="book", size=2):
    frame = spark.createDataFrame(
        [(source, p, t) for p, t in enumerate(texts, 1)], "source_file string, page_number int, text string"
    )
    return assign_chunks(with_metrics(frame), size)


def test_known_roll_up(six):
    chunks = rollup.chunk_metrics(six)
    rows = chunks.orderBy("chunk_id").drop("source_file").collect()
    assert [tuple(r) for r in rows] == THREE_CHUNKS
    assert tuple(rollup.book_totals(chunks).first()) == ("book", 3, 6, 3283)


def test_report_lines(six):
    lines = rollup.chunk_report(rollup.chunk_metrics(six)).orderBy("chunk_id").collect()
    assert lines[0].line == "Chunk 00: Pages   1-  2 |  1,137 words |   8,833 chars"


def test_counts_equal_those_of_the_joined_text(spark):
    texts = ["a b", None, "", " c\n", "ü 🎉 x"]
    for row in rollup.chunk_texts(pages(spark, texts, size=3)).collect():
        assert row.char_count == len(row.text)
        assert row.word_count == len(row.text.split())
    got = rollup.chunk_texts(pages(spark, texts, size=3)).orderBy("chunk_id").collect()
    assert [r.text for r in got] == ["a b\n\n", " c\n\nü 🎉 x"]
    assert [r.page_count for r in got] == [3, 2]


def test_pages_come_in_order_whatever_the_arrival(spark):
    frame = pages(spark, [f"text {i}" for i in range(50)], size=20).orderBy(F.rand(1)).repartition(9)
    chunks = rollup.chunk_results(frame)
    for row in chunks.collect():
        assert [p.page_number for p in row.pages] == list(range(row.start_page, row.end_page + 1))
    books = rollup.book_documents(chunks).collect()
    assert len(books) == 1 and [c.chunk_id for c in books[0].chunks] == [0, 1, 2]


def test_lost_chunk_shows_and_totals_follow_the_manifest(spark):
    frame = pages(spark, ["a b", "c", "d e f", "g"])
    found = rollup.chunk_metrics(frame).filter("chunk_id = 0")
    joined = rollup.with_manifest(found, manifest(frame, 2))
    assert [r.word_count for r in joined.orderBy("chunk_id").collect()] == [3, None]
    assert tuple(rollup.book_totals(joined).first()) == ("book", 2, 4, 3)


def test_book_in_parts_is_whole(spark):
    frame = pages(spark, [f"w{i} x" for i in range(45)], size=2).unionByName(
        pages(spark, ["only"], source="short")
    )
    results = rollup.chunk_results(frame)
    parts = rollup.book_documents(results, part_chunks=4).orderBy("source_file", "part").collect()
    long = [r for r in parts if r.source_file == "book"]
    assert [r.part for r in long] == list(range(6))
    assert {(r.num_parts, r.num_chunks, r.total_pages, r.total_word_count) for r in long} == {(6, 23, 45, 90)}
    assert [c.chunk_id for r in long for c in r.chunks] == list(range(23))
    short = [r for r in parts if r.source_file == "short"]
    assert [(r.num_parts, r.num_chunks, r.total_pages) for r in short] == [(1, 1, 1)]
    flat = rollup.unnest_pages(rollup.unnest_chunks(rollup.book_documents(results, part_chunks=4)))
    columns = ["source_file", "chunk_id", "page_number", "text"]
    left, right = flat.select(columns), frame.select(columns)
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_manifest_documents(spark):
    frame = pages(spark, ["x"] * 100, size=20)
    row = rollup.manifest_documents(manifest(frame, 20), 20).first()
    assert (row.source_file, row.total_pages, row.chunk_size, row.num_chunks) == ("book", 100, 20, 5)
    assert [(c.chunk_id, c.start_page, c.end_page, c.page_count) for c in row.chunks] == [
        (i, i * 20 + 1, i * 20 + 20, 20) for i in range(5)
    ]
    assert row.chunks[0].asDict().keys() == {
        "chunk_id", "path", "source_file", "start_page", "end_page", "page_count"
    }


def test_manifest_meets_each_page_once(spark):
    frame = pages(spark, ["x"] * 7, size=3)
    joined = chunk_pages(manifest(frame, 3), frame)
    assert joined.count() == 7
    assert joined.filter("page_number NOT BETWEEN start_page AND end_page").count() == 0


def test_status(spark):
    frame = pages(spark, ["x"] * 9, size=2)
    found = rollup.chunk_metrics(frame.filter("chunk_id <> 1"))
    rows = rollup.chunk_status(manifest(frame, 2), found, "out").orderBy("chunk_id").collect()
    assert [r.status for r in rows] == ["done", "missing", "done", "done", "done"]
    assert [r.result_path for r in rows] == [None if n == 1 else f"out/source_file={rows[n].source_file}" for n in range(5)]


def test_json_round_trip(spark, tmp_path):
    texts = ['quote " and \\ slash', "ünïcode 🎉", None, "two\nlines"]
    results = rollup.chunk_results(pages(spark, texts), F.lit(1.5))
    documents.write_documents(results, f"{tmp_path}/chunks", partition="source_file")
    back = documents.read_chunk_results(spark, f"{tmp_path}/chunks")
    key = lambda r: r.chunk_id
    assert sorted(back.select(results.columns).collect(), key=key) == sorted(results.collect(), key=key)
    books = rollup.book_documents(back)
    documents.write_documents(books, f"{tmp_path}/books")
    lines = [l for f in (tmp_path / "books").glob("*.json") for l in f.read_text(encoding="utf-8").splitlines()]
    document = json.loads(lines[0])
    assert document["total_pages"] == 4 and document["chunks"][0]["pages"][1]["text"] == "ünïcode 🎉"
    assert documents.read_books(spark, f"{tmp_path}/books").collect() == books.collect()


def test_indented_book_is_read(spark, tmp_path):
    book = {
        "source_file": "b",
        "num_chunks": 1,
        "chunks": [{"chunk_id": 0, "source_file": "b", "start_page": 1, "end_page": 1, "page_count": 1,
                    "word_count": 2, "char_count": 3, "processed_at": 1.0,
                    "pages": [{"page_number": 1, "char_count": 3, "word_count": 2, "text": "a b"}]}],
        "total_pages": 1,
        "total_word_count": 2,
    }
    (tmp_path / "book.json").write_text(json.dumps(book, indent=2))
    books = documents.read_books(spark, str(tmp_path), multi_line=True)
    report = rollup.chunk_report(rollup.unnest_chunks(books)).first()
    assert report.line == "Chunk 00: Pages   1-  1 |      2 words |       3 chars"


def test_malformed_document_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"chunk_id": 0, "pages": [')
    with pytest.raises(Exception):
        documents.read_chunk_results(spark, str(tmp_path)).collect()
