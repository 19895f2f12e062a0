import random
import re

import pytest
from pyspark.sql import functions as F

from folioscope.functions.embedding import embed_words
from folioscope.library import Library
from folioscope.operators.chunking import assign_chunks
from folioscope.schemas import PAGES_TABLE, conform
from folioscope.sources.paged import split_pages, with_metrics
from folioscope.sources.store import PageStore, append_rows, chunk_vectors, page_vectors


def pages(spark, counts, word="text"):
    rows = [(s, p, f"{word} {p}") for s, n in counts.items() for p in range(1, n + 1)]
    frame = spark.createDataFrame(rows, "source_file string, page_number int, text string")
    return assign_chunks(with_metrics(frame), 2)


def counts(store):
    return {r.source_file: r["count"] for r in store.read().groupBy("source_file").count().collect()}


NAMES = {"a": 3, "b/c d=1%": 2, "123": 1, "ü": 4}


@pytest.fixture(params=[None, 3])
def filled(spark, tmp_path, request):
    store = PageStore(spark, f"{tmp_path}/pages", groups=request.param)
    assert not store.exists() and store.read().count() == 0
    store.replace_sources(pages(spark, NAMES))
    return store


def test_write_and_read(filled):
    assert filled.exists() and counts(filled) == NAMES
    assert filled.read().schema.names == PAGES_TABLE.names
    assert [f.dataType for f in filled.read().schema] == [f.dataType for f in PAGES_TABLE]
    assert filled.read("123").first().text == "text 1"
    assert filled.read("nope").count() == 0


def test_a_second_run_replaces(spark, filled):
    filled.replace_sources(pages(spark, NAMES))
    assert counts(filled) == NAMES
    filled.replace_sources(pages(spark, {"a": 1, "new": 2}, word="changed"))
    assert counts(filled) == {**NAMES, "a": 1, "new": 2}
    assert filled.read("a").first().text == "changed 1"


def test_delete(filled):
    filled.delete(F.col("source_file").like("b%"))
    assert counts(filled) == {k: v for k, v in NAMES.items() if k != "b/c d=1%"}
    filled.delete((F.col("source_file") == "a") & (F.col("page_number") > 1))
    assert counts(filled) == {"a": 1, "123": 1, "ü": 4}
    filled.delete(F.col("embedding")[0] > 0)
    assert counts(filled) == {"a": 1, "123": 1, "ü": 4}
    filled.delete(F.lit(True))
    assert counts(filled) == {}
    schema = "source_file string, page_number int, chunk_id long, text string"
    filled.replace_sources(filled.spark.createDataFrame([("z", 1, 0, "t")], schema))
    assert counts(filled) == {"z": 1}


def test_stored_pages_can_be_rewritten_in_place(filled):
    filled.replace_sources(assign_chunks(filled.read(), 1))
    assert counts(filled) == NAMES
    assert filled.read().filter("chunk_id <> page_number - 1").count() == 0


def test_one_source_reads_one_directory(spark, filled):
    plan = filled.read("a")._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert filled.partition in partition_filters


def test_catalogue_table(spark, filled, tmp_path):
    name = f"pages_{abs(hash(str(tmp_path)))}"
    filled.create(name)
    filled.create(name)
    assert spark.catalog.tableExists(name)
    assert spark.table(name).filter("source_file = 'ü'").count() == 4
    spark.sql(f"DROP VIEW {name}")
    assert counts(filled) == NAMES


def test_missing_values_are_refused(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/pages")
    bad = spark.createDataFrame([(None, 1, 0, "t")], "source_file string, page_number int, chunk_id long, text string")
    for frame in (bad, bad.fillna({"source_file": ""})):
        with pytest.raises(Exception, match="must not be"):
            store.replace_sources(frame)
    with pytest.raises(ValueError, match="missing column"):
        conform(bad.drop("text"))


def test_page_and_chunk_vectors(spark):
    frame = pages(spark, {"a": 3}, word="w" * 30)
    row = page_vectors(frame, embed_words, 10).orderBy("page_number").first()
    assert row.text == "w" * 10 and row.char_count == 32 and len(row.embedding) == 384
    assert page_vectors(frame, embed_words, None).first().text.startswith("w" * 30)
    chunks = chunk_vectors(frame, embed_words, 40).orderBy("chunk_id").collect()
    assert [(r.page_number, len(r.text), r.char_count) for r in chunks] == [(1, 40, 65), (3, 32, 32)]


def test_append_keeps_what_is_there(spark, tmp_path):
    frame = pages(spark, {"a": 2})
    append_rows(frame, f"{tmp_path}/log", "source_file")
    append_rows(frame, f"{tmp_path}/log", "source_file")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 4


def test_large_directory_is_split_over_tasks(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/pages", groups=None)
    rows = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("hot").alias("source_file"),
        F.col("id").cast("int").alias("page_number"),
        F.lit(0).cast("long").alias("chunk_id"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"),
    )
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        store.replace_sources(rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(list((tmp_path / "pages" / "base" / "source_file=hot").glob("*.parquet"))) > 1
    assert store.read().count() == 40000


def made_up(topic, count=6):
    return " ".join(f"{topic}{n}x" for n in range(count))


def test_library(spark, tmp_path):
    """Pages of invented words: what a query shares with a page is known by construction."""
    library = Library(spark, f"{tmp_path}/library")
    texts = {
        "first": [made_up("red"), made_up("green") + " common"],
        "second": [made_up("blue") + " common", made_up("gold"), ""],
    }
    rows = [(source, "\f".join(pages) + "\f") for source, pages in texts.items()]
    library.ingest(split_pages(spark.createDataFrame(rows, "source string, text string"), "source"), chunk_size=2)
    top = library.search(made_up("red", 3), threshold=0.2).first()
    assert (top.source_file, top.page_number, top["rank"]) == ("first", 1, 1)
    assert library.search(made_up("gold", 2), threshold=None).first().source_file == "second"
    inside = library.search(made_up("gold", 2), threshold=None, source="first").collect()
    assert {r.source_file for r in inside} == {"first"}
    plain = library.similarity_search(library.vector(made_up("blue", 2)), k=1).first()
    assert "blue1x" in plain.text
    with pytest.raises(ValueError, match="dimensions"):
        library.similarity_search([1.0])
    asked = spark.createDataFrame([(1, made_up("green"), None), (2, made_up("blue"), "first")], "query_id int, text string, s string")
    many = {r.query_id: r for r in library.search_many(asked, 1).collect()}
    assert (many[1].source_file, many[1].page_number) == ("first", 2) and many[2].source_file == "second"
    limited = {r.query_id: r.source_file for r in library.search_many(asked, 1, source="s").collect()}
    assert limited == {1: "first", 2: "first"}
    assert library.search_keywords(["COMMON", "red1x"]).count() == 3
    assert library.search_any_keyword(["red1x"], source="second").count() == 0
    assert library.context(made_up("blue"), 1).first().num_results == 1
    assert {r.source_file: r.pages for r in library.list_documents().collect()} == {"first": 2, "second": 3}
    assert tuple(library.stats().first()) == (5, 2, 26)
    assert library.document_info("first").first().total_words == 13
    assert library.recent(2).count() == 2
    asked = spark.createDataFrame([(1, made_up("gold")), (2, "nothing like it")], "query_id int, text string")
    compared = {r.query_id: r for r in library.compare(asked, threshold=0.9).collect()}
    assert (compared[1].num_results, compared[1].top_source_file, compared[1].top_page_number) == (1, "second", 2)
    assert (compared[2].num_results, compared[2].avg_similarity, compared[2].top_source_file) == (0, 0.0, None)
    fused = library.search_hybrid(made_up("red"), ["common"], 3).collect()
    # The two pages with the term are in both lists, the most similar page in one.
    assert {(r.source_file, r.page_number) for r in fused[:2]} == {("first", 2), ("second", 1)}
    assert (fused[2].source_file, fused[2].page_number) == ("first", 1)
    library.build_index(2)
    near = library.similar_pages(2, probes=2).collect()
    assert len(near) == 8 and all((r.query_id.source_file, r.query_id.page_number) != (r.source_file, r.page_number) for r in near)
    assert library.index().top_k(library.vector(made_up("red")), 1, probes=2).first().page_number == 1
    assert library.topics(2).count() == 4
    library.write_results(2)
    assert {r.status for r in library.chunk_status(2).collect()} == {"done"}
    assert library.chunks("second").agg(F.sum("page_count")).first()[0] == 3
    books = {r.source_file: r for r in library.books().collect()}
    assert (books["second"].num_chunks, books["second"].total_pages, books["second"].total_word_count) == (2, 3, 13)
    library.remove("f_rst")
    assert [r.source_file for r in library.list_documents().collect()] == ["second"]


def test_input_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def extract(text):
        seen.add(1)
        return text

    for groups in (4, None):
        before = seen.value
        store = PageStore(spark, f"{tmp_path}/pages-{groups}", groups=groups)
        store.replace_sources(pages(spark, {"a": 60, "b": 40}).withColumn("text", extract("text")))
        assert seen.value - before == 100
        assert store.read().count() == 100
    assert [p.name for p in tmp_path.iterdir() if "staging" in p.name] == []


@pytest.mark.parametrize("groups", [4, None])
def test_pages_are_replaced_by_key(spark, tmp_path, groups):
    store = PageStore(spark, f"{tmp_path}/pages", groups=groups)
    store.replace_pages(pages(spark, {"a": 3, "b": 2}))
    store.replace_pages(pages(spark, {"a": 1, "c": 1}, word="changed"))
    found = {(r.source_file, r.page_number): r.text for r in store.read().collect()}
    assert found == {
        ("a", 1): "changed 1",
        ("a", 2): "text 2",
        ("a", 3): "text 3",
        ("b", 1): "text 1",
        ("b", 2): "text 2",
        ("c", 1): "changed 1",
    }


@pytest.mark.parametrize("groups", [4, None])
def test_catalogue_table_follows_changes(spark, tmp_path, groups):
    name = f"follows_{groups or 'none'}_{abs(hash(str(tmp_path)))}"
    store = PageStore(spark, f"{tmp_path}/pages", groups=groups)
    store.create(name)
    store.replace_sources(pages(spark, {"a": 3}))
    assert spark.table(name).count() == 3
    store.replace_sources(pages(spark, {"b": 2}))
    assert spark.table(name).count() == 5
    store.delete(F.col("source_file") == "a")
    assert spark.table(name).count() == 2
    spark.sql(f"DROP VIEW {name}")


def test_long_source_names(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/pages")
    name = "s3a://bucket/" + "very long/" * 60
    store.replace_sources(pages(spark, {name: 2}))
    assert counts(store) == {name: 2}


def files_of(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("groups", [4, None])
def test_a_small_batch_writes_little(spark, tmp_path, groups):
    store = PageStore(spark, f"{tmp_path}/pages", groups=groups)
    store.replace_sources(pages(spark, {f"s{i}": 200 for i in range(20)}, word="w" * 500))
    before = files_of(tmp_path / "pages")
    store.replace_pages(pages(spark, {"s3": 1}, word="new"))
    after = files_of(tmp_path / "pages")
    assert before.items() <= after.items()  # nothing that was there is written again
    new = {p: size for p, size in after.items() if p not in before}
    assert len(new) == 1 and sum(new.values()) < 10_000
    assert store.read("s3").count() == 200 and store.read().filter("text = 'new 1'").count() == 1


@pytest.mark.parametrize("groups", [3, None])
def test_changes_and_compaction_against_a_plain_model(spark, tmp_path, groups):
    """Random writes; readers, the view and another object see the same at every step."""
    rng = random.Random(groups or 0)
    name = f"model_{groups or 'none'}_{abs(hash(str(tmp_path)))}"
    store = PageStore(spark, f"{tmp_path}/pages", groups=groups, compact_after=5)
    store.create(name)
    model = {}
    for step in range(12):
        sources = {f"s={rng.randint(0, 4)}": rng.randint(1, 4) for _ in range(rng.randint(1, 3))}
        kind = rng.choice(["sources", "pages", "delete", "one"])
        if kind == "delete":
            page = rng.randint(1, 3)
            store.delete((F.col("page_number") == page) | (F.col("source_file") == "s=0"))
            model = {k: v for k, v in model.items() if k[1] != page and k[0] != "s=0"}
        elif kind == "one":
            store.delete(F.col("source_file") == "s=1")
            model = {k: v for k, v in model.items() if k[0] != "s=1"}
        else:
            rows = pages(spark, sources, word=f"v{step}")
            if kind == "sources":
                store.replace_sources(rows)
                model = {k: v for k, v in model.items() if k[0] not in sources}
            else:
                store.replace_pages(rows)
            model.update({(s, p): f"v{step} {p}" for s, n in sources.items() for p in range(1, n + 1)})
        if step == 8:
            store.compact()
            assert not (tmp_path / "pages" / "recent").exists() or not store._changes().count()
        for rows in (store.read(), spark.table(name), PageStore(spark, store.path, groups=groups).read()):
            found = [((r.source_file, r.page_number), r.text) for r in rows.collect()]
            assert len(found) == len(model) and dict(found) == model, (step, kind)
        some = [*sorted(model)[:2], ("s=9", 1)]
        assert {(r.source_file, r.page_number) for r in store.read_pages(some).collect()} == set(some) & set(model)
    spark.sql(f"DROP VIEW {name}")


def test_a_compaction_that_ends_early_changes_nothing(spark, tmp_path, monkeypatch):
    store = PageStore(spark, f"{tmp_path}/pages", groups=4)
    store.replace_sources(pages(spark, {"a": 3, "b": 2}))
    store.replace_sources(pages(spark, {"a": 1}, word="new"))
    store.delete(F.col("source_file") == "b")
    monkeypatch.setattr(PageStore, "_remove", lambda self, path: (_ for _ in ()).throw(OSError))
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.undo()
    assert [(r.source_file, r.text) for r in store.read().collect()] == [("a", "new 1")]
    store.compact()
    assert [(r.source_file, r.text) for r in store.read().collect()] == [("a", "new 1")]


def test_a_read_by_key_prunes(spark, filled):
    plan = filled.read_pages([("ü", 2)])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\((source_file|page_number)", plan)
    assert re.search(r"PartitionFilters: \[[^\]]*(source_group|source_file)", plan)
    assert filled.read_pages([("ü", 2), ("nope", 1)]).count() == 1
