from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.sources.store import PageStore
from folioscope.streaming import ingest

INPUT = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)


def arrive(spark, path, rows):
    spark.createDataFrame(rows, INPUT).coalesce(1).write.mode("append").parquet(path)


def run(spark, base, enrich=None):
    arriving = spark.readStream.schema(INPUT).parquet(f"{base}/in")
    pages = ingest.measured_pages(arriving, 2, enrich)
    ingest.append_stream(pages, f"{base}/out", f"{base}/progress").awaitTermination()
    return ingest.latest_pages(spark, f"{base}/out", pages.schema)


def test_pages_arrive_in_batches_and_the_last_version_counts(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [("a", 1, "one two"), ("a", 2, None)])
    first = run(spark, tmp_path)
    assert first.count() == 2
    arrive(spark, f"{tmp_path}/in", [("a", 3, "x"), ("a", 1, "one two three")])
    second = {r.page_number: r for r in run(spark, tmp_path).collect()}
    assert {p: r.word_count for p, r in second.items()} == {1: 3, 2: 0, 3: 1}
    assert {p: r.chunk_id for p, r in second.items()} == {1: 0, 2: 0, 3: 1}
    again = run(spark, tmp_path)
    assert again.count() == 3


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [("a", 1, "one")])
    run(spark, tmp_path)
    # The same input under a new progress folder is batch 0 once more.
    arriving = spark.readStream.schema(INPUT).parquet(f"{tmp_path}/in")
    pages = ingest.measured_pages(arriving, 2)
    ingest.append_stream(pages, f"{tmp_path}/out", f"{tmp_path}/progress2").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_many_versions_of_one_page(spark, tmp_path):
    for version in range(4):
        rows = [("hot", 1, f"version {version} " + "x " * i) for i in range(30)]
        arrive(spark, f"{tmp_path}/in", [*rows, ("cold", version, "once")])
        stored = run(spark, tmp_path)
    got = {(r.source_file, r.page_number): r.text for r in stored.collect()}
    assert len(got) == stored.count() == 5
    assert got["hot", 1].startswith("version 3")


def test_enrichment(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [("a", 1, "One Two")])
    got = run(spark, tmp_path, lambda pages: pages.withColumn("low", F.lower("text")))
    assert got.first().low == "one two"


def test_running_totals(spark, tmp_path):
    arrive(spark, f"{tmp_path}/in", [("a", 1, "one two"), ("b", 1, "x")])
    pages = ingest.measured_pages(spark.readStream.schema(INPUT).parquet(f"{tmp_path}/in"), 2)
    ingest.running_totals(pages, f"{tmp_path}/totals", f"{tmp_path}/state").awaitTermination()
    got = {r.source_file: tuple(r)[1:] for r in spark.read.parquet(f"{tmp_path}/totals").collect()}
    assert got == {"a": (1, 2, 7), "b": (1, 1, 1)}


def test_stream_into_the_store(spark, tmp_path):
    store = PageStore(spark, f"{tmp_path}/store", groups=3)

    def run_into_store():
        schema = T.StructType([*INPUT.fields, T.StructField("arrived", T.LongType())])
        pages = ingest.measured_pages(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 2)
        ingest.store_stream(pages, store, f"{tmp_path}/progress").awaitTermination()
        return {(r.source_file, r.page_number): r.text for r in store.read().collect()}

    def arrive_at(rows):
        names = [*INPUT.names, "arrived"]
        spark.createDataFrame(rows, names).selectExpr(
            "source_file", "cast(page_number as int) page_number", "text", "arrived"
        ).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    arrive_at([("a", 1, "zz early", 1), ("a", 1, "aa late", 2), ("b", 1, "b", 1)])
    assert run_into_store() == {("a", 1): "aa late", ("b", 1): "b"}
    arrive_at([("a", 2, "new", 5), ("b", 1, "changed", 6)])
    assert run_into_store() == {("a", 1): "aa late", ("a", 2): "new", ("b", 1): "changed"}
    assert run_into_store() == {("a", 1): "aa late", ("a", 2): "new", ("b", 1): "changed"}
