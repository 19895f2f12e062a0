"""Headline timings; prints one JSON line.

Each query is timed over a full run (``noop`` sink, so every column is computed and
nothing is collected), after one warm-up run; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CORES = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "page_table",
    "page_metrics",
    "chunk_metrics",
    "book_totals",
    "book_nested",
    "chunk_full_text",
    "chunk_by_words",
    "html_page_text",
    "embed_hash",
    "store_page_embeddings",
    "semantic_topk",
    "topk_in_source",
    "semantic_threshold",
    "semantic_batch_topk",
    "similar_pages",
    "keyword_any",
    "keyword_each",
    "rag_context",
    "list_documents",
    "table_stats",
    "incremental_ingest",
)


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(job, runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        job()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def codes_at_size(spark, vectors, count: int) -> dict:
    """Search through codes against the exact one, both from files, over ``count`` noisy copies
    of the given vectors."""
    from pyspark.sql import functions as F

    from folioscope.operators.approximate import recall
    from folioscope.operators.blocks import batch_top_k
    from folioscope.operators.quantised import CodeIndex
    from folioscope.operators.search import top_k
    from folioscope.session import scratch_path

    copies = -(-count // vectors.count())
    noisy = F.transform("embedding", lambda x, i: (x + 0.06 * F.sin(F.xxhash64("vec_id", "copy", i) % 10007)).cast("float"))
    rows = vectors.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    rows = rows.repartition(32).select((F.col("vec_id") * copies + F.col("copy")).alias("id"), noisy.alias("embedding"))
    path = scratch_path(spark, "bench-copies")
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    start = time.perf_counter()
    index = CodeIndex.build(stored, scratch_path(spark, "bench-codes"), ["id"])
    built = time.perf_counter() - start
    asked = stored.filter(F.col("id") % (count // 40) == 0).select(F.col("id").alias("query_id"), "embedding")
    exact = batch_top_k(stored, asked, 5, key=["id"])
    query = list(asked.first()["embedding"])
    return {
        "rows": stored.count(),
        "built_sec": round(built, 1),
        "queries": asked.count(),
        "recall_at_5": round(recall(index.batch_top_k(asked, 5), exact, ["query_id", "id"]).first()[0], 4),
        "top5_sec": timed(lambda: run(index.top_k(query, 5))),
        "exact_top5_sec": timed(lambda: run(top_k(stored, query, 5, key=["id"]))),
    }


def main() -> None:
    from pyspark.sql import functions as F

    from folioscope.operators.approximate import CellIndex, recall
    from folioscope.operators.blocks import batch_top_k
    from folioscope.operators.search import top_k
    from folioscope.plans import inputs
    from folioscope.plans.queries import QUERIES
    from folioscope.sources.store import PageStore, page_vectors
    from folioscope.functions.embedding import embed_words
    from folioscope.functions.vectors import search_similarity
    from folioscope.session import local_session, remove_scratch, scratch_path

    spark = local_session(CORES)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(QUERIES[name](spark, FOLDER))
        times[name] = timed(lambda name=name: run(QUERIES[name](spark, FOLDER)))

    vectors = inputs.embeddings(spark, FOLDER)
    count = vectors.count()
    pages = inputs.table(spark, FOLDER, "documents").count()
    extra = {}
    for queries in (100, 1000):
        asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding").limit(queries)
        extra[f"batch_top5_{queries}"] = timed(
            lambda asked=asked: run(batch_top_k(vectors, asked, 5, key=["vec_id"]))
        )
    query = inputs.query_vector(spark, FOLDER)

    def stored_with_vectors():
        store = PageStore(spark, scratch_path(spark, "bench-store"), schema=inputs.STORED_PAGES)
        store.replace_sources(page_vectors(inputs.pages(spark, FOLDER), embed_words))

    extra["stored_with_vectors"] = timed(stored_with_vectors)
    start = time.perf_counter()
    index = CellIndex.build(vectors, scratch_path(spark, "bench-cells"), cells=40)
    extra["cells_built"] = round(time.perf_counter() - start, 3)

    def approximate():
        return index.top_k(query, 5, probes=4, key=["vec_id"])

    extra["approximate_top5"] = timed(lambda: run(approximate()))
    in_jvm = top_k(vectors, query, 5, key=["vec_id"], score=search_similarity)
    extra["exact_top5_in_the_jvm"] = timed(lambda: run(in_jvm))
    exact = top_k(vectors, query, 5, key=["vec_id"])
    found = recall(approximate(), exact, ["vec_id"]).first()["recall"]
    coded = codes_at_size(spark, vectors, int(os.environ.get("BENCH_VECTORS", "1000000")))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cores": CORES,
                "vector_batches_sec": extra,
                "approximate_recall_at_5": found,
                "vectors": count,
                "codes": coded,
                "pages_per_sec": {
                    "metrics_to_book_totals": round(pages / times["book_totals"]),
                    "measured_embedded_and_stored": round(pages / extra["stored_with_vectors"]),
                    "incremental_ingest": round(pages / times["incremental_ingest"]),
                },
            }
        )
    )
    remove_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
