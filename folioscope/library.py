"""One object for the whole flow: ingest pages, then search, list and report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.embedding import embed_words
from folioscope.functions.text import snippet
from folioscope.functions.vectors import checked
from folioscope.operators import approximate, chunking, keywords, listing, results, rollup, trigrams
from folioscope.operators.approximate import CellIndex
from folioscope.operators.bm25 import WordIndex
from folioscope.operators.blocks import batch_top_k
from folioscope.operators.search import DEFAULT_THRESHOLD, DEFAULT_TOP_K, attach_rows, similarities, top_k
from folioscope.operators.trigrams import TrigramIndex
from folioscope.schemas import DEFAULT_CHUNK_SIZE, DEFAULT_DIMENSION, PAGE_KEY
from folioscope.session import scratch_path
from folioscope.sources import documents
from folioscope.sources.store import DEFAULT_GROUPS, PageStore

HIT_COLUMNS = ("chunk_id", "word_count", "created_at", "text")


class Library:
    """Documents stored page by page at ``path``.

    ``embed`` turns a text column into a vector column; see ``functions.embedding.embed``
    for plugging in a model. Searches are DataFrames over the stored table; the vectors
    of the queries are fetched when a search is made.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        embed: Callable[[Column | str], Column] = embed_words,
        dimension: int = DEFAULT_DIMENSION,
        groups: int | None = DEFAULT_GROUPS,
    ):
        self.spark, self.path, self.embed, self.dimension = spark, path.rstrip("/"), embed, dimension
        self.store = PageStore(spark, f"{self.path}/pages", groups=groups)
        self.trigrams = TrigramIndex(spark, f"{self.path}/trigrams")
        self.words = WordIndex(spark, f"{self.path}/words")

    # Ingest

    def ingest(
        self,
        pages: DataFrame,
        chunk_size: int = DEFAULT_CHUNK_SIZE,
        enrich: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Store measured, embedded pages; running a source again replaces it.

        ``pages`` come from ``sources.paged``. ``enrich`` may change them before.
        """
        pages = chunking.assign_chunks(pages, chunk_size)
        pages = enrich(pages) if enrich else pages
        self.store.replace_sources(
            pages.withColumns(
                {
                    "embedding": self.embed("text"),
                    "created_at": F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()),
                }
            ).withColumn("embedding", checked("embedding", self.dimension))
        )
        self._reindex(self._touched(pages.select("source_file")))

    def write_results(self, chunk_size: int = DEFAULT_CHUNK_SIZE) -> None:
        """Write manifests, chunk results and merged books as JSON next to the pages."""
        pages = self.store.read().drop("embedding")
        manifest = chunking.manifest(pages, chunk_size)
        documents.write_documents(
            rollup.manifest_documents(manifest, chunk_size), f"{self.path}/manifests"
        )
        chunk_results = rollup.chunk_results(chunking.assign_chunks(pages, chunk_size))
        documents.write_documents(chunk_results, f"{self.path}/results", partition="source_file")
        metadata = rollup.chunk_metrics(chunking.assign_chunks(pages, chunk_size))
        metadata.write.mode("overwrite").parquet(f"{self.path}/chunks")
        # Books are merged from the written results, as their times are part of them.
        written = documents.read_chunk_results(self.spark, f"{self.path}/results")
        documents.write_documents(rollup.book_documents(written), f"{self.path}/books")

    def books(self) -> DataFrame:
        return documents.read_books(self.spark, f"{self.path}/books")

    def remove(self, pattern: str) -> None:
        """Delete the sources that match a LIKE pattern."""
        doomed = F.col("source_file").like(pattern)
        groups = self._touched(self.store.read().filter(doomed))
        self.store.delete(doomed)
        self._reindex(groups)

    # Indexes of words and patterns

    def build_text_indexes(self) -> None:
        """Index trigrams and words of the stored pages: keyword searches then read candidate
        pages only, and :meth:`search_words` works. Later ingests and removals keep up the
        groups of sources that they touch."""
        pages = self.store.read().select(*PAGE_KEY, "text")
        self.trigrams.build(pages)
        self.words.build(pages)

    def _indexed(self) -> bool:
        return self.store._has(f"{self.path}/words")

    def _touched(self, sources: DataFrame) -> list[int]:
        return self.words.groups_of(sources) if self._indexed() else []

    def _reindex(self, groups: list[int]) -> None:
        if groups:
            # Store and indexes share the groups, so only their directories are read again.
            same = self.store.groups == self.words.table.groups
            pages = (self.store.read_groups(groups) if same else self.store.read()).select(*PAGE_KEY, "text")
            self.trigrams.refresh(pages, groups)
            self.words.refresh(pages, groups)

    def search_words(self, text: str, k: int = DEFAULT_TOP_K, source: str | None = None) -> DataFrame:
        """The best pages by the words of a text (BM25); needs :meth:`build_text_indexes`."""
        return self.words.top_k(text, k, source)

    # Search

    def vector(self, text: str) -> list[float]:
        """The vector of one query text."""
        row = self.spark.range(1).select(self.embed(F.lit(text)).alias("vector")).first()
        return list(row["vector"])

    def similarity_search(
        self, query_vector: Sequence[float], k: int = DEFAULT_TOP_K, source: str | None = None
    ) -> DataFrame:
        """The most similar pages, all columns but the vector, with score and rank."""
        if len(query_vector) != self.dimension:
            raise ValueError(f"expected {self.dimension} dimensions, not {len(query_vector)}")
        return self._hits(query_vector, k, source, None)

    def search(
        self,
        text: str,
        limit: int = DEFAULT_TOP_K,
        threshold: float | None = DEFAULT_THRESHOLD,
        source: str | None = None,
    ) -> DataFrame:
        """The most similar pages to a text, not below ``threshold``."""
        return self._hits(self.vector(text), limit, source, threshold)

    def _hits(self, vector, k, source, threshold) -> DataFrame:
        rows = self.store.read(source)
        hits = top_k(rows.select(*PAGE_KEY, "embedding"), vector, k, source, threshold)
        return attach_rows(hits, rows.select(*PAGE_KEY, *HIT_COLUMNS)).orderBy("rank")

    def search_many(self, queries: DataFrame, k: int = DEFAULT_TOP_K, **options) -> DataFrame:
        """The most similar pages for each row ``(query_id, text)`` of ``queries``, any number."""
        asked = queries.withColumn("embedding", self.embed("text"))
        options.setdefault("blocks", "auto")
        return batch_top_k(self.store.read(), asked, k, **options)

    def search_keywords(
        self, terms: Sequence[str], limit: int = keywords.DEFAULT_LIMIT, literal: bool = False
    ) -> DataFrame:
        """For each term its first pages."""
        pages = self.store.read().select(*PAGE_KEY, "text", "created_at")
        if self._indexed():
            return trigrams.each_keyword(self.trigrams, pages, terms, limit, literal)
        return keywords.each_keyword(pages, terms, limit, literal=literal)

    def search_any_keyword(
        self,
        terms: Sequence[str],
        limit: int = keywords.DEFAULT_LIMIT,
        source: str | None = None,
        literal: bool = False,
    ) -> DataFrame:
        """The first pages with at least one of the terms."""
        pages = self.store.read(source).select(*PAGE_KEY, "chunk_id", "text")
        if self._indexed():
            found = trigrams.any_keyword(self.trigrams, pages, terms, limit, source, literal)
        else:
            found = keywords.any_keyword(pages, terms, limit, source, literal=literal)
        return found.withColumn("snippet", snippet("text", 100))

    def context(self, text: str, limit: int = DEFAULT_TOP_K) -> DataFrame:
        """One row: the texts of the best pages and a prompt around them."""
        hits = self._hits(self.vector(text), limit, None, None).withColumn("query_id", F.lit(text))
        found = results.context_by_query(hits)
        return found.withColumn("prompt", results.prompt("query_id"))

    def compare(self, queries: DataFrame, k: int = DEFAULT_TOP_K, threshold: float | None = DEFAULT_THRESHOLD) -> DataFrame:
        """For each row ``(query_id, text)`` how many pages are found, how similar they are
        and which is the best; also for queries that find nothing."""
        hits = self.search_many(queries, k, threshold=threshold)
        return results.compare_results(hits, queries, [*PAGE_KEY, "similarity"], nested=True)

    def search_hybrid(self, text: str, terms: Sequence[str], k: int = DEFAULT_TOP_K) -> DataFrame:
        """Pages by meaning and by terms, fused by their ranks in both whole lists. Terms rank
        by BM25 if the words are indexed, else by how many a page contains."""
        pages = self.store.read()
        lists = [similarities(pages.select(*PAGE_KEY, "embedding"), self.vector(text))]
        if self._indexed():
            lists.append(self.words.scores(" ".join(terms)))
        else:
            counted = keywords.match_counts(pages.select(*PAGE_KEY, "text"), terms)
            lists.append(counted.withColumnRenamed("matches", "score"))
        for at, rows in enumerate(lists):
            path = scratch_path(self.spark, "scores")
            rows.write.parquet(path)
            lists[at] = self.spark.read.parquet(path)
        return results.fuse_whole(*lists, PAGE_KEY, ("similarity", "score"), k)

    def build_index(self, cells: int, **options) -> CellIndex:
        """Cluster the stored vectors into cells for approximate searches."""
        rows = self.store.read().select(*PAGE_KEY, "embedding")
        return CellIndex.build(rows, f"{self.path}/cells", cells, **options)

    def index(self) -> CellIndex:
        return CellIndex(self.spark, f"{self.path}/cells")

    def similar_pages(self, k: int = 3, probes: int = 1, parts: int = 1) -> DataFrame:
        """For each page its ``k`` nearest others among the pages of its ``probes`` nearest
        cells; needs :meth:`build_index`. ``query_id`` is the page's key."""
        page = F.struct(*PAGE_KEY)
        index = self.index()
        asked = index.rows.filter("cell >= 0").select(page.alias("query_id"), "embedding")
        hits = index.batch_top_k(asked, k + 1, probes, parts=parts).withColumn("__page", page)
        return results.without_self(hits, "__page", k).drop("__page")

    def topics(self, k: int) -> DataFrame:
        """Pages with ``topic``: their cluster by direction."""
        rows = self.store.read().select(*PAGE_KEY, "embedding")
        return approximate.topics(rows, k)[0].drop("embedding")

    # Listings

    def keep_summaries(self) -> None:
        """Count the stored pages once; later writes keep the counts, and :meth:`list_documents`,
        :meth:`stats` and :meth:`document_info` read no pages."""
        self.store.summaries.build()

    def _counted(self) -> bool:
        return self.store.summaries is not None and self.store.summaries.exist()

    def list_documents(self, source: str | None = None) -> DataFrame:
        if self._counted():
            return self.store.summaries.list_documents(source)
        return listing.list_documents(self.store.read(source), source)

    def stats(self) -> DataFrame:
        if self._counted():
            return self.store.summaries.table_stats()
        return listing.table_stats(self.store.read())

    def chunks(self, source: str | None = None) -> DataFrame:
        """The stored metadata of chunks: span, words and characters."""
        rows = self.spark.read.parquet(f"{self.path}/chunks")
        return rows.filter(F.col("source_file") == source) if source else rows

    def chunk_status(self, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
        """Which chunks have a written result, after :meth:`write_results`."""
        manifest = chunking.manifest(self.store.read().select(*PAGE_KEY), chunk_size)
        written = documents.read_chunk_results(self.spark, f"{self.path}/results")
        return rollup.chunk_status(manifest, written, f"{self.path}/results")

    def document_info(self, source: str | int) -> DataFrame:
        """Pages, words and characters of a source, by its name or its number (``xxhash64`` of
        the name); no row for an unknown one."""
        if isinstance(source, int):
            pages = self.store.read_document(source).withColumn("document_id", F.xxhash64("source_file"))
            return listing.document_summary(pages, source)
        if source and self._counted():
            return self.store.summaries.document_summary(source)
        return listing.document_summary(self.store.read(source), source, "source_file")

    def recent(self, limit: int = listing.DEFAULT_RECENT) -> DataFrame:
        pages = self.store.read().select(*PAGE_KEY, "chunk_id", "word_count", "created_at")
        return listing.recent_pages(pages, limit)
