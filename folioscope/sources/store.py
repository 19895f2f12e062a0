"""The page table on disk: Parquet, a base in directories and the changes since."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import cut
from folioscope.operators.rollup import chunk_texts
from folioscope.operators.search import in_source
from folioscope.schemas import PAGE_KEY, PAGES_TABLE, conform
from folioscope.sources.postings import literal_keys
from folioscope.sources.summaries import StoreSummaries

GROUP_COLUMN = "source_group"
DEFAULT_GROUPS = 64
#: What a recent row has besides the page: the number of its write, whether the page is
#: deleted, and whether the write has all pages of the source.
CHANGE = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("gone", T.BooleanType()),
        T.StructField("whole", T.BooleanType()),
    ]
)
# Fixed value: the characters that names of partition directories escape.
RESERVED = '"#%\'*/:=?\\{[]^'


class PageStore:
    """Pages at ``path``: a base, and the changes since, which readers apply.

    The first load makes the ``base``, a directory for each group of sources, or with
    ``groups=None`` for each source (for few, large sources). Every later write appends one
    set of files to ``recent`` in one job: new versions of pages, whole sources
    that replace earlier ones, or marks of deletion. So a small batch costs a small write,
    and a change is there with its commit or not at all. Readers take the newest version of
    each page; what they shuffle or send for that are the keys of recent rows alone. After ``compact_after``
    writes, or when told, recent rows are merged into the groups of the base that they touch.
    Where :attr:`summaries` were built, every write keeps them in step.

    A directory that outgrows one task is split over several (a ``rebalance`` hint, acted on
    by adaptive execution). Base files are in key order, so that lookups skip row groups. There is
    one writer at a time; readers may go on, but for those of files a compaction replaces.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType = PAGES_TABLE,
        groups: int | None = DEFAULT_GROUPS,
        compact_after: int = 32,
    ):
        self.spark, self.path, self.schema, self.groups = spark, path.rstrip("/"), schema, groups
        self.partition = GROUP_COLUMN if groups else "source_file"
        self.compact_after = compact_after
        # The directory of the base that only tells the schema; a value of the right type.
        self.no_group = "-1" if groups else "__none__"
        self.base, self.recent = f"{self.path}/base", f"{self.path}/recent"
        self.summaries = StoreSummaries(self) if groups else None

    def group(self, source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.lit(self.groups)).cast("int")

    def _base_schema(self) -> T.StructType:
        if not self.groups:
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(GROUP_COLUMN, T.IntegerType())])

    def _recent_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *CHANGE.fields])

    def _folder(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _has(self, path: str) -> bool:
        files, folder = self._folder(path)
        return files.exists(folder)

    def _remove(self, path: str) -> None:
        files, folder = self._folder(path)
        files.delete(folder, True)

    def exists(self) -> bool:
        return self._has(self.path)

    def create(self, table: str | None = None) -> None:
        """Make the folder and, if named, a view of the stored pages in the catalogue. Safe to
        repeat. The view reads the files, so it shows every change, whoever makes it."""
        for path, schema in ((self.base, self._base_schema()), (self.recent, self._recent_schema())):
            if not self._has(path):
                # An empty file tells the schema. Of the base it lies in a directory of no group.
                rows = self.spark.createDataFrame([], schema)
                if path == self.base:
                    path, rows = f"{path}/{self.partition}={self.no_group}", rows.drop(self.partition)
                rows.coalesce(1).write.parquet(path)
        if table and not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE VIEW {table} AS {self._view()}")

    def _view(self) -> str:
        """:meth:`read` in SQL."""
        columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema)
        return f"""
            WITH r AS (SELECT * FROM parquet.`{self.recent}`),
            newest AS (SELECT source_file AS s, page_number AS p, max(version) AS v FROM r GROUP BY ALL),
            cut AS (SELECT source_file AS c, max(version) AS w FROM r WHERE whole GROUP BY ALL)
            SELECT {columns} FROM r JOIN newest ON source_file = s AND page_number = p AND version = v
            LEFT JOIN cut ON source_file = c WHERE NOT gone AND (w IS NULL OR version >= w)
            UNION ALL
            SELECT {columns} FROM parquet.`{self.base}`
            LEFT ANTI JOIN newest ON source_file = s AND page_number = p
            LEFT ANTI JOIN cut ON source_file = c"""

    def _base(self) -> DataFrame:
        if not self._has(self.base):
            return self.spark.createDataFrame([], self._base_schema())
        return self.spark.read.schema(self._base_schema()).parquet(self.base)

    def _changes(self, source: str | None = None) -> DataFrame | None:
        if not self._has(self.recent):
            return None
        return in_source(self.spark.read.schema(self._recent_schema()).parquet(self.recent), source)

    def read(self, source: str | None = None) -> DataFrame:
        """All pages or those of one source; only its directory of the base is listed."""
        return self._read(source).select(*self.schema.names)

    def _read(self, source: str | None = None) -> DataFrame:
        rows = in_source(self._base(), source)
        if source and self.groups:
            rows = rows.filter(F.col(GROUP_COLUMN) == self.group(F.lit(source)))
        changes = self._changes(source)
        return rows if changes is None else self._applied(rows, changes)

    def _applied(self, rows: DataFrame, changes: DataFrame) -> DataFrame:
        """Base rows that no change touches, and the newest changes that are pages."""
        key = list(PAGE_KEY)
        keys = changes.select(*key, "version", "whole")
        cut = keys.filter("whole").groupBy("source_file").agg(F.max("version").alias("__from"))
        newest = keys.groupBy(*key).agg(F.max("version").alias("__newest"), F.count(F.lit(1)).alias("__times"))
        # Most keys change once: their rows need no look at the others.
        several = newest.filter("__times > 1").select(*key, "__newest")
        live = (
            changes.filter("NOT gone")
            .join(several, key, "left")
            .filter("__newest IS NULL OR version = __newest")
            .join(cut, "source_file", "left")
            .filter("__from IS NULL OR version >= __from")
        )
        untouched = rows.join(newest.select(*key), key, "left_anti").join(cut, "source_file", "left_anti")
        names = self._base_schema().names
        if self.groups:
            live = live.withColumn(GROUP_COLUMN, self.group(F.col("source_file")))
        return untouched.select(*names).unionByName(live.select(*names))

    def read_document(self, document_id: int) -> DataFrame:
        """The pages of the source with this number, which is the ``xxhash64`` of its name; of the
        base only its directory is read."""
        rows = self._read()
        if self.groups:
            rows = rows.filter(F.col(GROUP_COLUMN) == document_id % self.groups)
        return rows.filter(F.xxhash64("source_file") == document_id).select(*self.schema.names)

    def read_groups(self, groups: Sequence[int]) -> DataFrame:
        """The pages of some groups of sources; of the base only their directories are read."""
        return self._read().filter(F.col(GROUP_COLUMN).isin(list(groups))).select(*self.schema.names)

    def read_pages(self, keys: Sequence[tuple[str, int]]) -> DataFrame:
        """The pages with the given keys, a bounded number, by filters that the scan uses."""
        rows = self._read()
        if self.groups:
            groups = [self.group(F.lit(source)) for source in sorted({source for source, _ in keys})]
            rows = rows.filter(F.col(GROUP_COLUMN).isin(groups))
        return rows.filter(literal_keys(keys)).select(*self.schema.names)

    def replace_sources(self, pages: DataFrame) -> None:
        """Store ``pages``; earlier pages of the same sources go."""
        rows = self._checked(pages)
        if self._has(self.base) or self._has(self.recent):
            self._append(rows, whole=True)
        else:
            self._write_base(rows)

    def replace_pages(self, pages: DataFrame) -> None:
        """Store ``pages``; earlier versions of the same pages go, other pages stay."""
        self._append(self._checked(pages))

    def delete(self, condition: Column) -> None:
        """Remove the rows that meet ``condition`` (a condition that is NULL keeps its row)."""
        doomed = self.read().filter(F.coalesce(condition, F.lit(False))).select(*PAGE_KEY).distinct()
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema if f.name not in PAGE_KEY]
        self._append(doomed.select(*PAGE_KEY, *others).select(*self.schema.names), gone=True)

    def _checked(self, pages: DataFrame) -> DataFrame:
        empty = F.raise_error(F.lit("source_file must not be empty"))
        rows = conform(pages, self.schema)
        name = F.col("source_file")
        return rows.withColumn("source_file", F.when(name == "", empty).otherwise(name))

    def _append(self, rows: DataFrame, gone: bool = False, whole: bool = False) -> None:
        changes = self._changes()
        latest = changes.agg(F.max("version")).first()[0] or 0 if changes is not None else 0
        marks = {"version": F.lit(latest + 1).cast("long"), "gone": F.lit(gone), "whole": F.lit(whole)}
        counted = self.summaries is not None and self.summaries.exist()
        if counted:
            self.summaries.announce(latest + 1)
        rows.withColumns(marks).hint("rebalance").write.mode("append").parquet(self.recent)
        if counted:
            self.summaries.settle()
        if latest + 1 >= self.compact_after:
            self.compact()

    def _write_base(self, rows: DataFrame) -> None:
        if self.groups and GROUP_COLUMN not in rows.columns:
            rows = rows.withColumn(GROUP_COLUMN, self.group(F.col("source_file")))
        (
            rows.hint("rebalance", self.partition)
            .sortWithinPartitions(self.partition, "source_file", "page_number")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition)
            .parquet(self.base)
        )

    def compact(self) -> None:
        """Merge the recent rows into the base.

        Only directories of the base that a change touches are rewritten, and exchanged when that job
        commits; then the recent files go. If this ends between the two, recent rows are
        applied to a base that has them already, which changes nothing.
        """
        changes = self._changes()
        if changes is None:
            return
        place = self.group(F.col("source_file")) if self.groups else F.col("source_file")
        touched = changes.select(place.alias("__place")).distinct()
        # One value per touched directory: at most ``groups`` (see the class for None).
        places = sorted(row[0] for row in touched.collect())
        rows = self._read().filter(F.col(self.partition).isin(places))
        filled = {row[0] for row in rows.select(self.partition).distinct().collect()}
        self._write_base(rows)
        for value in places:
            if value not in filled:
                self._remove(f"{self.base}/{self.partition}={escaped(str(value))}")
        self._remove(self.recent)
        if self._has(f"{self.base}/{self.partition}={self.no_group}"):
            self.create()


def escaped(value: str) -> str:
    """A value as directory names have it: characters that a path may not hold as ``%XX``."""
    return "".join(f"%{ord(c):02X}" if c in RESERVED or ord(c) < 32 or ord(c) == 127 else c for c in value)


def without_sources(pages: DataFrame, pattern: str) -> DataFrame:
    """Pages whose source does not match the LIKE ``pattern``."""
    return pages.filter(~F.coalesce(F.col("source_file").like(pattern), F.lit(False)))


def without_keys(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """Pages that are not listed in ``keys``."""
    return pages.join(keys, keys.columns, "left_anti")


def page_vectors(
    pages: DataFrame, embed: Callable[[str], Column], max_chars: int | None = None
) -> DataFrame:
    """Pages ready to store, with the vector of the whole text. The text stays whole, or
    is cut to ``max_chars``, which searches by keyword then cannot see past."""
    vectors = pages.withColumn("embedding", embed("text"))
    return vectors.withColumn("text", cut("text", max_chars)) if max_chars else vectors


def chunk_vectors(
    pages: DataFrame, embed: Callable[[str], Column], max_chars: int | None = None
) -> DataFrame:
    """The same for chunks: their pages' texts joined, under the number of the first page."""
    return page_vectors(chunk_texts(pages), embed, max_chars).withColumn("page_number", F.col("start_page"))


def append_rows(rows: DataFrame, path: str, partition: str | None = None) -> None:
    """Add rows without looking at those stored before."""
    writer = (rows.hint("rebalance", partition) if partition else rows).write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
