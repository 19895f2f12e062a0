"""Keyword search through an index of trigrams.

A page that matches a pattern holds every run of three literal characters of it. The
index gives the pages that hold the rarest of these; only their texts are read, and the
pattern is tried on them, so hits are those of a scan. A pattern without three literal
characters in a row is searched by a scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.functions.text import like_pattern, snippet
from folioscope.operators import keywords as scans
from folioscope.operators.keywords import DEFAULT_LIMIT, SHARES, matches
from folioscope.operators.search import in_source, ranked
from folioscope.schemas import PAGE_KEY
from folioscope.session import scratch_path
from folioscope.sources.postings import DEFAULT_GROUPS, PostingTable, literal_keys, trigram_codes, trigram_terms

#: Of a pattern so many trigrams, the rarest, are intersected.
MOST_LISTS = 6
#: So many candidates of a pattern, times the limit, are read by their keys at first.
AT_FIRST = 4
#: Up to such limits keys travel as literals.
MOST_KEYS = 1000


def literal_runs(pattern: str) -> list[str]:
    """The runs of literal characters of a LIKE pattern."""
    runs, run, at = [], "", 0
    while at < len(pattern):
        character = pattern[at]
        if character == "\\" and at + 1 < len(pattern):
            at += 1
            run += pattern[at]
        elif character in "%_":
            runs.append(run)
            run = ""
        else:
            run += character
        at += 1
    return [found for found in [*runs, run] if found]


class TrigramIndex:
    """The trigrams of the pages of a store, at ``path``."""

    def __init__(self, spark: SparkSession, path: str, groups: int = DEFAULT_GROUPS):
        self.table = PostingTable(spark, path, trigram_terms, T.LongType(), groups)
        self.spark, self.build, self.refresh = spark, self.table.build, self.table.refresh
        self.groups_of = self.table.groups_of

    def grams(self, patterns: Sequence[str]) -> list[list[int]]:
        """The trigrams that a match of each LIKE pattern holds, rarest first; an empty list if
        the pattern has none, ``[0]`` if no page has one of them.

        Case is folded by the same function as in ILIKE and in the index.
        """
        folded = self.spark.range(1).select(F.array(*(F.lower(F.lit(p)) for p in patterns)).alias("p"))
        of_each = []
        for pattern in folded.first()["p"]:
            codes = {int(code) for run in literal_runs(pattern) for code in trigram_codes(run)}
            of_each.append(sorted(codes))
        counts = self.table.counts({code for codes in of_each for code in codes})
        chosen = []
        for codes in of_each:
            lost = [code for code in codes if code not in counts]
            chosen.append([0] if lost else sorted(codes, key=lambda code: (counts[code], code))[:MOST_LISTS])
        return chosen

    def candidates(self, grams: dict[int, list[int]], source: str | None = None) -> DataFrame:
        """``which, source_file, page_number``: the pages (of one source, if named) that hold
        all trigrams of a number.

        Lists of a block meet in one row each and are intersected, the rarest first; a
        block has as many pages as a list may have.
        """
        uses: dict[int, list[tuple[int, int]]] = {}
        for which, codes in grams.items():
            for order, code in enumerate(codes):
                uses.setdefault(code, []).append((which, order))
        if not uses:
            return self.spark.createDataFrame([], "which int, source_file string, page_number int")
        use = F.create_map(
            *(
                x
                for code, places in uses.items()
                for x in (
                    F.lit(code),
                    F.array(*(F.struct(F.lit(w).alias("which"), F.lit(o).alias("order")) for w, o in places)),
                )
            )
        )
        wanted = F.create_map(*(F.lit(x) for which, codes in grams.items() for x in (which, len(codes))))
        block = ["source_file", "part"]
        lists = in_source(self.table.of_terms(uses), source).groupBy("term", *block).agg(F.flatten(F.collect_list("pages")).alias("pages"))
        placed = lists.select(*block, "pages", F.explode(F.element_at(use, F.col("term"))).alias("use"))
        met = placed.groupBy("use.which", *block).agg(
            F.array_sort(F.collect_list(F.struct("use.order", "pages"))).alias("lists")
        )
        full = met.filter(F.size("lists") == F.element_at(wanted, F.col("which")))
        pages = F.aggregate(
            F.slice(F.transform("lists", lambda one: one["pages"]), 2, MOST_LISTS),
            F.array_distinct(F.col("lists")[0]["pages"]),
            F.array_intersect,
        )
        return full.select("which", "source_file", F.explode(pages).alias("page_number"))


def _first(candidates: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` candidates of each number in order of the key, ranked in shares
    first, as a frequent pattern has very many."""
    order = [F.asc(name) for name in PAGE_KEY]
    share = F.pmod(F.xxhash64(*PAGE_KEY), F.lit(SHARES))
    shares = ranked(candidates.withColumn("__share", share), order, per=["which", "__share"])
    best = ranked(shares.filter(F.col("rank") <= limit).drop("rank"), order, per=["which"])
    return best.filter(F.col("rank") <= limit).drop("__share")


def _hits(pages: DataFrame, found: dict[int, str], literal: bool) -> DataFrame:
    """``pages`` once for each number whose keyword they match, with ``which``."""
    tests = [F.when(matches("text", keyword, literal), F.lit(which)) for which, keyword in found.items()]
    return pages.withColumn("which", F.explode(F.array_compact(F.array(*tests))))


def _search(
    index: TrigramIndex, pages: DataFrame, asked: dict[int, str], limit: int, literal: bool, source: str | None = None
) -> list[DataFrame]:
    """Matching pages with ``which``, for each number all of the first ``limit`` at least.

    At first the first few candidates are read, by their keys. Where too few of them match and
    there are more, all candidates are joined with the pages. Candidates are written, keys
    alone: so they are found once, and Spark knows their size and sends few of them to the
    pages instead of moving all texts.
    """
    grams = dict(zip(asked, index.grams([like_pattern(keyword, literal) for keyword in asked.values()])))
    grams = {which: codes for which, codes in grams.items() if codes != [0]}
    if not grams or limit < 1:
        return []
    path = scratch_path(index.spark, "candidates")
    index.candidates(grams, source).write.parquet(path)
    candidates = index.spark.read.parquet(path)
    several = AT_FIRST * limit
    short, out = list(grams), []
    if limit <= MOST_KEYS:
        heads: dict[int, list] = {which: [] for which in grams}
        for row in _first(candidates, several + 1).collect():  # a bounded number for each keyword
            heads[row["which"]].append((row["source_file"], row["page_number"]))
        read = {key for found in heads.values() for key in found[:several]}
        near = _hits(pages.filter(literal_keys(read)), {which: asked[which] for which in grams}, literal)
        counts = {row["which"]: row["count"] for row in near.groupBy("which").count().collect()}
        short = [which for which, found in heads.items() if len(found) > several and counts.get(which, 0) < limit]
        done = [which for which in grams if which not in short]
        out += [near.filter(F.col("which").isin(done))] if done else []
    if short:
        rest = candidates.filter(F.col("which").isin(short)).withColumnRenamed("which", "__which")
        joined = pages.join(rest, list(PAGE_KEY))
        found = _hits(joined, {which: asked[which] for which in short}, literal)
        out.append(found.filter(F.col("which") == F.col("__which")).drop("__which"))
    return out


def _scanned(index: TrigramIndex, keywords: Iterable[str], literal: bool) -> list[bool]:
    return [not codes for codes in index.grams([like_pattern(keyword, literal) for keyword in keywords])]


def any_keyword(
    index: TrigramIndex,
    pages: DataFrame,
    keywords: Sequence[str],
    limit: int = DEFAULT_LIMIT,
    source: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """As :func:`folioscope.operators.keywords.any_keyword`, through the index. If one of the keywords
    has no trigram, all are searched by a scan."""
    if not keywords:
        return pages.limit(0)
    if any(_scanned(index, keywords, literal)):
        return scans.any_keyword(pages, keywords, limit, source, literal=literal)
    pages = in_source(pages, source)
    found = _search(index, pages, dict(enumerate(dict.fromkeys(keywords))), limit, literal, source)
    if not found:
        return pages.limit(0)
    hits = reduce(DataFrame.unionByName, found).select(*PAGE_KEY).distinct().orderBy(*PAGE_KEY).limit(limit)
    if limit > MOST_KEYS:
        return pages.join(hits, list(PAGE_KEY)).orderBy(*PAGE_KEY)
    return pages.filter(literal_keys([tuple(row) for row in hits.collect()])).orderBy(*PAGE_KEY)


def each_keyword(
    index: TrigramIndex,
    pages: DataFrame,
    keywords: Sequence[str],
    limit: int = DEFAULT_LIMIT,
    literal: bool = False,
    snippet_chars: int = 200,
) -> DataFrame:
    """As :func:`folioscope.operators.keywords.each_keyword`, through the index; keywords without a
    trigram are searched by a scan."""
    if not keywords:
        return scans.each_keyword(pages, keywords, limit)
    scanned = _scanned(index, keywords, literal)
    asked = {which: keyword for which, keyword in enumerate(keywords) if not scanned[which]}
    out = []
    if asked:
        for hits in _search(index, pages, asked, limit, literal):
            first = _first(hits.withColumn("text", snippet("text", snippet_chars)), limit)
            name = F.create_map(*(F.lit(x) for pair in asked.items() for x in pair))
            out.append(first.withColumn("keyword", F.element_at(name, F.col("which"))).drop("which"))
    rest = [keyword for keyword, scan in zip(keywords, scanned) if scan]
    if rest or not out:
        out.append(scans.each_keyword(pages, rest, limit, literal=literal, snippet_chars=snippet_chars))
    return reduce(DataFrame.unionByName, out)
