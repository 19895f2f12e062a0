"""Keyword search by case-insensitive pattern, over one list of keywords."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import like_pattern, snippet
from folioscope.operators.search import in_source, ranked
from folioscope.schemas import PAGE_KEY

DEFAULT_LIMIT = 10
SHARES = 64


def matches(text: str, keyword: str, literal: bool) -> Column:
    return F.col(text).ilike(like_pattern(keyword, literal))


def any_keyword(
    pages: DataFrame,
    keywords: Sequence[str],
    limit: int = DEFAULT_LIMIT,
    source: str | None = None,
    key: Sequence[str] = PAGE_KEY,
    text: str = "text",
    literal: bool = False,
) -> DataFrame:
    """Pages that contain at least one keyword, the first ``limit`` in key order."""
    if not keywords:
        return pages.limit(0)
    found = reduce(or_, [matches(text, keyword, literal) for keyword in keywords])
    return in_source(pages, source).filter(found).orderBy(*key).limit(limit)


def match_counts(pages: DataFrame, keywords: Sequence[str], text: str = "text", literal: bool = False) -> DataFrame:
    """The pages that contain one of the keywords, with ``matches``, how many, in place of
    the text."""
    found = [F.when(matches(text, keyword, literal), 1).otherwise(0) for keyword in keywords]
    total = reduce(lambda a, b: a + b, found, F.lit(0))
    return pages.withColumn("matches", F.coalesce(total, F.lit(0))).filter("matches > 0").drop(text)


def ranked_by_matches(
    pages: DataFrame,
    keywords: Sequence[str],
    limit: int,
    key: Sequence[str] = PAGE_KEY,
    text: str = "text",
    literal: bool = False,
) -> DataFrame:
    """The ``limit`` pages that contain most of the keywords, with ``matches`` and
    ``rank``; equals by key."""
    counted = match_counts(pages, keywords, text, literal)
    order = [F.desc("matches"), *[F.asc(name) for name in key]]
    return ranked(counted.orderBy(*order).limit(limit), order)


def each_keyword(
    pages: DataFrame,
    keywords: Sequence[str],
    limit: int = DEFAULT_LIMIT,
    key: Sequence[str] = PAGE_KEY,
    text: str = "text",
    literal: bool = False,
    snippet_chars: int = 200,
) -> DataFrame:
    """For each keyword its first ``limit`` pages, as ``(keyword, rank, ...)``; a page
    appears once per keyword. ``text`` becomes a snippet.

    One scan tests all keywords and emits a row per match; no join with the keywords.
    Texts are cut before the sort. A keyword's matches are ranked in two steps, first in
    ``SHARES`` shares of them, so that no task sorts all matches of a frequent keyword,
    whatever the limit.
    """
    if not keywords:
        return pages.limit(0).withColumns({"keyword": F.lit(""), "rank": F.lit(0).cast("long")})
    matched = [
        F.when(matches(text, keyword, literal), F.struct(F.lit(n).alias("n"), F.lit(keyword).alias("k")))
        for n, keyword in enumerate(keywords)
    ]
    others = [name for name in pages.columns if name != text]
    hits = pages.withColumn("__hit", F.explode(F.array_compact(F.array(*matched)))).select(
        *others,
        F.col("__hit.n").alias("__n"),
        F.col("__hit.k").alias("keyword"),
        snippet(text, snippet_chars).alias(text),
    )
    order = [F.asc(name) for name in key]
    share = F.pmod(F.xxhash64(*key), F.lit(SHARES))
    shares = ranked(hits.withColumn("__share", share), order, per=["__n", "__share"])
    first = ranked(shares.filter(F.col("rank") <= limit).drop("rank"), order, per=["__n"])
    return first.filter(F.col("rank") <= limit).drop("__n", "__share")
