"""What follows a search: comparison, prompt context, evaluation, fusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions.vectors import ROUNDING
from folioscope.operators.search import DEFAULT_TOP_K, ranked

# Fixed value: the prompt around the retrieved context.
PROMPT = ("Context: ", "\nQuestion: ", "\nAnswer:")


def compare_results(
    hits: DataFrame, queries: DataFrame, top: Sequence[str], query: str = "query_id", nested: bool = False
) -> DataFrame:
    """For each row of ``queries`` the number of hits, their mean similarity (a missing one
    counts as 0) and the columns ``top`` of the first hit, as ``top_*``. ``nested`` adds
    ``results``: these columns of all hits, by rank. A query without a hit has 0, 0.0 and
    NULLs (and an empty list)."""
    first = [F.min_by(name, "rank").alias(f"top_{name}") for name in top]
    if nested:
        first.append(F.array_sort(F.collect_list(F.struct("rank", *top))).alias("results"))
    found = hits.groupBy(query).agg(
        F.count(F.lit(1)).alias("num_results"),
        F.round(F.avg(F.coalesce("similarity", F.lit(0.0))), ROUNDING).alias("avg_similarity"),
        *first,
    )
    whole = queries.select(query).join(found, query, "left")
    empty = {"num_results": F.lit(0).cast("long"), "avg_similarity": F.lit(0.0)}
    if nested:
        empty["results"] = F.array().cast(found.schema["results"].dataType)
    return whole.withColumns({name: F.coalesce(name, value) for name, value in empty.items()})


def _context(text: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("rank", text)))
    return F.array_join(F.transform(ordered, lambda hit: hit[text]), "\n")


def context_by_query(hits: DataFrame, query: str = "query_id", text: str = "text") -> DataFrame:
    """The texts of the hits of each query, joined by line feeds in rank order."""
    return hits.groupBy(query).agg(F.count(F.lit(1)).alias("num_results"), _context(text).alias("context"))


def prompt(question: Column | str, context: Column | str = "context") -> Column:
    question = F.col(question) if isinstance(question, str) else question
    context = F.col(context) if isinstance(context, str) else context
    before, between, after = (F.lit(part) for part in PROMPT)
    return F.concat(before, context, between, question, after)


def precision(
    hits: DataFrame,
    labels: DataFrame,
    queries: DataFrame,
    key: Sequence[str],
    label: str = "label",
    expected: str = "expected_label",
    query: str = "query_id",
) -> DataFrame:
    """Share of hits with the expected label for each query, and whether the first has it.

    ``queries`` have ``query`` and ``expected``; ``labels`` give ``label`` by ``key``. A hit
    without a label is wrong; a query without a hit has precision 0.
    """
    labelled = hits.select(query, "rank", *key).join(labels.select(*key, label), list(key), "left")
    scored = queries.select(query, expected).join(labelled, query, "left")
    right = F.coalesce(F.col(label) == F.col(expected), F.lit(False))
    return scored.groupBy(query, expected).agg(
        F.count("rank").alias("num_results"),
        F.round(F.coalesce(F.sum(right.cast("double")) / F.nullif(F.count("rank"), F.lit(0)), F.lit(0.0)), ROUNDING).alias(
            "precision"
        ),
        F.coalesce(F.max(F.when(F.col("rank") == 1, right)), F.lit(False)).alias("top_hit_right"),
    )


def agreement(hits: DataFrame, groups: DataFrame, key: Sequence[str], group: str, query: str = "query_id") -> DataFrame:
    """How many different rows the queries of one group rank first."""
    return (
        hits.filter(F.col("rank") == 1)
        .join(groups.select(query, group), query)
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("num_queries"),
            F.count_distinct(F.struct(*key)).alias("top_rows"),
        )
        .withColumn("agree", F.col("top_rows") == 1)
    )


def fuse(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    k: int = DEFAULT_TOP_K,
    constant: int = 60,
) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists: ``1 / (constant + rank)``, summed."""
    key = list(key)

    def share(hits: DataFrame, name: str) -> DataFrame:
        return hits.select(*key, (F.lit(1.0) / (F.col("rank") + constant)).alias(name))

    both = share(left, "__left").join(share(right, "__right"), key, "full")
    zero = F.lit(0.0)
    score = F.coalesce("__left", zero) + F.coalesce("__right", zero)
    fused = both.select(*key, F.round(score, 9).alias("score"))
    order = [F.desc("score"), *[F.asc(name) for name in key]]
    return ranked(fused.orderBy(*order).limit(k), order)


def ranks_of(wanted: DataFrame, rows: DataFrame, key: Sequence[str], score: str, name: str) -> DataFrame:
    """``*key, name``: the place of each row of ``wanted`` in ``rows`` by score, missing last,
    then by key. Rows of ``wanted`` that are not among ``rows`` have none.

    ``wanted`` has a bounded number of rows. Rows are counted by how many of its scores they
    exceed, and rows of equal score by how many have a lower key; nothing is sorted.
    """
    key = list(key)
    value = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    valued = rows.select(*key, value.alias("__score"))
    held = valued.join(F.broadcast(wanted.select(*key).distinct()), key)
    held = rows.sparkSession.createDataFrame(held.collect(), held.schema)
    steps = sorted(row["__score"] for row in held.select("__score").distinct().collect())
    if not steps:
        return held.select(*key, F.lit(0).cast("long").alias(name))
    exceeded = F.size(F.filter(F.array(*map(F.lit, steps)), lambda step: step < F.col("__score")))
    counts = {row["e"]: row["count"] for row in valued.groupBy(exceeded.alias("e")).count().collect()}
    above = {step: sum(n for e, n in counts.items() if e > at) for at, step in enumerate(steps)}
    better = F.element_at(F.create_map(*(F.lit(x) for pair in above.items() for x in pair)), F.col("__score"))
    mine = held.select("__score", F.struct(*key).alias("__mine"))
    equal = valued.join(F.broadcast(mine), "__score").filter(F.struct(*key) < F.col("__mine"))
    before = equal.groupBy("__mine").agg(F.count(F.lit(1)).alias("__before")).select("__mine.*", "__before")
    place = better + F.coalesce("__before", F.lit(0)) + 1
    return held.join(before, key, "left").select(*key, place.cast("long").alias(name))


def fuse_whole(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    scores: tuple[str, str],
    k: int = DEFAULT_TOP_K,
    constant: int = 60,
) -> DataFrame:
    """Reciprocal-rank fusion of two whole lists, given as rows with scores, not ranks.

    The ``k``-th best sum is at least ``1 / (constant + k)``, the share of a ``k``-th place. A row
    beyond the first ``constant + 2k`` places of both lists has less, so only rows among
    these can be hits, and only their places are taken, each in the whole of both lists. A
    list is read three times: hand in written rows.
    """
    key, depth = list(key), constant + 2 * k
    lists = ((left, scores[0], "__left"), (right, scores[1], "__right"))

    def first(rows: DataFrame, score: str) -> DataFrame:
        order = [F.desc_nulls_last(score), *[F.asc(name) for name in key]]
        return rows.orderBy(*order).limit(depth).select(*key)

    both = first(left, scores[0]).union(first(right, scores[1])).distinct()
    wanted = left.sparkSession.createDataFrame(both.collect(), both.schema)  # 2 * depth rows at most
    fused = wanted
    for rows, score, name in lists:
        fused = fused.join(ranks_of(wanted, rows, key, score, name), key, "left")
    share = [F.coalesce(F.lit(1.0) / (F.col(name) + constant), F.lit(0.0)) for _, _, name in lists]
    order = [F.desc("score"), *[F.asc(name) for name in key]]
    return ranked(fused.select(*key, F.round(share[0] + share[1], 9).alias("score")).orderBy(*order).limit(k), order)


def without_self(hits: DataFrame, key: str, k: int, query: str = "query_id") -> DataFrame:
    """Neighbours of rows that were queries themselves: no row as its own hit.

    ``hits`` must hold ``k + 1`` ranks, of which at most one goes.
    """
    own = F.max(F.when(F.col(key) == F.col(query), F.col("rank"))).over(Window.partitionBy(query))
    moved = F.col("rank") - F.when(F.col("rank") > own, 1).otherwise(0)
    others = hits.withColumn("__moved", moved).filter(F.col(key) != F.col(query))
    return others.withColumn("rank", F.col("__moved")).drop("__moved").filter(F.col("rank") <= k)
