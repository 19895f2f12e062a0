"""Secrets in texts, judged by how widely their values are owned.

Everything here is DataFrame functions. A pattern cuts a text into the pieces between its
matches; running lengths of pieces and matches give the spans, in code points. Values of
candidates are hashed; for each hash the distinct repositories and owners are counted over
the whole corpus. A value found with many owners, or in very many repositories, is a widely
copied example; one that few hold, and that looks random, is a live credential.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import settled, whole

#: Owners from which on a value counts as a widely copied example.
EXAMPLE_OWNERS = 8
#: Repositories from which on it counts as one, whoever owns them.
EXAMPLE_REPOSITORIES = 1000
#: Matches whose places are summed at a time.
BLOCK = 256
#: A value looks live if it has so many different characters, and a digit.
LIVE_CHARACTERS = 8


@dataclass(frozen=True)
class Kind:
    """A pattern; the group that holds the value; the least lengths of match and value.
    ``base`` kinds are reported whatever is known of their values."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = True


# The base kinds.
BASE = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 16),
    # The same matches as [0-9a-f]+ of 32 or more: runs are maximal either way.
    Kind("hex", r"[0-9a-f]{32,}", 0, 32),
)

# Prefixes and marks of well-known credentials.
FURTHER = (
    Kind("bearer", r"(?i:\bbearer)\x20+([A-Za-z0-9._~+/-]{16,})", 1, 16, False),
    Kind("github", r"\bgh[opsu]_[A-Za-z0-9]{20,}", 0, 24, False),
    Kind("slack", r"\bxox[abps]-[A-Za-z0-9-]{16,}", 0, 20, False),
    Kind("stripe", r"\b[rs]k_live_[A-Za-z0-9]{16,}", 0, 24, False),
    Kind("google", r"\bAIza[A-Za-z0-9_-]{30,}", 0, 34, False),
    Kind("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 26, False),
    Kind("upper_hex", r"[0-9A-F]{40,}", 0, 40, False),
)

KINDS = (*BASE, *FURTHER)

SPAN = "struct<kind:string,rank:int,base:boolean,start:int,end:int,value:string>"


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it; inside
    of a lambda an expression from outside would be computed for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """The spans of one kind in order, as an array of ``SPAN``.

    Places are running sums over pieces and matches. They are taken in blocks, within each
    and over the blocks' totals, as a list that grows by copying would cost the square of
    the matches.
    """
    pattern = F.lit(kind.pattern)
    nothing = F.array().cast(f"array<{SPAN}>")
    matched = F.struct(
        F.transform(F.split(text, kind.pattern, -1), F.length).alias("gaps"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"),
        F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("values"),
    )

    def zipped(m: Column) -> Column:
        ends = F.transform(m["matches"], F.length)
        return F.arrays_zip(
            F.slice(m["gaps"], 1, F.size(m["matches"])).alias("gap"), ends.alias("length"), m["values"].alias("value")
        )

    def step(state: Column, one: Column) -> Column:
        begin = state["at"] + one["gap"]
        end = begin + one["length"]
        span = F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(rank).alias("rank"),
            F.lit(kind.base).alias("base"),
            begin.alias("start"),
            end.alias("end"),
            one["value"].alias("value"),
        )
        kept = F.length(one["value"]) >= kind.least
        spans = F.when(kept, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))

    def blocks_of(parts: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")),
            lambda block: F.aggregate(F.slice(parts, block * BLOCK + 1, F.lit(BLOCK)), start, step),
        )

    blocks = with_value(with_value(matched, zipped), blocks_of)

    def follow(state: Column, block: Column) -> Column:
        return F.struct(
            (state["at"] + block["at"]).alias("at"),
            F.concat(state["blocks"], F.array(F.struct(state["at"].alias("at"), block["spans"].alias("spans")))).alias(
                "blocks"
            ),
        )

    placed = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,spans:array<{SPAN}>>>").alias("blocks")),
        follow,
        lambda state: state["blocks"],
    )

    def moved(span: Column, by: Column) -> Column:
        names = ("kind", "rank", "base", "start", "end", "value")
        return F.struct(*((span[n] + by if n in ("start", "end") else span[n]).alias(n) for n in names))

    found = F.flatten(F.transform(placed, lambda block: F.transform(block["spans"], lambda s: moved(s, block["at"]))))
    return F.when(text.rlike(kind.pattern), found).otherwise(nothing)


def candidates(text: Column, kinds: Sequence[Kind] = KINDS) -> Column:
    """All spans of a text, by start and then by kind as listed."""
    found = F.flatten(F.array(*(spans_of(text, kind, rank) for rank, kind in enumerate(kinds))))
    keyed = F.transform(found, lambda s: F.struct(s["start"], s["rank"], s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def ownership(found: DataFrame) -> DataFrame:
    """``digest, repositories, owners``: how many distinct ones hold each value.

    ``found`` has ``digest, owner, repository``. Repeats are dropped before each shuffle,
    so a value that stands in a third of all rows costs each task one row per repository.
    """
    held = found.groupBy("digest", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = held.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("digest").agg(
        F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners")
    )


def looks_live(value: Column) -> Column:
    """Enough different characters, a digit among them."""
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (distinct >= LIVE_CHARACTERS) & value.rlike("[0-9]")


def _verdicts(rows: DataFrame, example_owners: int, example_repositories: int) -> DataFrame:
    """``row, spans`` for rows with ``row, owner, repository, found``: the spans, each with
    ``live``, ``example`` and the two counts. Spans come apart once, meet the counts of their values by hash, and come
    together again by row; texts are not among the columns."""
    hits = rows.select("row", "owner", "repository", F.explode("found").alias("span"))
    hits = hits.withColumn("digest", F.sha2(F.col("span.value"), 256))
    known = ownership(hits)
    likely = F.col("span.base") | looks_live(F.col("span.value"))
    example = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    spans = hits.join(known, "digest").select(
        "row",
        F.struct(
            F.col("span.start").alias("start"),
            F.col("span.rank").alias("rank"),
            F.col("span.kind").alias("kind"),
            F.col("span.base").alias("base"),
            F.col("span.end").alias("end"),
            (likely & ~example).alias("live"),
            example.alias("example"),
            F.col("owners").alias("owners"),
            F.col("repositories").alias("repositories"),
        ).alias("span"),
    )
    return spans.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def find_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, spans``, an array of ``start, rank, kind,
    base, end, live, example, owners, repositories`` in order of start and kind.

    A span is an ``example`` if its value is held by ``example_owners`` owners or stands in
    ``example_repositories`` repositories (of an owner each) or more. It is ``live`` if it is not and is of a base kind or looks random. NULL and empty texts
    have no spans. A NULL owner or repository counts as one of its own. Repeated rows are
    reported each and count once. Texts are read whole; further columns are ignored.
    """
    rows = settled(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.col(owner).alias("owner"),
            F.col(repository).cast("string").alias("repository"),
            candidates(whole(text)).alias("found"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    verdicts = _verdicts(rows.filter(F.size("found") > 0), example_owners, example_repositories)
    nothing = F.array().cast(verdicts.schema["spans"].dataType)
    return rows.join(verdicts, "row", "left").select(
        "doc_id", F.coalesce("spans", nothing).alias("spans")
    )


def blanked(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span replaced by the mark; overlapping spans become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], before, F.lit(mark))).alias("out"),
        )

    return F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))),
    )


def redacted(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
    example_repositories: int = EXAMPLE_REPOSITORIES,
    mark: str = "[secret]",
    length: str = "n_chars",
) -> DataFrame:
    """The rows of ``docs``, all columns, with ``mark`` in place of every live span; a
    column ``length``, if there is one, then has the new number of characters.

    Only rows with candidates are written to the checkpoint folder and joined; all others
    pass through as they are.
    """
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("doc")
    found = docs.select(row, candidates(whole(text)).alias("found"))
    hit = settled(
        found.filter(F.size("found") > 0).select(
            "doc",
            "found",
            F.col("doc")[owner].alias("owner"),
            F.col("doc")[id_column].cast("string").alias("repository"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    live = F.filter("spans", lambda span: span["live"])
    masked = hit.join(_verdicts(hit, example_owners, example_repositories), "row").select(
        "doc", "spans", blanked(F.col("doc")[text], live, mark).alias("masked")
    )
    changed = F.exists("spans", lambda span: span["live"])
    new = {
        text: F.when(changed, F.col("masked")).otherwise(F.col("doc")[text]),
        length: F.when(changed, F.length("masked").cast("long")).otherwise(F.col("doc")[length]),
    }
    columns = [new.get(name, F.col("doc")[name]).alias(name) for name in docs.columns]
    return docs.filter(F.size(candidates(whole(text))) == 0).unionByName(masked.select(*columns))
