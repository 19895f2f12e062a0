"""The operators of this package as queries on the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import (
    bpe,
    chat,
    compression,
    decontaminate,
    language,
    licenses,
    quality,
    repair,
    secrets,
    sharding,
    simhash,
    spelling,
    url_filters,
)
from folioscope.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Roles of all messages of ``conversations``, recovered from their lines, as turns."""
    return chat.parse_transcripts(table(spark, folder, "conversations"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every text and the bytes they decode to, as digests."""
    ranks = bpe.read_ranks(RANKS)
    documents = table(spark, folder, "documents")
    return bpe.encode(documents, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Eight contiguous shards of near equal bytes over all documents."""
    return sharding.shard_by_bytes(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License wording in every document."""
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document, and how many are live or widely copied."""
    found = secrets.find_secrets(table(spark, folder, "documents"))

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(test: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(name: str) -> Column:
        return count(lambda s: s["kind"] == name)

    base = F.filter("spans", lambda s: s["base"])
    told = F.filter("spans", lambda s: s["base"] | s["live"])
    return found.select(
        "doc_id",
        *(of_kind(kind.name).alias(f"n_{kind.name}") for kind in secrets.BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(told).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["example"] & s["base"]).alias("n_example"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["repositories"])), F.lit(0)).alias("most_repositories"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["owners"])), F.lit(0)).alias("most_owners"),
    )


def _secrets_sql() -> str:
    """The same over lists of matches and of the pieces between them."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    kinds = " UNION ALL ".join(
        f"""SELECT row, doc_id, source, {quoted(k.name)} AS kind, {rank} AS rank, {str(k.base).lower()} AS base,
            {k.least} AS least, regexp_extract_all(text, {quoted(k.pattern)}, 0) AS m,
            regexp_extract_all(text, {quoted(k.pattern)}, {k.group}) AS v,
            regexp_split_to_array(text, {quoted(k.pattern)}) AS p
            FROM docs WHERE regexp_matches(text, {quoted(k.pattern)})"""
        for rank, k in enumerate(secrets.KINDS)
    )
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text FROM documents
        ), lists AS ({kinds}), parts AS (
            SELECT row, doc_id, source, kind, rank, base, least, unnest(m) AS m, unnest(v) AS v,
                   unnest(p[1:len(m)]) AS p, unnest(range(len(m))) AS i
            FROM lists
        ), placed AS (
            SELECT *, sum(length(m) + length(p)) OVER (PARTITION BY row, rank ORDER BY i) AS e FROM parts
        ), spans AS (
            SELECT row, doc_id, source, kind, rank, base, v, e - length(m) AS s, e FROM placed WHERE length(v) >= least
        ), owners AS (
            SELECT v, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS owners,
                   count(DISTINCT (coalesce(source, ''), source IS NULL, doc_id)) AS repositories
            FROM spans GROUP BY v
        ), examples AS (
            SELECT *, owners >= {secrets.EXAMPLE_OWNERS} OR repositories >= {secrets.EXAMPLE_REPOSITORIES} AS example
            FROM owners
        ), judged AS (
            SELECT spans.*, owners, repositories, example,
                   NOT example AND (base OR (
                       len(list_distinct(string_split(v, ''))) >= {secrets.LIVE_CHARACTERS}
                       AND regexp_matches(v, '[0-9]'))) AS live
            FROM spans JOIN examples USING (v)
        ), listed AS (
            SELECT row,
                   count(*) FILTER (kind = 'assign') AS n_assign,
                   count(*) FILTER (kind = 'access') AS n_access,
                   count(*) FILTER (kind = 'hex') AS n_hex,
                   string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (base) AS base_spans,
                   string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (base OR live) AS spans,
                   count(*) FILTER (live) AS n_live,
                   count(*) FILTER (example AND base) AS n_example,
                   max(repositories)::BIGINT AS most_repositories, max(owners)::BIGINT AS most_owners
            FROM judged GROUP BY row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
               coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
               coalesce(most_repositories, 0) AS most_repositories, coalesce(most_owners, 0) AS most_owners
        FROM docs LEFT JOIN listed USING (row)
    """


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that leak items of ``benchmark``, and which."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every URL of ``pages``."""
    return url_filters.judge_urls(table(spark, folder, "pages"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; a third of them was not learned from."""
    return language.language_of_documents(table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and quality verdict of every document."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality.judge_quality(documents, labels)


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all texts, some of them damaged, with their near words, forms and roots."""
    return spelling.spelling_variants(table(spark, folder, "documents"), damaged=spelling.DAMAGED)


def op12_quality_compression(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document by two dictionaries; a fifth of them was not learned from."""
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return compression.score_quality(documents, labels)


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and repaired digest of every conversation, damaged before."""
    conversations = table(spark, folder, "conversations")
    harmed = repair.damaged(conversations)
    told = repair.summaries(repair.repair(harmed)).withColumnRenamed("conv_id", "id")
    gaps = repair.gaps_of(harmed).withColumnRenamed("conv_id", "gaps_id")
    every = conversations.select("conv_id").distinct()
    joined = every.join(told, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    joined = joined.join(gaps, F.col("conv_id").eqNullSafe(F.col("gaps_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_licenses": op4_licenses,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_url_filters": op8_url_filters,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_quality_compression": op12_quality_compression,
    "op13_repair": op13_repair,
}

ORACLES: dict[str, str] = {
    "op5_secrets": _secrets_sql(),
    "op8_url_filters": r"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), split AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), hosts AS (
            SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path
            FROM split
        ), ruled AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/')
                    THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/')
                    THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
            END AS rule
            FROM hosts
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN host || path = '' OR regexp_matches(host || path, '(?s)^ads-[^/]*/|/(login|admin|cgi-bin|tag)/|\.(jpg|png|gif|zip|exe)$')
                THEN 'block'
            ELSE 'allow'
        END AS verdict
        FROM ruled
    """,
}
