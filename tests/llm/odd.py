"""Documents with everything that is unusual about a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, "
    "spans string, size int, shard int, row long, part int, found string, lang_pred string, `group` int, term int"
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``rows``: id, text, language, source. Further columns clash with what operators make."""
    extra = (1, 0.5, "x", 3, 4, 5, 6, "y", "zz", 7, 8)
    full = [(i, t, lang, source, None if t is None else len(t), *extra) for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = "Over the hills and far away, said number %d.\n"

ODD = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n\x0b\f\r ", None, None),
    (4, "one", "fr", "b"),
    (5, "Two WORDS", "fr", "b"),
    (6, "same text here with some words", "en", "c"),
    (6, "same text here with some words", "en", "c"),
    (7, "same text here with some words", "en", "d"),
    (None, "same text here with some words", "en", "d"),
    (None, None, None, None),
    (8, "".join(LONG % (i % 977) for i in range(6000)), "en", "e"),
    (9, "日本語のテキスト 𝒳𝒴 \U0001F600 é\u00a0ü\u2028x", "de", "f"),
    (10, "x" * 70_000, "de", "f"),
    (11, "\n\n".join(["line"] * 5), "de", "f"),
]
