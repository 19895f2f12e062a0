"""Spelling variants: words one edit apart, found by pivotal bigrams, grouped under a form.

Bigrams are ordered from rare to common. The prefix of a word is its three rarest bigrams
and all others as rare as the last of these; its pivots are two bigrams of the prefix that
do not overlap, of all such pairs the rarest, by dynamic programming. One edit spoils at most one
pivot. So if two words are one edit apart, a pivot of the word whose prefix ends earlier
in the order stands unspoilt in the other word, and there in its prefix. It stands at the
same place, or shifted by the difference of the lengths; and since the edit lies on one
side of it, and there in one half, all of the other side and the other half are equal as
well. Length, place and the equal parts make the key by which pivots meet prefixes; every
pair that meets is verified.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from folioscope.llm.common import settled, strings

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form is at least so many times as frequent as its variant.
FORM_TIMES = 5
GRAM = 2
#: q·τ + 1 bigrams for an edit distance of one.
PREFIX = 3
#: One of so many words of a document loses a character, for the query's contract.
DAMAGED = 199
#: Distinct words that a task counts before it passes its counts on.
HELD_WORDS = 200_000

#: Each byte of Latin-1 to itself if a word may hold it, A-Z to a-z, all others to a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """The runs ``[A-Za-z\\u00C0-\\u00FF]+`` in Latin-1, A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(WORD_BYTES).split()


def checksum(run: bytes, start: int) -> int:
    """The CRC-32 of a run in UTF-8, carried on from ``start``."""
    return zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)


def add_words(counts: Counter, doc_id: object, text: str, least_length: int, damaged: int | None) -> None:
    """Count the words of one document, those with the checksum damaged."""
    # Runs that are too short stay too short when they lose a character.
    runs = [run for run in words_of(text) if len(run) >= least_length]
    counts.update(runs)
    if damaged is None:
        return
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in set(runs):
        sum_ = checksum(run, start)
        if sum_ % damaged == 0:
            times, at = runs.count(run), sum_ % len(run)
            counts[run] -= times
            left = run[:at] + run[at + 1 :]
            if len(left) >= least_length:
                counts[left] += times


def count_words(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    damaged: int | None = None,
) -> DataFrame:
    """``word, n`` of the words in all texts that are long and frequent enough.

    Tasks count their words first and pass on one row per word, so a word that stands in
    all documents costs one row per task. ``damaged`` takes a character from words whose
    checksum with the id it divides. NULL texts have no words, a NULL id reads as ''.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def told() -> pa.RecordBatch:
            known = [(word.decode("latin-1"), n) for word, n in counts.items() if n]
            counts.clear()
            columns = [*zip(*known)] or [(), ()]
            arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in batches:
            for doc_id, value in zip(batch.column("id").to_pylist(), strings(batch, "text")):
                add_words(counts, doc_id, value, least_length, damaged)
                if len(counts) >= HELD_WORDS:
                    yield told()
        yield told()

    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, int]:
    """The place of each bigram, from rare to common over the words.

    The alphabet has 90 letters, so there are 8,100 bigrams at most, however many words.
    """
    grams = words.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(GRAM)))).alias("gram")
    )
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).toArrow()
    order = sorted(zip(counts.column("n").to_pylist(), counts.column("gram").to_pylist()))
    return {gram: place for place, (_, gram) in enumerate(order)}


def prefix_of(word: str, order: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """The bigrams of the prefix as ``(position, place in the order)`` by position, and
    the place of the last of them in the order."""
    grams = [order[word[at : at + GRAM]] for at in range(len(word) - GRAM + 1)]
    last = sorted(grams)[min(PREFIX, len(grams)) - 1]
    return [(at, place) for at, place in enumerate(grams) if place <= last], last


def pivots_of(prefix: list[tuple[int, int]]) -> list[int]:
    """Positions of two bigrams of the prefix that do not overlap: of all pairs, one whose
    more common bigram is rarest, then one whose other is.

    Going through the prefix by position, ``one`` is the best single bigram among those
    that end before the present one, and ``two`` the best pair so far.
    """
    two: tuple[int, int, int, int] | None = None
    one: tuple[int, int] | None = None
    ended = 0
    for at, place in prefix:
        while ended < len(prefix) and prefix[ended][0] + GRAM <= at:
            single = (prefix[ended][1], prefix[ended][0])
            one = single if one is None else min(one, single)
            ended += 1
        if one is not None:
            pair = (max(one[0], place), min(one[0], place), one[1], at)
            two = pair if two is None else min(two, pair)
    return [two[2], two[3]] if two else [at for at, _ in prefix]


def prefix_keys(word: str, prefix: list[tuple[int, int]]) -> Iterator[str]:
    """The keys under which the bigrams of the prefix are found."""
    size = len(word)
    for at, _ in prefix:
        end = at + GRAM
        half = end + (size - end) // 2
        yield f"{size} {end}<{word[:half]}"
        yield f"{size} {end}>{word[:end]}|{word[half:]}"
        half = at // 2
        yield f"{size} {size - at}<{word[:half]}|{word[at:]}"
        yield f"{size} {size - at}>{word[half:]}"


def pivot_keys(word: str, pivots: list[int]) -> Iterator[str]:
    """The keys under which the pivots stand in words one edit away, of each length these
    may have: the edit lies on one side of the pivot, in one half of that side."""
    own = len(word)
    for at in pivots:
        end = at + GRAM
        for size in (own - 1, own, own + 1):
            if size >= end:  # the edit comes after the pivot
                front = (size - end) // 2
                yield f"{size} {end}<{word[: end + front]}"
                yield f"{size} {end}>{word[:end]}|{word[own - (size - end - front) :]}"
            place = at + size - own
            if place >= 0:  # the edit comes before it
                front = place // 2
                yield f"{size} {size - place}<{word[:front]}|{word[at:]}"
                yield f"{size} {size - place}>{word[at - (place - front) :]}"


def _keyed(words: DataFrame, order: dict[str, int], pivots: bool) -> DataFrame:
    """``key, word, n, last``: a row for each key of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, lasts = [], [], []
            for row, word in enumerate(strings(batch, "word")):
                prefix, last = prefix_of(word, order)
                made = set(pivot_keys(word, pivots_of(prefix)) if pivots else prefix_keys(word, prefix))
                keys.extend(xxh64_intdigest(key) - (1 << 63) for key in made)
                rows.extend([row] * len(made))
                lasts.extend([last] * len(made))
            own = batch.take(pa.array(rows, pa.int32()))
            arrays = [pa.array(keys, pa.int64()), own.column("word"), own.column("n"), pa.array(lasts, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "word", "n", "last"])

    return words.select("word", "n").mapInArrow(run, "key long, word string, n long, last int")


def one_edit(first: Column, second: Column) -> Column:
    return F.levenshtein(first, second, 1) == 1


def near_pairs(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """``a, b, a_n, b_n``: each pair of words (``word, n``, words distinct and of four
    characters or more) that are one edit apart, once, ``a`` before ``b``.

    Keys are hashed; what meets by chance fails like all that meets and is not near. Pairs
    are verified before they are made distinct: a pair may meet under several keys.
    """
    prefixes = _keyed(words, order, False).toDF("key", "p", "p_n", "p_last")
    pivots = _keyed(words, order, True).toDF("key", "q", "q_n", "q_last")
    met = pivots.join(prefixes, "key").filter(
        (F.col("q_last") <= F.col("p_last")) & (F.col("p") != F.col("q")) & one_edit(F.col("p"), F.col("q"))
    )
    first = F.col("p") < F.col("q")
    return met.select(
        F.when(first, F.col("p")).otherwise(F.col("q")).alias("a"),
        F.when(first, F.col("q")).otherwise(F.col("p")).alias("b"),
        F.when(first, F.col("p_n")).otherwise(F.col("q_n")).alias("a_n"),
        F.when(first, F.col("q_n")).otherwise(F.col("p_n")).alias("b_n"),
    ).distinct()


def forms_of(words: DataFrame, pairs: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n``: the most frequent near word, if it is ``times``
    as frequent; of equals the first in code-point order."""
    sides = pairs.select("a", F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = sides.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.select("word", "n").join(best, "word", "left")
    enough = -F.col("best.less") >= times * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots_of(formed: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """``word, root`` of the words that have a form: the last word along the forms.

    Each step multiplies the frequency by ``times``, so the longest chain follows from the
    greatest frequency; pointers are doubled until they span it.
    """
    links = settled(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), "form_n"))
    most, reach, span = links.agg(F.max("form_n")).first()[0] or 0, 1, 1
    while times ** (reach + 1) <= most:
        reach += 1
    while span < reach:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = settled(
            links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )
        span *= 2
    return links.select("word", "root")


def group_variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """One row per word of ``words`` (``word, n``): ``word, form, root, n, n_near, form_n``.

    ``times`` is 2 or more, so that chains of forms end. Words of fewer than four
    characters are not compared. NULL words are dropped, of repeated words the counts are
    added up; an empty table gives no rows; further columns are ignored.
    """
    if times < 2:
        raise ValueError("a form must be more frequent than its variant")
    distinct = words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    known = settled(distinct)
    compared = known.filter(F.length("word") >= GRAM * 2)
    formed = settled(forms_of(known, settled(near_pairs(compared, gram_order(compared))), times))
    rooted = formed.join(roots_of(formed, times), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", damaged: int | None = None
) -> DataFrame:
    """The words of all texts, grouped: see :func:`count_words` and :func:`group_variants`."""
    return group_variants(count_words(docs, id_column, text, damaged=damaged))
