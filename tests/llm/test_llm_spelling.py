"""Variants against comparison of all words with all, on whole tables and planted words."""

import random
import re
import zlib
from collections import Counter

import odd
import pytest

from folioscope.llm import queries, spelling

NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def counted(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def near_of(words):
    """All near words of each: words that share one of their spellings without one
    character are compared, and none else can be near."""
    shorter = {}
    for word in words:
        for left in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            shorter.setdefault(left, []).append(word)
    near = {word: set() for word in words}
    for group in shorter.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    return near


def expected(counts, near):
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return rows


def told(frame):
    rows = [tuple(row[name] for name in NAMES) for row in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    counts = counted(tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    rows = told(queries.op11_spelling(spark, folder))
    assert rows == expected(counts, near_of(counts))
    assert any(row[1] for row in rows)


def test_all_pairs_of_few_letters(spark):
    """Words of two letters have bigrams in common everywhere, overlapping and repeated."""
    rng = random.Random(5)
    counts = {}
    for _ in range(700):
        word = "".join(rng.choices("abé", (5, 4, 1), k=rng.randint(4, 9)))
        counts[word] = 5 ** rng.randint(0, 6)
    near = {a: {b for b in counts if one_edit(a, b)} for a in counts}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = told(spelling.group_variants(words))
    assert rows == expected(counts, near)
    assert sum(row[2] not in (row[0], row[1]) for row in rows) > 20  # chains of forms


def test_edits_at_every_place(spark):
    base = "pivotalgramñ"
    edited = {base[:i] + c + base[i + k :] for i in range(len(base) + 1) for c in ("", "x", "a") for k in (0, 1)}
    edited = {word for word in edited if one_edit(word, base)}
    counts = {base: 1000, **dict.fromkeys(edited, 7)}
    rows = {row[0]: row for row in told(spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert len(edited) > 40 and all(rows[word][1:3] == (base, base) for word in edited)
    assert rows[base][4] == len(edited)


def test_pivots_do_not_overlap_and_are_the_rarest():
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choices("abcd", k=rng.randint(4, 12)))
        order = {a + b: place for place, (a, b) in enumerate(rng.sample([(a, b) for a in "abcd" for b in "abcd"], 16))}
        prefix, last = spelling.prefix_of(word, order)
        assert len(prefix) >= min(3, len(word) - 1) and max(place for _, place in prefix) == last
        pairs = [(max(p, q), min(p, q)) for a, p in prefix for b, q in prefix if b - a >= 2]
        places = dict(prefix)
        first, second = spelling.pivots_of(prefix)
        assert second - first >= 2
        assert (max(places[first], places[second]), min(places[first], places[second])) == min(pairs)


def test_odd_documents(spark):
    docs = odd.documents(spark, [*odd.ODD, (12, "ÀÉÎÕÜ× " * 6 + "ﬁn ſtraße Ωmega_under9score", "fr", "g")])
    counts = counted([(r.doc_id, r.text) for r in docs.collect()])
    rows = told(spelling.spelling_variants(docs, damaged=199))
    assert rows == expected(counts, near_of(counts)) and rows
    assert told(spelling.spelling_variants(docs.limit(0))) == set()


def test_repeated_and_missing_words(spark):
    words = spark.createDataFrame([("letter", 3), ("letter", 4), (None, 9), ("lettér", 1), ("abc", 50)], "word string, n long")
    assert told(spelling.group_variants(words)) == {
        ("letter", None, "letter", 7, 1, None), ("lettér", "letter", "letter", 1, 1, 7), ("abc", None, "abc", 50, 0, None)
    }
