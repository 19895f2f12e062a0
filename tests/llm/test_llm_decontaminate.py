"""Leaks against plain search for the items, word by word; changed passages; odd tables."""

import numpy as np
import odd
import pytest

from folioscope.llm import decontaminate, queries

FOLDER = "/root/testdata/sf0.01"
ITEMS = "item_id long, text string, doc_id long, word long"


def plain_lcs(first, second):
    best = [0] * (len(second) + 1)
    for a in first:
        before = best[:]
        for at, b in enumerate(second):
            best[at + 1] = before[at] + 1 if a == b and a else max(best[at], before[at + 1])
    return best[-1]


def test_query_finds_every_item_that_stands_in_a_text(spark):
    def words(text):
        return b" ".join(decontaminate.words_of(text))

    docs = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    truth = {(d, i) for d, text in docs for i, item in items if item in text}
    rows = queries.op6_decontamination(spark, FOLDER).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found == truth and truth
    assert len(rows) == len(found)
    assert all(r.lcs_share >= 0.6 and r.cosine > 0 for r in rows)


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        first, second = rng.integers(0, 6, rng.integers(0, 12)), rng.integers(0, 6, rng.integers(0, 30))
        assert decontaminate.lcs(first, second) == plain_lcs(first.tolist(), second.tolist())


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(9)
    common = ["the", "of", "and", "to", "in", "is"]
    rare = ["".join(rng.choice(list("bcdfglmnprst"), 3)) + "".join(rng.choice(list("aeiou"), 3)) for _ in range(3000)]

    def text(count):
        return [str(rng.choice(common if rng.uniform() < 0.5 else rare)) for _ in range(count)]

    return text


def planted(prose):
    """Items, and texts: clean, exact copies, and copies with every sixth word replaced."""
    items = [prose(int(n)) for n in (12, 20, 33, 48, 60, 90)]
    rows, truth = [], set()
    for k in range(60):
        rows.append((k, " ".join(prose(300)), "en", "s"))
    for at, item in enumerate(items):
        changed = [word if n % 6 else "other" for n, word in enumerate(item)]
        for shift, body in enumerate((item, changed, [word.upper() + "," for word in item])):
            doc = 100 + 10 * at + shift
            text = prose(37 * shift + 5 * at) + body + prose(150 - 40 * shift)
            rows.append((doc, " ".join(text), "en", "s"))
            truth.add((doc, at))
    return items, rows, truth


def test_copies_and_near_copies(spark, prose):
    items, rows, truth = planted(prose)
    docs = odd.documents(spark, rows + odd.ODD).repartition(4)
    bench = spark.createDataFrame([(at, " ".join(item), 0, 0) for at, item in enumerate(items)], ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert found == truth
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    bad = {doc for doc, _ in truth}
    left = sorted(r.doc_id or 0 for r in clean.collect())
    assert left == sorted(i or 0 for i, *_ in rows + odd.ODD if i not in bad)


def test_items_in_blocks_give_the_same(spark, prose, monkeypatch):
    items, rows, truth = planted(prose)
    monkeypatch.setattr(decontaminate.item_blocks, "__defaults__", (2,))
    bench = spark.createDataFrame([(at, " ".join(item), 0, 0) for at, item in enumerate(items)], ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(odd.documents(spark, rows), bench).collect()}
    assert truth <= found


def test_odd_and_empty_tables(spark):
    docs = odd.documents(spark, odd.ODD)
    none = spark.createDataFrame([], ITEMS)
    blank = spark.createDataFrame([(1, None, 0, 0), (2, "", 0, 0), (2, " .,;", 0, 0)], ITEMS)
    for bench in (none, blank):
        assert decontaminate.find_leaks(docs, bench).collect() == []
        assert decontaminate.without_leaks(docs, bench).count() == len(odd.ODD)
    item = spark.createDataFrame([(1, "same text here with some words", 0, 0)] * 2, ITEMS)
    assert decontaminate.find_leaks(odd.documents(spark, []), item).collect() == []
    rows = decontaminate.find_leaks(docs, item).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 1)] * 2 + [(6, 1)] * 4 + [(7, 1)] * 2


def test_cosines_lose_nothing_that_the_words_confirm(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rng = np.random.default_rng(9)
    rows = []
    for at, (_, text) in enumerate(benchmark):
        words = (text or "").split()
        changed = [word for word in words if rng.random() > 0.12]
        for place in rng.choice(max(len(changed), 1), len(changed) // 10, replace=False):
            changed[place] = "changed"
        rows.append((10_000 + at, "some words before " * 9 + " ".join(changed) + " and after" * 20, "en", "s"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source")
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    space = decontaminate.Space.of([i for i, _ in benchmark], [t or "" for _, t in benchmark])
    decontaminate.fit_space(decontaminate._coded(docs, space, "doc_id", "text"), space)
    codes = [space.codes(text) for _, text, *_ in rows]
    present = np.zeros(len(space.vocabulary) + 1, bool)
    confirmed = {
        (text, item)
        for text, code in enumerate(codes)
        for item in range(len(benchmark))
        if len(space.items[item])
        and any(space._confirm(code, at, item, present) for at in range(0, len(code), decontaminate.BLOCK))
    }
    found = [*space.leaks(codes)]
    pairs = {(text, item) for text, item, _ in found}
    assert len(confirmed) > len(benchmark) // 3 and pairs <= confirmed
    assert len(pairs & confirmed) >= 0.99 * len(confirmed)
    monkeypatch.setattr(decontaminate, "QUERIES_AT_A_TIME", 7)
    tiled = [*space.leaks(codes)]
    assert [(t, i, x["word"], x["lcs_share"]) for t, i, x in tiled] == [(t, i, x["word"], x["lcs_share"]) for t, i, x in found]
