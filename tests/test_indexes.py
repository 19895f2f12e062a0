"""Indexes of trigrams and words against scans and plain scoring."""

import itertools
import math
import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from folioscope.library import Library
from folioscope.operators import keywords, results, trigrams
from folioscope.operators.bm25 import WordIndex
from folioscope.operators.trigrams import TrigramIndex, literal_runs
from folioscope.sources import postings
from folioscope.sources.paged import split_pages
from folioscope.sources.postings import trigram_codes

SCHEMA = "source_file string, page_number int, text string"
WORDS = ["tide", "Turbine", "100%", "a_b", "Straße", "ÉTÉ", "wool\nmark", "x", "日本語", "back\\slash", "harbour"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [(f"s{i % 4}", i // 4 + 1, " ".join(rng.choices(WORDS, k=rng.randint(0, 6)))) for i in range(160)]
    return [*made, ("hot", 9000, "tide " * 40), ("hot", 20000, "İstanbul ΑΣ ΑΣΑ"), ("none", 1, ""), ("odd", 1, "ti"), ("odd", 2, None)]


@pytest.fixture(scope="module")
def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def index(spark, pages, tmp_path_factory):
    index = TrigramIndex(spark, f"{tmp_path_factory.mktemp('t')}/trigrams", groups=5)
    index.build(pages)
    return index


PATTERNS = ["tide", "TURB", "0%", "a_b", "straße", "été", "ool\nma", "x", "日本語", "ti%our", "t_de", "", "%", "zzzz", "tidex", "ασα", "istanbul"]


@pytest.mark.parametrize("literal", [False, True])
def test_each_keyword_equals_the_scan(index, pages, literal):
    asked = [*PATTERNS, "back\\slash"] if literal else PATTERNS
    for limit in (1, 3, 500, 2000):
        found = trigrams.each_keyword(index, pages, asked, limit, literal)
        expected = keywords.each_keyword(pages, asked, limit, literal=literal)
        names = sorted(expected.columns)
        assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, expected.select(names).collect()))


@pytest.mark.parametrize("asked", [["tide"], ["TURB", "été", "zzzz"], ["x", "tide"], ["zzzz"], []])
def test_any_keyword_equals_the_scan(index, pages, asked):
    for limit, source in ((2, None), (300, None), (3, "s1"), (2000, None)):
        found = trigrams.any_keyword(index, pages, asked, limit, source)
        expected = keywords.any_keyword(pages, asked, limit, source)
        assert list(map(tuple, found.collect())) == list(map(tuple, expected.collect()))


def test_few_candidates_match_and_the_rest_is_found(spark, tmp_path):
    """Pages with all trigrams of a pattern but not the pattern come first."""
    rows = [("a", p, "abcx bcdx cdey") for p in range(1, 60)] + [("a", p, "abcde") for p in range(60, 80)]
    pages = spark.createDataFrame(rows, SCHEMA)
    index = TrigramIndex(spark, f"{tmp_path}/t")
    index.build(pages.withColumn("text", F.replace("text", F.lit("cdey"), F.lit("cde"))))
    found = trigrams.each_keyword(index, pages, ["abcde"], 5).collect()
    assert [r.page_number for r in sorted(found, key=lambda r: r.rank)] == [60, 61, 62, 63, 64]


def test_literal_runs():
    assert literal_runs("%ab_cd%%e\\%f\\_g%") == ["ab", "cd", "e%f_g"]
    assert literal_runs("%%") == [] and len(trigram_codes("ab")) == 0 and len(trigram_codes("日本語")) == 1


def test_only_lists_and_candidate_pages_are_read(spark, tmp_path):
    library = Library(spark, f"{tmp_path}/library")
    texts = [(f"s{i}", "\f".join(f"page {p} of source {i} word{i}x{p}" for p in range(30))) for i in range(30)]
    library.ingest(split_pages(spark.createDataFrame(texts, "source string, text string"), "source"))
    library.build_text_indexes()
    hits = library.search_keywords(["word7x21", "WORD8x2"], 5)
    assert {(r.keyword, r.source_file, r.page_number) for r in hits.collect()} == {
        ("word7x21", "s7", 22), *(("WORD8x2", "s8", p) for p in (3, 21, 22, 23, 24))
    }
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(source_file,s7\)", plan)
    lists = library.trigrams.table.of_terms([5, 6]).select("n")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[In\(term", lists) and "pages" not in lists.split("ReadSchema")[1]


def test_indexes_follow_ingests_and_removals(spark, tmp_path):
    library = Library(spark, f"{tmp_path}/library")

    def ingest(**texts):
        library.ingest(split_pages(spark.createDataFrame(list(texts.items()), "source string, text string"), "source"))

    ingest(a="copper mine\fcopper wire", b="silver mine")
    library.build_text_indexes()
    ingest(a="golden wire", c="copper pot")
    assert [(r.source_file, r.page_number) for r in library.search_keywords(["copper"]).collect()] == [("c", 1)]
    assert library.words.table.totals() == (3, 6)
    assert [r.source_file for r in library.search_words("wire mine mine").orderBy("rank").collect()] == ["b", "a"]
    library.remove("b")
    assert library.search_any_keyword(["mine"]).count() == 0 and library.words.table.totals() == (2, 4)
    assert library.search_words("mine").count() == 0
    fused = library.search_hybrid("golden wire", ["copper"], 2).orderBy("rank").collect()
    assert {r.source_file for r in fused} == {"a", "c"}


def plain_bm25(rows, question, k1=1.2, b=0.75):
    texts = {(s, p): Counter((t or "").lower().split()) for s, p, t in rows}
    mean = sum(c.total() for c in texts.values()) / len(texts)
    held = Counter(w for c in texts.values() for w in c)
    out = {}
    for key, counts in texts.items():
        score = sum(
            times * math.log(1 + (len(texts) - held[w] + 0.5) / (held[w] + 0.5))
            * counts[w] * (k1 + 1) / (counts[w] + k1 * (1 - b + b * counts.total() / mean))
            for w, times in Counter(question.lower().split()).items() if w in counts
        )
        if score:
            out[key] = round(score, 6)
    return out


def test_word_scores_and_hits(spark, rows, pages, tmp_path, monkeypatch):
    index = WordIndex(spark, f"{tmp_path}/words", groups=3)
    index.build(pages)
    for blocks in (64, 1, 2):  # few first blocks: others are left out or read by their bounds
        monkeypatch.setattr("folioscope.operators.bm25.FIRST_BLOCKS", blocks)
        for question in ("tide", "turbine harbour été", "x x 100%", "nothing here", ""):
            expected = plain_bm25(rows, question)
            assert {(r.source_file, r.page_number): r.score for r in index.scores(question).collect()} == pytest.approx(expected)
            order = sorted(expected, key=lambda key: (-expected[key], key))
            for k in (1, 7, 400):
                found = index.top_k(question, k).orderBy("rank").collect()
                assert [(r.source_file, r.page_number) for r in found] == order[:k]
    inside = [r.source_file for r in index.top_k("tide", 5, source="s2").collect()]
    assert inside and set(inside) == {"s2"}


def test_lists_are_bounded_and_blocks_left_out_cannot_win(spark, tmp_path):
    rows = [("hot", p, "tide " * (1 + p % 3) + f"w{p}") for p in range(0, 40_000, 3)]
    pages = spark.createDataFrame(rows, SCHEMA)
    index = WordIndex(spark, f"{tmp_path}/words")
    index.build(pages)
    lists = index.table.of_terms(["tide"])
    assert lists.agg(F.max(F.size("pages"))).first()[0] <= 8192 and lists.count() >= 5
    best = {(r.source_file, r.part): r.bound for r in index.bounds(index.weights("tide")).collect()}
    for r in index.scores("tide").groupBy("source_file", F.shiftright("page_number", 13).alias("part")).agg(F.max("score").alias("m")).collect():
        assert r.m <= best[r.source_file, r.part] + 1e-6


def test_fusion_of_whole_lists_equals_a_plain_one(spark):
    rng = random.Random(4)
    for size, k in ((30, 5), (700, 3), (700, 10)):
        left = {("a", p): rng.choice([None, 0.0, 0.5, round(rng.random(), 2)]) for p in range(size)}
        right = {("a", p): round(rng.random() * 3, 1) for p in range(size) if p % 3}
        ranks = [
            {key: at for at, key in enumerate(sorted(x, key=lambda key: (-(x[key] if x[key] is not None else -9), key)), 1)}
            for x in (left, right)
        ]
        scores = {key: round(sum(1 / (60 + r[key]) for r in ranks if key in r), 9) for key in left}
        expected = sorted(scores, key=lambda key: (-scores[key], key))[:k]
        frames = [
            spark.createDataFrame([(*key, v) for key, v in x.items()], f"source_file string, page_number int, {name} double")
            for x, name in ((left, "l"), (right, "r"))
        ]
        found = results.fuse_whole(*frames, ["source_file", "page_number"], ("l", "r"), k).orderBy("rank").collect()
        assert [(r.source_file, r.page_number) for r in found] == expected
        assert [r.score for r in found] == pytest.approx([scores[key] for key in expected])


def test_lists_go_to_the_files_as_they_are_made(spark, tmp_path, monkeypatch):
    """Neither shuffled nor sorted after they were made: a run in order of term for each part of the texts."""
    monkeypatch.setattr(postings, "HELD_CHARS", 2000)
    made = [(f"s{page % 3}", page, f"w{page} w{page + 1} every") for page in range(1, 600)]
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    index = WordIndex(spark, f"{tmp_path}/words", groups=4)
    index.build(spark.createDataFrame(made, SCHEMA).coalesce(1))
    assert spark.conf.get(setting, None) == before
    files = [pq.read_table(path, columns=["term"])["term"].drop_null().to_pylist() for path in tmp_path.glob("words/*/*.parquet")]
    runs = [1 + sum(b < a for a, b in itertools.pairwise(terms)) for terms in files if terms]
    assert max(runs) > 1 and sum(runs) < 40
    assert index.table.counts(["every", "w7", "w600", "none"]) == {"every": 599, "w7": 2, "w600": 1}
    assert index.table.totals() == (599, 3 * 599)
    assert sorted(r[0] for r in index.table.rows.select("source_group").distinct().collect()) == [0, 1, 2, 3]


def test_few_candidates_go_to_the_pages(spark, tmp_path):
    """Texts stay where they are while candidates are few."""
    rng = random.Random(4)
    rows = [("a", p, "abcx bcdx cdey " + "".join(rng.choices("fghijklmn", k=2000))) for p in range(1, 80)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    index = TrigramIndex(spark, f"{tmp_path}/t")
    index.build(pages.withColumn("text", F.replace("text", F.lit("cdey"), F.lit("cde"))))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        rest = trigrams._search(index, pages, {0: "abcde"}, 5, False)[-1]
        plan = rest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rest.count() == 0
