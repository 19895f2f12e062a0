"""The automaton against regular expressions; URL rules against plain code."""

import random
import re

import pytest
from compare import duck, duck_rows, spark_rows

from folioscope.llm import queries, url_filters

FOLDER = "/root/testdata/sf0.01"


def as_regex(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    known = {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}
    return re.compile("".join(known.get(part, re.escape(part)) for part in parts) + r"\Z")


def test_globs_equal_regular_expressions():
    random_ = random.Random(2)
    globs = ["".join(random_.choices(["a", "b", "/", "*", "**", "?", "ab"], k=random_.randrange(7))) for _ in range(90)]
    texts = ["".join(random_.choices("ab/c", k=random_.randrange(12))) for _ in range(400)] + ["", "a" * 300]
    matched = url_filters.compile_globs(globs).run([text.encode() for text in texts])
    for at, glob in enumerate(globs):
        # three stars in a row read as ** and *
        pattern = as_regex(glob)
        assert [bool(pattern.match(text)) for text in texts] == matched[:, at].tolist(), glob


def test_no_globs_and_no_texts():
    assert url_filters.compile_globs([]).run([b"a", b""]).shape == (2, 0)
    assert url_filters.compile_globs(["a*"]).run([]).shape == (0, 1)


def test_query_equals_sql(spark):
    connection = duck(FOLDER)
    names, rows = spark_rows(queries.op8_url_filters(spark, FOLDER))
    assert (names, rows) == duck_rows(connection, queries.ORACLES["op8_url_filters"])


CASES = [
    (None, "", "", None, "block"),
    ("", "", "", None, "block"),
    ("no scheme.com/", "", "", None, "block"),
    ("http://COM/x", "com", "/x", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://a.com?q=/", "a.com", "", None, "allow"),
    ("http://Éxample.COM/en/?x", "Éxample.com", "/en/", "com/", "allow"),
    ("http://example.com/en/x#y", "example.com", "/en/x", "example.com/en/", "block"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://a.net/es/http://b.com/", "a.net", "/es/http://b.com/", "net/es/", "block"),
    ("http://a.org/x.com/", "a.org", "/x.com/", None, "allow"),
    ("http://a.org/admin/x", "a.org", "/admin/x", None, "block"),
    ("x://a.com:80/", "a.com:80", "/", None, "allow"),
    ("http://a.net/" + "fr/" * 5000, "a.net", "/" + "fr/" * 5000, "net/fr/", "block"),
    ("http://\n.com/\n", "\n.com", "/\n", "com/", "allow"),
]


def test_cases_repeats_and_clashing_columns(spark):
    urls = [case[0] for case in CASES] * 2
    rows = [(at, url, "x", "y") for at, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(3)
    found = {r.page_id: tuple(r)[1:] for r in url_filters.judge_urls(pages).collect()}
    assert [found[at] for at in range(len(urls))] == [case[1:] for case in CASES] * 2


@pytest.mark.parametrize("rules", [(), url_filters.RULES])
def test_empty_table(spark, rules):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filters.judge_urls(pages, rules=rules).collect() == []
