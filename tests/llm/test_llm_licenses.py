"""License blocks: every template found as written, changed wording, odd texts."""

import numpy as np
import odd
import pytest

from folioscope.llm import licenses, queries

FOLDER = "/root/testdata/sf0.01"
NOTICES = {name: text for name, text in licenses.TEMPLATES.items() if name.endswith("-notice")}


def test_query_finds_the_notices_that_stand_in_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    truth = {(i, name) for i, text in texts.items() for name, notice in NOTICES.items() if notice in text}
    rows = queries.op4_licenses(spark, FOLDER).collect()
    exact = [r for r in rows if r.verdict == "exact"]
    assert {(r.doc_id, r.license) for r in exact} == truth and truth
    for row in exact:
        assert NOTICES[row.license] in texts[row.doc_id][row.start : row.end]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_each_template_wins_on_its_own_text(name):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = licenses.TEMPLATES[name]
    gains = scanner.reductions(text)
    assert scanner.names[gains.argmax()] == name
    found = scanner.confirmed("Copyright of someone.\n" + text.upper())
    assert [(x["license"], x["differences"]) for x in found] == [(name, 0)]


def test_changed_wording_is_told():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    found = scanner.confirmed(licenses.TEMPLATES["MIT"].replace("free of charge", "at no cost"))
    assert [(x["license"], x["differences"]) for x in found] == [("MIT", 6)]
    assert scanner.confirmed("your driving license is here") == []
    twice = licenses.TEMPLATES["MIT-notice"] + " And again: " + licenses.TEMPLATES["MIT-notice"]
    assert [x["license"] for x in scanner.confirmed(twice)] == ["MIT-notice"] * 2


def test_odd_documents(spark):
    notice = licenses.TEMPLATES["CC-BY-4.0-notice"]
    extra = [(20, notice, "en", "s"), (20, notice, "en", "s"), (None, "x " * 30_000 + notice, "en", "s"), (21, "license", "en", "s")]
    extra.append((22, "# SPDX-License-Identifier: MIT", "en", "s"))
    rows = licenses.scan_licenses(odd.documents(spark, odd.ODD + extra).repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.license or "", r.verdict) for r in rows) == [
        (0, "CC-BY-4.0-notice", "exact"),
        (20, "CC-BY-4.0-notice", "exact"),
        (20, "CC-BY-4.0-notice", "exact"),
        (21, "", "unknown"),
        (22, "MIT", "tag"),
    ]
    assert licenses.scan_licenses(odd.documents(spark, [])).collect() == []


def every_wording(scanner, block):
    """All templates compared with the whole block, nothing ranked or cut."""
    codes = np.array([scanner.code.get(word, -1) for word in licenses.words_of(block)], np.int64)
    for at, name in enumerate(scanner.names):
        rules = scanner.needed[at], scanner.banned[at]
        for differences, _, first, last in licenses._alignments(scanner.wanted[at], codes, *rules):
            yield name, first, last, differences


def check_nothing_is_lost(scanner, block):
    found = scanner.confirmed(block)
    for one, other in zip(found, found[1:]):
        assert one["last"] <= other["first"]
    for name, first, last, differences in every_wording(scanner, block):
        assert any(one["first"] < last and first < one["last"] for one in found), (name, first, last, differences)


def test_ranking_and_cutting_lose_nothing():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    rng = np.random.default_rng(5)
    for _ in range(60):
        names = [str(name) for name in rng.choice(scanner.names, rng.integers(1, 9))]
        parts = []
        for name in names:
            words = licenses.TEMPLATES[name].split()
            for _ in range(rng.integers(0, 4)):
                words[rng.integers(len(words))] = "other"
            parts += [" ".join(words), "lorem " * rng.integers(0, 40)]
        check_nothing_is_lost(scanner, " ".join(parts))
    for names in (sorted(NOTICES), sorted(set(licenses.TEMPLATES) - set(NOTICES)), ["MIT-notice", "Apache-2.0", "GPL-3.0", "CC-BY-4.0-notice"]):
        found = scanner.confirmed("\n".join(licenses.TEMPLATES[name] for name in names))
        assert [(x["license"], x["differences"]) for x in found] == [(name, 0) for name in names]


def test_documents_lose_nothing(spark):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    blocks = {text[low:high] for text in texts for low, high in licenses.candidate_blocks(text, 150)}
    assert blocks
    for block in blocks:
        check_nothing_is_lost(scanner, block)


def test_the_greatest_reduction_decides_between_overlapping_templates():
    templates = {"one": "licensed " + "a b c d e f g h i", "two": "c d e f g h i j k license terms of the book"}
    scanner = licenses.Scanner(templates)
    block = "licensed a b c d e f g h i j k license terms of the book"
    gains = dict(zip(scanner.names, scanner.reductions(block)))
    assert [x["license"] for x in scanner.confirmed(block)] == [max(gains, key=gains.get)]
    scanner.reductions = lambda piece: np.array([gains["two"], gains["one"]])
    assert [x["license"] for x in scanner.confirmed(block)] == [min(gains, key=gains.get)]


FAMILIES = {
    "BSD-2-Clause": licenses.TEMPLATES["BSD-2-Clause"] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS",
    "BSD-3-Clause": licenses.TEMPLATES["BSD-3-Clause"].replace("copyright holder nor", "University nor"),
    "GPL-2.0": licenses.TEMPLATES["GPL-2.0"].replace("This program", "This library").replace("software:", "software;"),
    "GPL-2.0-only": licenses.TEMPLATES["GPL-2.0-only"],
    "GPL-3.0": licenses.TEMPLATES["GPL-3.0"].replace("This program", "Foo"),
    "LGPL-2.1": licenses.TEMPLATES["LGPL-2.1"].replace("This program", "This library"),
    "LGPL-3.0": licenses.TEMPLATES["LGPL-3.0"],
    "AGPL-3.0": licenses.TEMPLATES["AGPL-3.0"],
    "ISC": licenses.TEMPLATES["ISC"] + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES",
    "CC-BY-SA-4.0": licenses.TEMPLATES["CC-BY-SA-4.0"],
}


@pytest.mark.parametrize("name", sorted(FAMILIES))
def test_families_are_told_apart(name):
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = FAMILIES[name]
    assert [x["license"] for x in scanner.confirmed("Copyright (c) 2001 Someone\n\n" + text)] == [name]
    for other in ("license, version 9", "some licensed words"):
        assert [x["license"] for x in scanner.confirmed(f"{other} {text} {other}")] == [name]


def test_no_license_where_decisive_words_differ():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for text in (
        "This work is licensed under the GNU General Public License, version 9.",
        "Licensed under CC BY SA 4.0.",
        "Licensed under the Apache License, Version 1.1.",
        licenses.TEMPLATES["GPL-3.0"].replace("version 3", "version 4"),
    ):
        assert scanner.confirmed(text) == []


@pytest.mark.parametrize(
    "line, names",
    [
        ("// SPDX-License-Identifier: MIT", ["MIT"]),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-2-Clause.", ["(MIT OR Apache-2.0) AND BSD-2-Clause"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", ["GPL-2.0-only WITH Classpath-exception-2.0"]),
        ("SPDX-License-Identifier: ISC\nReleased under the MIT License.", ["ISC", "MIT-notice"]),
        ("SPDX-License-Identifier:", []),
    ],
)
def test_tags(line, names):
    assert [x["license"] for x in licenses.Scanner(licenses.TEMPLATES).confirmed(line)] == names


def test_alignments_equal_brute_force():
    rng = np.random.default_rng(3)
    wanted = rng.integers(0, 6, 20)
    least, most = licenses.bars(20)
    for _ in range(30):
        codes = np.r_[rng.integers(0, 6, 5), wanted, rng.integers(0, 6, 5)]
        codes = np.insert(np.delete(codes, rng.integers(5, 25, rng.integers(0, 4))), rng.integers(5, 20, rng.integers(0, 4)), 9)
        expected = {}
        for first in range(len(codes)):
            row = np.zeros(21, int)  # longest common subsequence with each prefix of wanted
            for last in range(first + 1, len(codes) + 1):
                before, row = row, np.zeros(21, int)
                for i in range(20):
                    row[i + 1] = before[i] + 1 if wanted[i] == codes[last - 1] else max(before[i + 1], row[i])
                differences = 20 + (last - first) - 2 * row[20]
                if row[20] >= least and differences <= most:
                    expected[last] = min(differences, expected.get(last, most))
        found = {last: d for d, _, _, last in licenses._alignments(wanted, codes)}  # ends with added words are left out
        assert found.items() <= expected.items()
        assert min(found.values(), default=None) == min(expected.values(), default=None)


CUSTOMARY = {
    "MIT": (
        "MIT License\n\nCopyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining "
        "a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without "
        "restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to "
        "the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies "
        "or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND\n"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance "
        "with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on "
        "an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
    ),
    "BSD-1-Clause": (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
        "following conditions are met:\n\n* Redistributions of source code must retain the above copyright notice, this\n  "
        "list of conditions and the following disclaimer.\n"
    ),
}


@pytest.mark.parametrize("name", sorted(CUSTOMARY))
@pytest.mark.parametrize("wrap", ["as it is", "words", "comment", "deep"])
def test_customary_paragraphs(spark, name, wrap):
    text = CUSTOMARY[name]
    if wrap == "words":  # three words a line
        parts = text.split()
        text = "\n".join(" ".join(parts[at : at + 3]) for at in range(0, len(parts), 3))
    elif wrap == "comment":
        text = "".join(f" * {line}\n" for line in text.split("\n"))
    elif wrap == "deep":
        text = "".join(f"{' ' * 900}{line}\n\n\n" for line in text.split("\n"))
    before, after = "Lorem ipsum.\n\n" * 300, "\n\n\n" + "dolor sit.\n\n" * 300
    docs = odd.documents(spark, [(1, before + text + after, "en", "s")])
    rows = licenses.scan_licenses(docs).collect()
    assert [(r.license, r.differences, r.verdict) for r in rows if r.license == name] == [(name, 0, "exact")]
    assert all(r.verdict != "unknown" for r in rows)


def test_blocks_cover_every_wording():
    def cut(text, n_words):
        return [text[start:end] for start, end in licenses.candidate_blocks(text, n_words)]

    assert cut("", 3) == cut("no cue", 3) == []
    assert cut("a b c\n\nd license e\n\n\nf g h", 2) == ["c\n\nd license e\n\n\nf"]
    assert cut("license\n\na b\n\nlicence", 2) == ["license\n\na b\n\nlicence"]
    assert cut("license\n\na b c d e\n\nlicence", 2) == ["license\n\na b", "d e\n\nlicence"]
    assert cut("license\n" + "word " * 500 + "\nlicense", 2000) == ["license\n" + "word " * 500 + "\nlicense"]
    assert cut("a. (license) b). c", 1) == ["a. (license) b)."]
    for length in (3_990, 4_001, 9_000):  # one rule for lines of any length
        assert cut("w" * length + " license " + "v" * length, 1) == ["w" * length + " license " + "v" * length]
