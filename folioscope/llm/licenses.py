"""License wording, found by conditional compression.

A text's candidate blocks are the words that licenses use, with as many words before and
after as the longest template has. A block is compressed alone, and with each template as a
raw dictionary: the template that says the same things saves most bytes. In order of that
reduction the templates are compared with the block word by word; the first whose wording is
there, up to a stated share of differences and with its decisive words, wins. Its words are
cut out and what is left on either side is ranked anew, until no template is confirmed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import strings, whole

# License notices, short statements, and of longer texts the conditions.
_BSD_1 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer."
)
_BSD_2 = _BSD_1 + (
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = _BSD_2 + (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_BSD_0 = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
# Headers of one family differ in the license's name and version.
_OR_LATER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as "
    "published by the Free Software Foundation, either version {} of the License, or (at your option) any later "
    "version."
)
_ONLY = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} "
    "version {1} as published by the Free Software Foundation."
)
_GNU = {
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
_COMMONS = {
    "CC-BY-4.0": ("BY", "Attribution"),
    "CC-BY-SA-4.0": ("BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC-4.0": ("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-ND-4.0": ("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-SA-4.0": ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-NC-ND-4.0": ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
}
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-1-Clause": _BSD_1,
    "BSD-2-Clause": _BSD_2,
    "BSD-3-Clause": _BSD_3,
    "0BSD": _BSD_0 + ".",
    "ISC": _BSD_0 + ", provided that the above copyright notice and this permission notice appear in all copies.",
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
        "display, distribute, execute, and transmit the Software"
    ),
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
        "and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software"
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
        "rights to this software to the public domain worldwide."
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at"
    ),
    **{name: _OR_LATER.format(*words) for name, words in _GNU.items()},
    **{f"{name}-only": _ONLY.format(*words) for name, words in _GNU.items()},
    **{
        f"{name}-notice": f"This work is licensed under the GNU {kind}, version {version}."
        for name, (kind, version) in _GNU.items()
    },
    **{f"{name}-notice": f"Licensed under CC {code} 4.0." for name, (code, _) in _COMMONS.items()},
    **{
        name: f"This work is licensed under a Creative Commons {kind} 4.0 International License."
        for name, (_, kind) in _COMMONS.items()
    },
}

# Words that tell licenses of a family apart. Of a template's own words these may
# not be missing; those of the second list may not stand among its words if it lacks them.
NEEDED = frozenset(
    "1.0 2 2.0 2.1 3 4.0 affero apache attribution by cc eclipse endorse fee gnu granted lesser mit mozilla "
    "neither promote provided redistribution unencumbered".split()
) | {word.lower() for pair in _COMMONS.values() for word in pair}
FORBIDDEN = frozenset("affero endorse lesser nc nd neither noncommercial sa sharealike".split()) | {
    word.lower() for pair in list(_COMMONS.values())[1:] for word in pair
}

#: Words of licenses; :func:`candidate_blocks` adds what is around them.
CUE = re.compile(
    r"licen[sc]e|permission is |hereby granted|redistribution and use|redistribute it|copyright|as is\"|mozilla public"
    r"|unencumbered|SPDX",
    re.IGNORECASE,
)
#: A tag that names its license, or an expression of several.
TAG = re.compile(
    r"SPDX-License-Identifier:[ \t]*(\(*[A-Za-z0-9+-]+(?:\.[A-Za-z0-9+-]+)*\)*"
    r"(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*[A-Za-z0-9+-]+(?:\.[A-Za-z0-9+-]+)*\)*)*)"
)
#: Least share of a template's words that a block must have in order.
LEAST_WORDING = 0.9
LEVEL = 6

WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")

MARKS = re.compile(r"[^\w\s]*")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def candidate_blocks(text: str, n_words: int) -> Iterator[tuple[int, int]]:
    """Spans, in code points, of cues with ``n_words`` words before and after each, whatever
    lines they stand in; those that meet are one. A wording of up to so many words that has
    a cue lies within one of them."""
    low = high = -1
    for cue in CUE.finditer(text):
        start, end = cue.span()
        if start > high:
            before = _words_before(text, start, n_words)
            if high < 0:
                low = before
            elif before > high:
                yield low, high
                low = before
        high = max(high, end)
        for word in islice(WORD.finditer(text, end), n_words):
            high = max(high, word.end())
        high = MARKS.match(text, high).end()
    if high >= 0:
        yield low, high


def _words_before(text: str, at: int, n_words: int) -> int:
    """Where the last ``n_words`` words before ``at`` begin."""
    size = 8 * n_words
    while True:
        low = max(0, at - size)
        found = [word.start() for word in WORD.finditer(text, low, at)]
        # The first word may begin before ``low``.
        if len(found) > n_words or not low:
            return found[-n_words:][0] if found else at
        size *= 2


class Scanner:
    """Templates as raw dictionaries, ready to compress with."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        words = [words_of(text) for text in templates.values()]
        known = {word for some in words for word in some} | FORBIDDEN
        self.code = {word: code for code, word in enumerate(sorted(known))}
        self.wanted = [np.array([self.code[word] for word in some], np.int64) for some in words]
        # Which words a template has; the last column is for words of no template.
        self.member = np.zeros((len(words), len(self.code) + 1), bool)
        for row, some in zip(self.member, self.wanted):
            row[some] = True
        self.needed = [np.array([word in NEEDED for word in some], bool) for some in words]
        self.banned = np.zeros_like(self.member)
        self.banned[:, [self.code[word] for word in FORBIDDEN]] = True
        self.banned &= ~self.member
        # Which shorter templates stand within a longer one, decisive words aside.
        self.by_length = sorted(range(len(words)), key=lambda at: len(words[at]))
        self.within = [
            [
                other
                for other in self.by_length
                if len(words[other]) < len(words[at])
                and any(True for _ in _alignments(self.wanted[other], self.wanted[at]))
            ]
            for at in range(len(words))
        ]
        # zstandard takes raw dictionaries of 8 bytes or more.
        padded = [text.lower().encode().ljust(8) for text in templates.values()]
        kind = zstandard.DICT_TYPE_RAWCONTENT
        self.with_template = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind), write_content_size=False
            )
            for data in padded
        ]
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def reductions(self, block: str) -> np.ndarray:
        """For each template the share of the block's compressed size that it saves."""
        data = block.lower().encode()
        alone = len(self.alone.compress(data))
        sizes = np.array([len(each.compress(data)) for each in self.with_template], float)
        return 1 - sizes / alone

    def ranking(self, block: str) -> Iterator[tuple[int, float]]:
        """Templates and their reductions, the greatest first; a template that has a shorter
        one within it comes before that."""
        gains = self.reductions(block)
        lifted = gains.copy()
        for at in self.by_length:
            lifted[at] = max([lifted[at], *lifted[self.within[at]]])
        for at in sorted(range(len(gains)), key=lambda at: (-lifted[at], -len(self.wanted[at]), self.names[at])):
            yield at, float(gains[at])

    def confirmed(self, block: str) -> list[dict]:
        """The licenses that the block names, in order of place.

        Tags are taken first. Then the best template whose wording is confirmed wins all its
        places, and the pieces before, between and after are ranked again. A short notice
        beside a long text may save next to nothing: so the ranking is followed to its end
        before a piece counts as having no license, and nothing that would be confirmed is
        lost but what overlaps a winner.
        """
        words = [word.span() for word in WORD.finditer(block)]
        starts = np.array([start for start, _ in words], np.int64)
        codes = np.array([self.code.get(block[low:high].lower(), -1) for low, high in words], np.int64)
        found = []
        for tag in TAG.finditer(block):
            first, last = (int(x) for x in np.searchsorted(starts, tag.span()))
            one = {"license": " ".join(tag[1].split()), "reduction": None, "wording": 1.0, "differences": 0}
            found.append({**one, "n_words": last - first, "first": first, "last": last})
        pieces = _between(found, 0, len(words))
        while pieces:
            low, high = pieces.pop()
            # Compressing pays only where some template has enough of its words in one place.
            if not any(True for at in self.by_length for _ in self._regions(codes[low:high], at)):
                continue
            for at, gain in self.ranking(block[words[low][0] : words[high - 1][1]]):
                places = list(self._wording(codes[low:high], at, gain))
                if places:
                    for one in places:
                        one["first"] += low
                        one["last"] += low
                    found += places
                    pieces += _between(places, low, high)
                    break
        return sorted(found, key=lambda x: x["first"])

    def _wording(self, codes: np.ndarray, at: int, gain: float) -> Iterator[dict]:
        """Where the template's words stand in the block, with their differences."""
        wanted = self.wanted[at]
        for low, high in self._regions(codes, at):
            taken: list[tuple[int, int]] = []
            for differences, lost, first, last in sorted(
                _alignments(wanted, codes[low:high], self.needed[at], self.banned[at])
            ):
                if any(first < other_last and other_first < last for other_first, other_last in taken):
                    continue
                taken.append((first, last))
                yield {
                    "license": self.names[at],
                    "reduction": gain,
                    "wording": (len(wanted) - lost) / len(wanted),
                    "differences": differences,
                    "n_words": len(wanted),
                    "first": low + first,
                    "last": low + last,
                }

    def _regions(self, codes: np.ndarray, at: int) -> Iterator[tuple[int, int]]:
        """Where enough words are the template's, in any order: no wording lies elsewhere."""
        least, most = bars(len(self.wanted[at]))
        span = len(self.wanted[at]) + most
        total = np.r_[0, np.cumsum(self.member[at][codes])]
        ends = np.minimum(np.arange(len(codes)) + span, len(codes))
        dense = np.flatnonzero(total[ends] - total[:-1] >= least)
        if len(dense):
            for run in np.split(dense, np.flatnonzero(np.diff(dense) > span) + 1):
                yield int(run[0]), int(ends[run[-1]])


def _between(places: list[dict], low: int, high: int) -> list[tuple[int, int]]:
    """What of ``low`` to ``high`` lies between places."""
    ends = [low, *(end for one in sorted(places, key=lambda x: x["first"]) for end in (one["first"], one["last"])), high]
    return [(start, end) for start, end in zip(ends[::2], ends[1::2]) if start < end]


def bars(n_words: int) -> tuple[int, int]:
    """Of a template of so many words the least in order, and the most differences."""
    return math.ceil(LEAST_WORDING * n_words), int((1 - LEAST_WORDING) * 2 * n_words)


def _alignments(
    wanted: np.ndarray, codes: np.ndarray, needed: np.ndarray | None = None, banned: np.ndarray | None = None
) -> Iterator[tuple[int, int, int, int]]:
    """Differences, words missing, first and last (exclusive) for each end of a stretch of
    ``codes`` that has ``wanted`` within the bars, with the fewest differences. ``needed``
    words of ``wanted`` are never missing, ``banned`` codes never among the added.

    Exact: ``best[k, j]`` has, for the template's words so far, the fewest added words (high
    half) and the start (low half) of a stretch that ends at ``j`` and lacks ``k`` at most.
    """
    least, most = bars(len(wanted))
    lost = np.arange(len(wanted) - least + 1)
    place = np.arange(len(codes) + 1, dtype=np.int64)
    never, added = np.int64(1 << 60), place << 32
    if banned is not None:  # a banned word costs more than all differences that are allowed
        added = added + (np.r_[0, np.cumsum(banned[codes])] * (most + 1) << 32)
    best = np.tile(place, (len(lost), 1))
    for at, word in enumerate(wanted):
        if at:  # words may be added between those of the template
            best = np.minimum.accumulate(best - added, axis=1) + added
        new = np.full_like(best, never)
        new[:, 1:] = np.where(codes == word, best[:, :-1], never)
        if needed is None or not needed[at]:
            new[1:] = np.minimum(new[1:], best[:-1])
        best = new
    differences = lost[:, None] + (best >> 32)
    fewest = differences.argmin(axis=0)
    for end in np.flatnonzero(differences.min(axis=0) <= most):
        k = int(fewest[end])
        yield int(differences[k, end]), k, int(best[k, end] & 0xFFFFFFFF), int(end)


RESULT = (
    "start int, end int, license string, reduction double, wording double, differences int, verdict string"
)


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """One row per candidate block and license in it: ``doc_id, start, end, license,
    reduction, wording, differences, verdict``.

    ``start`` and ``end`` (exclusive) are the block in code points: cues and as many words on
    either side as the longest template has, over lines of any length. ``reduction`` is the
    share of compressed bytes that the template saves of the piece it was found in, ``wording``
    the share of its words found in order, ``differences`` the words missing or added (so the
    numbers of a numbered list of conditions are differences). ``verdict`` is ``exact``
    without differences and ``modified`` with some, ``tag`` for a license identifier, whose
    expression is returned as it stands and whose ``reduction`` is NULL; a block without a
    confirmed license has one row with NULLs and the verdict ``unknown``.

    NULL and empty texts and texts without cues give no rows. Texts are scanned whole. Repeated rows are reported each; NULL ids stay; an empty table gives no rows;
    further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        reach = max((len(wanted) + bars(len(wanted))[1] for wanted in scanner.wanted), default=0)
        known: dict[str, list[dict]] = {}
        for batch in batches:
            rows, columns = [], []
            for at, value in enumerate(strings(batch, "text")):
                for start, end in candidate_blocks(value, reach):
                    block = value[start:end]
                    if block not in known:
                        if len(known) > 10_000:  # a cache of repeated notices only
                            known.clear()
                        known[block] = scanner.confirmed(block)
                    for one in known[block] or [{}]:
                        verdict = "unknown" if not one else "modified" if one["differences"] else "exact"
                        if one and one["reduction"] is None:
                            verdict = "tag"
                        rows.append(at)
                        columns.append(
                            (
                                start,
                                end,
                                *(one.get(name) for name in ("license", "reduction", "wording", "differences")),
                                verdict,
                            )
                        )
            if rows:
                ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
                kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string()]
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*columns), kinds)]
                yield pa.RecordBatch.from_arrays([ids, *arrays], names=schema.names)

    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(RESULT).fields])
    return rows.mapInArrow(run, schema)
