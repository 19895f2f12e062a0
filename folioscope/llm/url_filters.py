"""URL rules as globs, matched by one bit-parallel automaton.

Every glob becomes a run of bits in a row of 64-bit words: bit i says that the first i
elements of the glob match what has been read. One step over a byte is

    state = ((state << 1) & reads[byte]) | (state & stays[byte])

with a carry from word to word, so that all globs advance at once (Shift-And with
self-loops for wildcards). Numpy runs the step for a whole batch of URLs at a time.

In a glob ``?`` is one byte other than ``/``, ``*`` any run of such bytes, and ``**`` any
run of bytes. A glob must match the whole canonical URL: host and path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY = np.ones(256, bool)
SEGMENT = ANY.copy()
SEGMENT[ord("/")] = False

#: (verdict, host, path): a rule fits its host and every subdomain below it, for paths
#: that start with its path. The longest fitting rule decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Blocked where no rule fits: no URL at all, advertising hosts, internal and listing pages, binary files.
BLOCKED_GLOBS = (
    "",
    "ads-*/**",
    "**/login/**",
    "**/admin/**",
    "**/cgi-bin/**",
    "**/tag/**",
    "**.jpg",
    "**.png",
    "**.gif",
    "**.zip",
    "**.exe",
)


@dataclass(frozen=True)
class Automaton:
    """``reads`` and ``stays``: 256 rows of words. ``start``: the states before the first
    byte. ``ends``: word and bit of each glob's last state."""

    reads: np.ndarray
    stays: np.ndarray
    start: np.ndarray
    ends: np.ndarray

    def run(self, texts: Sequence[bytes]) -> np.ndarray:
        """One row per text, one boolean per glob: does it match the whole text?"""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")  # those still being read come first
        data = np.frombuffer(b"".join(texts), np.uint8)
        first = (np.cumsum(lengths) - lengths)[order]
        state = np.repeat(self.start[None, :], len(texts), axis=0)
        longest_first = lengths[order]
        for at in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(-longest_first, -at, side="left"))
            byte = data[first[:active] + at]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.reads[byte]) | (now & self.stays[byte])
        matched = np.empty((len(texts), len(self.ends)), bool)
        word, bit = self.ends[:, 0], self.ends[:, 1].astype(np.uint64)
        matched[order] = (state[:, word] >> bit) & np.uint64(1)
        return matched


def parse_glob(glob: str) -> tuple[list[np.ndarray], dict[int, np.ndarray]]:
    """The classes of bytes to read, and the loops: state -> bytes that keep it."""
    reads: list[np.ndarray] = []
    loops: dict[int, np.ndarray] = {}
    data, at = glob.encode(), 0
    while at < len(data):
        if data[at : at + 2] == b"**":
            loops[len(reads)] = ANY
            at += 2
            continue
        if data[at : at + 1] == b"*":
            loops[len(reads)] = loops.get(len(reads), SEGMENT) | SEGMENT
        elif data[at : at + 1] == b"?":
            reads.append(SEGMENT)
        else:
            reads.append(np.arange(256) == data[at])
        at += 1
    return reads, loops


def compile_globs(globs: Sequence[str]) -> Automaton:
    parsed = [parse_glob(glob) for glob in globs]
    words = (sum(len(reads) + 1 for reads, _ in parsed) + 63) // 64
    tables = np.zeros((2, 256, max(words, 1)), np.uint64)
    start = np.zeros(max(words, 1), np.uint64)
    ends, base = [], 0
    for reads, loops in parsed:
        start[base // 64] |= np.uint64(1 << base % 64)
        marks = [(0, state + 1, bytes_) for state, bytes_ in enumerate(reads)]
        marks += [(1, state, bytes_) for state, bytes_ in loops.items()]
        for which, state, bytes_ in marks:
            word, bit = divmod(base + state, 64)
            tables[which, bytes_, word] |= np.uint64(1 << bit)
        ends.append(divmod(base + len(reads), 64))
        base += len(reads) + 1
    return Automaton(tables[0], tables[1], start, np.array(ends, np.int64).reshape(-1, 2))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there up to ``?``, ``#`` or the end. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (
        F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")),
        F.coalesce(path, F.lit("")),
    )


def judge_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked: Sequence[str] = BLOCKED_GLOBS,
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``rule`` is host and path of the longest rule that fits (NULL if none), ``verdict`` is
    that rule's, else ``block`` if one of the ``blocked`` globs matches, else ``allow``.
    A NULL URL, an empty one and one without ``://`` have empty host and path. URLs of any
    length are read to their end. An empty table gives no rows; repeated rows are judged
    each; further columns are ignored. Of two rules of equal length the first one wins.
    """
    ranked = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    globs = []
    for i in ranked:
        _, host, path = rules[i]
        globs += [f"{host}{path}**", f"*.{host}{path}**"]
    automaton = compile_globs([*globs, *blocked])
    names = np.array([rules[i][1] + rules[i][2] for i in ranked] + [None], object)
    verdicts = np.array([rules[i][0] for i in ranked] + [None], object)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            canonical = [(host + path).encode() for host, path in zip(hosts, paths)]
            matched = automaton.run(canonical)
            fits = np.ones((len(canonical), len(ranked) + 1), bool)  # the last: no rule
            pairs = matched[:, : 2 * len(ranked)]
            fits[:, :-1] = pairs[:, 0::2] | pairs[:, 1::2]
            best = fits.argmax(axis=1)
            block = matched[:, 2 * len(ranked) :].any(axis=1)
            verdict = np.where(
                best < len(ranked), verdicts[best], np.where(block, "block", "allow")
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(names[best], pa.string()),
                    pa.array(verdict, pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    host, path = host_and_path(F.col(url))
    rows = pages.select(
        F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path")
    )
    schema = rows.select("*", F.lit("").alias("rule"), F.lit("").alias("verdict")).schema
    for field in schema:
        field.nullable = True
    return rows.mapInArrow(judged, schema)
