"""SimHash near duplicates: a binary trie of fingerprints joined with itself.

Fingerprints that differ in two bits or fewer agree in two at least of four 16-bit
blocks. For each pair of blocks every distinct fingerprint goes, with these blocks moved
to the front, to the task that owns their 32 bits: a subtrie. There pairs of trie nodes
are followed down together, bit by bit; a pair adds up its differing bits and is dropped
once they exceed the budget. A task reports links to one member of each local component,
not all pairs; components over all tasks follow by :mod:`components`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from folioscope.llm.common import settled, strings, whole, with_columns
from folioscope.llm.components import roots

BUDGET = 2
SHINGLE = 3
SEED = 42
BLOCK_BITS = 16
#: Bytes of text that are cut into words at a time.
PIECE = 1 << 20
#: Node pairs that are followed at a time.
FRONTIER = 1 << 20

#: Orders of the four blocks, one for each pair of blocks that comes first.
LEADS = [(*pair, *sorted({0, 1, 2, 3} - {*pair})) for pair in combinations(range(4), 2)]


def shingle_hashes(text: str, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the shingles of so many words, some at a time."""
    data = text.encode().lower()  # bytes: lowers A-Z only, splits at ASCII white space only
    gap = re.compile(rb"[ \t-\r]")
    words: list[bytes] = []
    at, seen = 0, 0
    while at < len(data):
        cut = gap.search(data, min(at + PIECE, len(data)))
        end = cut.start() if cut else len(data)
        words += data[at:end].split()
        at = end
        count = len(words) - shingle + 1
        if count > 0:
            shingles = map(b" ".join, zip(*(words[shift:] for shift in range(shingle))))
            yield np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
            seen += count
            words = words[-(shingle - 1) :]
    if not seen and words:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def fingerprint(text: str) -> int:
    """64 bits, each set if it is set in over half the hashes of the shingles."""
    count, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text):
        for start in range(0, len(hashes), 1 << 14):
            part = hashes[start : start + (1 << 14)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        count += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > count, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) and the carried columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value) for value in strings(batch, "__text")]
            column = np.array(found, np.uint64).view(np.int64)
            yield with_columns(batch, ("__text",), fp=pa.array(column))

    rows = docs.select(F.col(id_column).alias("doc_id"), *carry, whole(text).alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema.fields, T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, schema)


def trie_links(values: np.ndarray, budget: int = BUDGET, lead: int = 32) -> np.ndarray:
    """Pairs of positions in ``values`` (sorted, distinct) that share their ``lead`` first
    bits and differ in ``budget`` bits at most: an array of two columns."""
    found = [np.zeros((0, 2), np.int64)]
    if not len(values):
        return found[0]
    starts = np.flatnonzero(np.r_[True, np.diff(values >> np.uint64(64 - lead)) != 0])
    ends = np.r_[starts[1:], len(values)]
    large = ends - starts > 1
    lows, highs = starts[large], ends[large]
    # A node is a range of the sorted values; a frontier has ranges a and b, and the bits
    # in which the two paths differ so far.
    todo = [(lead, np.stack([lows, highs, lows, highs, np.zeros_like(lows)]))]
    while todo:
        level, pairs = todo.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            todo += [(level, pairs[:, :half]), (level, pairs[:, half:])]
            continue
        a_low, a_high, b_low, b_high, differ = pairs
        alone = (a_high - a_low == 1) & (b_high - b_low == 1)
        a, b = a_low[alone], b_low[alone]
        near = np.bitwise_count(values[a] ^ values[b]) <= budget
        found.append(np.stack([a[near], b[near]], axis=1))
        pairs = pairs[:, ~alone]
        if level == 64 or not pairs.shape[1]:
            continue
        a_low, a_high, b_low, b_high, differ = pairs
        a_cut = _first_one(values, a_low, a_high, level)
        b_cut = _first_one(values, b_low, b_high, level)
        same = a_low == b_low
        more = differ + 1
        children = np.concatenate(
            [
                np.stack([a_low, a_cut, b_low, b_cut, differ]),
                np.stack([a_cut, a_high, b_cut, b_high, differ]),
                np.stack([a_low, a_cut, b_cut, b_high, more]),
                np.stack([a_cut, a_high, b_low, b_cut, more])[:, ~same],
            ],
            axis=1,
        )
        a_size, b_size = children[1] - children[0], children[3] - children[2]
        kept = (a_size > 0) & (b_size > 0) & (children[4] <= budget)
        kept &= (children[0] != children[2]) | (a_size > 1)  # a value is not its own partner
        todo.append((level + 1, children[:, kept]))
    return np.concatenate(found)


def _first_one(values: np.ndarray, low: np.ndarray, high: np.ndarray, level: int) -> np.ndarray:
    """Where the second child of each node begins: the first value with this bit set."""
    bit = np.uint64(1) << np.uint64(63 - level)
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        one = (values[np.minimum(middle, len(values) - 1)] & bit) != 0
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)


def local_roots(count: int, links: np.ndarray) -> np.ndarray:
    """For each of ``count`` positions the least position of its component."""
    root = np.arange(count)
    while len(links):
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        before = root.copy()
        np.minimum.at(root, root[links[:, 0]], low)
        np.minimum.at(root, root[links[:, 1]], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(root, before):
            break
    return root


def _led(lead: int) -> F.Column:
    """The fingerprint with its blocks in the order of ``LEADS[lead]``."""
    parts = [
        F.shiftleft(
            F.shiftrightunsigned("fp", 64 - BLOCK_BITS * (block + 1)).bitwiseAND(0xFFFF),
            64 - BLOCK_BITS * (place + 1),
        )
        for place, block in enumerate(LEADS[lead])
    ]
    return parts[0].bitwiseOR(parts[1]).bitwiseOR(parts[2]).bitwiseOR(parts[3])


def links_between(distinct: DataFrame, name: str = "fp") -> DataFrame:
    """``u, v``: links between fingerprints (column ``fp``, distinct) that differ in two
    bits or fewer, enough of them to connect what is connected. Another column can name
    the fingerprints in the links."""
    kind = distinct.schema[name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        lead, led = rows["lead"].to_numpy(), rows["led"].to_numpy().view(np.uint64)
        for which, blocks in enumerate(LEADS):
            own = np.flatnonzero(lead == which)
            own = own[np.argsort(led[own])]
            values = led[own]
            root = local_roots(len(values), trie_links(values))
            linked = np.flatnonzero(root != np.arange(len(values)))
            for at in range(0, len(linked), 100_000):
                some = linked[at : at + 100_000]
                if name == "fp":
                    ends = [pa.array(_unled(values[x], blocks).view(np.int64)) for x in (some, root[some])]
                else:
                    ends = [rows["name"].take(pa.array(own[x])).combine_chunks() for x in (some, root[some])]
                yield pa.RecordBatch.from_arrays(ends, names=["u", "v"])

    leads = F.array(*(F.struct(F.lit(k).alias("lead"), _led(k).alias("led")) for k in range(len(LEADS))))
    named = [] if name == "fp" else [F.col(name).alias("name")]
    rows = distinct.select(F.explode(leads).alias("x"), *named).select("x.lead", "x.led", *(["name"] if named else []))
    owner = F.shiftrightunsigned("led", 32)
    return rows.repartition("lead", owner).mapInArrow(run, f"u {kind}, v {kind}")


def _unled(values: np.ndarray, blocks: tuple[int, ...]) -> np.ndarray:
    plain = np.zeros_like(values)
    for place, block in enumerate(blocks):
        part = (values >> np.uint64(64 - BLOCK_BITS * (place + 1))) & np.uint64(0xFFFF)
        plain |= part << np.uint64(64 - BLOCK_BITS * (block + 1))
    return plain


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the carried columns, ``fingerprint``,
    ``component_id`` and ``group``.

    ``component_id`` is the smallest id that is reachable over fingerprints differing in
    two bits or fewer; ``group`` the least fingerprint (as a signed number) of that
    component. NULL and empty texts have fingerprint zero and link like any other. A NULL
    id never is a component's id unless all its ids are NULL. Repeated rows and equal
    texts share a component. Texts are read whole; an empty table gives no rows; columns
    other than the id, the text and those carried are ignored.
    """
    rows = settled(fingerprints(docs, id_column, text, carry))
    least = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    root = roots(links_between(least.select("fp")))
    rooted = least.join(root.select(F.col("u").alias("fp"), "v"), "fp", "left").select(
        "fp", "least_id", F.coalesce("v", "fp").alias("group")
    )
    ids = rooted.groupBy("group").agg(F.min("least_id").alias("component_id"))
    by_print = rooted.join(ids, "group").select("fp", "group", "component_id")
    return rows.join(by_print, "fp").select(
        "doc_id",
        *carry,
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "group",
    )


def one_of_each(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    grouped: Callable[..., DataFrame] = near_duplicates,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, one of each near-duplicate group as
    ``grouped`` tells them: the one with the smallest id, of repeated ids the one whose text
    hashes lowest.

    Fingerprints are joined without texts; then each kept text is shuffled once. Rows
    that share id and text are reduced to one with a partial aggregation, so a row that
    is repeated very often costs each task one row.
    """
    # The row goes as one column, so that none of its columns can clash with those made here.
    row = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("doc")
    hashed = docs.select(
        row, F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(whole(text)).alias("__hash")
    )
    found = grouped(hashed.drop("doc"), "id", "text", carry=("__hash",))
    rows = found.groupBy("group", "doc_id", "__hash").agg(F.count(F.lit(1)).alias("__rows"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__hash", "__rows")).alias("kept")
    kept = settled(
        rows.groupBy("group")
        .agg(least)
        .select(F.col("group").alias("__group"), "kept.__hash", F.col("kept.doc_id").alias("__id"), "kept.__rows")
    )

    def rows_of(which: DataFrame) -> DataFrame:
        same = hashed["id"].eqNullSafe(which["__id"]) & (hashed["__hash"] == which["__hash"])
        return hashed.select("doc", "id", "__hash").join(which, same).select("doc", "__group")

    out = rows_of(kept.filter(F.col("__rows") == 1)).select("doc.*")
    repeated = kept.filter(F.col("__rows") > 1)
    if not repeated.isEmpty():
        first = rows_of(repeated).groupBy("__group").agg(F.first("doc").alias("doc"))
        out = out.unionByName(first.select("doc.*"))
    return out
