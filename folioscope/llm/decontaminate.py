"""Benchmark leaks, found in a latent space and confirmed word by word.

Texts become codes: the number of each word in the benchmark's vocabulary, 0 for other
words. Passages are two neighbouring blocks of 16 words. Their TF-IDF vectors span a
matrix A with a row per passage of the corpus; a randomised range finder gives its main
right singular vectors: tasks add up their parts of ``A^T A R`` for a random R, the parts
are summed by a shuffle, and the driver decomposes the sum, whose size is vocabulary times
rank. Every passage is then projected and compared with the projected passages of the
benchmark. Pairs of large cosine are candidates; the longest common subsequence of the
item and the words around the passage decides, with a check of the item's end, its answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import settled, strings, whole

BLOCK = 16
RANK = 192
OVERSAMPLE = 16
SEED = 11
#: Least cosine of a candidate, for an item as long as a passage. A shorter one fills only
#: part of a passage; its bar falls with the root of that part, as its cosine does.
COSINE = 0.55
#: Confirmed: so much of the item in common; or less, if its answer is there too. Either
#: way the words in common must have ``PARAPHRASE_SHARE`` of the item's inverse frequencies.
LCS_SHARE = 0.8
PARAPHRASE_SHARE, ANSWER_SHARE = 0.6, 0.8
ANSWER_WORDS = 6
#: Items of the benchmark that share a vocabulary and a pass over the corpus.
ITEMS_AT_A_TIME = 20_000
#: Blocks of words that are projected at a time, queries they are compared with at a time,
#: and terms in one row of a partial sum.
BLOCKS_AT_A_TIME = 4096
QUERIES_AT_A_TIME = 8192
TERM_GROUP = 256
#: Partial sums of a group of terms are added in so many shares first, then the shares.
SHARES = 64

# Bytes: A-Z lowered, ASCII punctuation and controls as spaces, all others as they are.
_FOLD = bytes(
    value if value >= 128 else (value | 32 if chr(value).isalpha() else value if chr(value).isdigit() else 32)
    for value in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters."""
    return text.lower().encode().translate(_FOLD).split()


def block_table(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``BLOCK`` codes, padded with 0 at each text's end, with an empty row before
    the next text; and the first row of each text."""
    rows = [-(-len(code) // BLOCK) + 1 for code in codes]
    first = np.cumsum([0, *rows])[:-1]
    table = np.zeros(sum(rows) * BLOCK, np.int64)
    for start, code in zip(first, codes):
        table[start * BLOCK : start * BLOCK + len(code)] = code
    return table.reshape(-1, BLOCK), first


def lcs(first: np.ndarray, second: np.ndarray) -> int:
    """Length of the longest common subsequence; code 0 matches nothing (bit-parallel)."""
    place: dict[int, int] = {}
    for at, code in enumerate(first.tolist()):
        if code:
            place[code] = place.get(code, 0) | 1 << at
    full = (1 << len(first)) - 1
    free = full
    for code in second.tolist():
        hit = free & place.get(code, 0)
        if hit:
            free = ((free + hit) | (free - hit)) & full
    return len(first) - free.bit_count()


@dataclass
class Space:
    """A block of items with their vocabulary and, once fitted, their latent space."""

    item_ids: list
    items: list[np.ndarray]
    vocabulary: dict[bytes, int]
    weight: np.ndarray | None = None
    basis: np.ndarray | None = None
    queries: np.ndarray | None = None
    query_item: np.ndarray | None = None
    bar: np.ndarray | None = None
    rarity: np.ndarray | None = None

    @staticmethod
    def of(item_ids: list, texts: list[str]) -> Space:
        vocabulary: dict[bytes, int] = {}
        items = []
        for text in texts:
            codes = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in words_of(text)]
            items.append(np.array(codes, np.int64))
        return Space(item_ids, items, vocabulary)

    @property
    def code_type(self) -> str:
        return "<u2" if len(self.vocabulary) < 1 << 16 else "<u4"

    def codes(self, text: str) -> np.ndarray:
        words = words_of(text)
        found = map(self.vocabulary.get, words, [0] * len(words))
        return np.fromiter(found, self.code_type, len(words))

    def fit(self, frequency: np.ndarray, blocks: int, basis: np.ndarray) -> None:
        """``frequency``: blocks with each term; ``basis``: its rows' latent coordinates."""
        self.weight, self.basis = idf(frequency, blocks), basis
        self.rarity = np.sqrt(self.weight)
        rows, owner = [], []
        for at, item in enumerate(self.items):
            if not len(item):
                continue
            last = max(len(item) - 2 * BLOCK, 0)
            for start in {*range(0, last + 1, BLOCK), last}:
                coordinates = self.weighted()[item[start : start + 2 * BLOCK]].sum(axis=0)
                rows.append(unit(coordinates[None, :])[0])
                owner.append(at)
        self.queries = np.array(rows, np.float32).reshape(len(rows), basis.shape[1])
        self.query_item = np.array(owner, np.int64)
        lengths = np.array([len(self.items[at]) for at in owner])
        self.bar = COSINE * np.sqrt(np.minimum(1, lengths / (2 * BLOCK)))

    def weighted(self) -> np.ndarray:
        return (self.basis * self.weight[:, None]).astype(np.float32)

    def leaks(self, codes: list[np.ndarray]) -> Iterator[tuple[int, int, dict]]:
        """Text and item numbers of confirmed leaks, with what was measured."""
        if not len(self.queries):
            return
        table, first = block_table(codes)
        weighted = self.weighted()
        present = np.zeros(len(self.vocabulary) + 1, bool)
        best: dict[tuple[int, int], dict] = {}
        for start in range(0, max(len(table) - 1, 0), BLOCKS_AT_A_TIME):
            part = table[start : start + BLOCKS_AT_A_TIME + 1]
            sums = _block_sums(weighted, part)
            passages = unit(sums[:-1] + sums[1:])
            where, which, cosine = self._near(passages)
            text_at = np.searchsorted(first, start + where, side="right") - 1
            for row, query, text, near in zip(where.tolist(), which.tolist(), text_at.tolist(), cosine.tolist()):
                item_at = int(self.query_item[query])
                found = self._confirm(codes[text], (start + row - first[text]) * BLOCK, item_at, present)
                known = best.get((text, item_at))
                if found and (known is None or found["lcs_share"] > known["lcs_share"]):
                    found["cosine"] = near
                    best[text, item_at] = found
        for (text, item_at), found in sorted(best.items()):
            yield text, item_at, found

    def _near(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages and queries above the bar, in this order, and their cosines; some queries at a
        time, so that memory does not grow with the benchmark."""
        parts = []
        for first in range(0, len(self.queries), QUERIES_AT_A_TIME):
            some = slice(first, first + QUERIES_AT_A_TIME)
            cosine = passages @ self.queries[some].T
            where, which = np.nonzero(cosine >= self.bar[some])
            parts.append((where, which + first, cosine[where, which]))
        where, which, cosine = (np.concatenate(part) for part in zip(*parts))
        order = np.lexsort((which, where))
        return where[order], which[order], cosine[order]

    def _confirm(self, code: np.ndarray, at: int, item_at: int, present: np.ndarray) -> dict | None:
        item = self.items[item_at]
        low, high = max(0, at - len(item)), min(len(code), at + 2 * BLOCK + len(item))
        around = code[low:high]
        weight = self.rarity[item]
        present[around] = True
        common = weight[present[item]].sum()
        present[around] = False
        if common < PARAPHRASE_SHARE * weight.sum():
            return None  # common words alone, in whatever order, are no leak
        share = lcs(item, around) / len(item)
        answer = item[-ANSWER_WORDS:]
        answer_share = lcs(answer, around) / len(answer)
        if share >= LCS_SHARE or (share >= PARAPHRASE_SHARE and answer_share >= ANSWER_SHARE):
            return {"word": int(at), "lcs_share": share, "answer_share": answer_share}
        return None


def _block_sums(weighted: np.ndarray, part: np.ndarray) -> np.ndarray:
    sums = weighted[part[:, 0]].copy()
    for column in range(1, BLOCK):
        sums += weighted[part[:, column]]
    return sums


def idf(frequency: np.ndarray, blocks: int) -> np.ndarray:
    """Squared inverse frequency: common words would fill the space otherwise."""
    weight = (np.log((blocks + 1) / (frequency + 1)) + 1e-3) ** 2
    weight[0] = 0
    return weight


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def _coded(docs: DataFrame, space: Space, id_column: str, text: str) -> DataFrame:
    """``doc_id`` and the codes of its text, written once for all passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [space.codes(value).tobytes() for value in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codes, pa.binary())], names=["doc_id", "codes"]
            )

    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("codes", T.BinaryType())])
    return settled(rows.mapInArrow(run, schema))


def _tables(batches: Iterator[pa.RecordBatch], code_type: str) -> Iterator[np.ndarray]:
    for batch in batches:
        codes = [np.frombuffer(code, code_type) for code in batch.column("codes").to_pylist()]
        yield block_table(codes)[0]


def _frequencies(coded: DataFrame, space: Space) -> tuple[np.ndarray, int]:
    """In how many blocks of the corpus each term stands; the number of blocks."""
    terms, code_type = len(space.vocabulary) + 1, space.code_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, blocks = np.zeros(terms, np.int64), 0
        for table in _tables(batches, code_type):
            blocks += len(table)
            in_order = np.sort(table, axis=1)
            new = np.ones(table.shape, bool)
            new[:, 1:] = in_order[:, 1:] != in_order[:, :-1]
            count += np.bincount(in_order[new], minlength=terms)
        count[0] = blocks
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(count[seen])], names=["term", "n"])

    found = coded.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(terms, np.int64)  # one row per term of the vocabulary
    total[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return total, int(total[0])


def _range(coded: DataFrame, space: Space, weight: np.ndarray, rank: int) -> np.ndarray:
    """``A^T A R`` for a random R: one row per term."""
    terms, code_type = len(weight), space.code_type
    width = min(rank + OVERSAMPLE, terms)
    random = np.random.default_rng(SEED).normal(size=(terms, width)).astype(np.float32)
    weighted = (random * weight[:, None]).astype(np.float32)
    square = (weight**2).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width), np.float32)
        for whole_table in _tables(batches, code_type):
            for start in range(0, max(len(whole_table) - 1, 0), BLOCKS_AT_A_TIME):
                table = whole_table[start : start + BLOCKS_AT_A_TIME + 1]
                sums, norms = _block_sums(weighted, table), square[table].sum(axis=1)
                norm = np.maximum(norms[:-1] + norms[1:], 1e-12)[:, None]
                passages = (sums[:-1] + sums[1:]) / norm  # rows of A have length one
                back = np.zeros_like(sums)  # what each block gets from its two passages
                back[:-1] += passages
                back[1:] += passages
                code = table.ravel()
                places = np.flatnonzero(code)
                if not len(places):
                    continue
                places = places[code[places].argsort(kind="stable")]
                ordered = code[places]
                starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                total[ordered[starts]] += np.add.reduceat(back[places // BLOCK], starts, axis=0)
        total *= weight[:, None]
        groups = range(0, terms, TERM_GROUP)
        data = [total[at : at + TERM_GROUP].tobytes() for at in groups]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*groups], pa.int64()), pa.array(data, pa.binary())], names=["term", "sums"]
        )

    def add(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, data in zip(batch.column("term").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(data, kind).astype(np.float64)
                totals[term] = totals[term] + part if term in totals else part
        data = [part.tobytes() for part in totals.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*totals], pa.int64()), pa.array(data, pa.binary())], names=["term", "sums"]
        )

    schema = "term long, sums binary"
    # A group of terms has a row from every task: shares of them are added by many tasks.
    share = F.pmod(F.spark_partition_id(), F.lit(SHARES))
    parts = coded.mapInArrow(run, schema).withColumn("share", share).repartition("term", "share")
    parts = parts.select("term", "sums").mapInArrow(lambda rows: add(rows, np.float32), schema)
    summed = parts.repartition("term").mapInArrow(lambda rows: add(rows, np.float64), schema).toArrow()
    product = np.zeros((terms, width))
    for term, data in zip(summed.column("term").to_pylist(), summed.column("sums").to_pylist()):
        part = np.frombuffer(data, np.float64).reshape(-1, width)
        product[term : term + len(part)] = part
    return product


def fit_space(coded: DataFrame, space: Space, rank: int = RANK) -> Space:
    """The latent space of all passages of the corpus for a block of items."""
    frequency, blocks = _frequencies(coded, space)
    product = _range(coded, space, idf(frequency, blocks), rank)
    left, strength, _ = np.linalg.svd(product, full_matrices=False)
    kept = left[:, : max(1, min(rank, int((strength > 1e-9 * max(strength[0], 1e-30)).sum())))]
    space.fit(frequency, blocks, kept)
    return space


def item_blocks(benchmark: DataFrame, size: int = ITEMS_AT_A_TIME) -> Iterator[tuple[list, list[str]]]:
    """The benchmark's ids and texts, a bounded number at a time."""
    items = benchmark.select("item_id", whole("text").alias("text"))
    count = items.count()
    blocks = -(-count // size)
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        rows = items.filter(mine).orderBy("item_id", "text").toArrow()
        yield rows.column("item_id").to_pylist(), rows.column("text").to_pylist()


LEAK = "item_id {item}, word long, cosine double, lcs_share double, answer_share double"


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", rank: int = RANK
) -> DataFrame:
    """One row per document row and leaked benchmark item: ``doc_id, item_id, word,
    cosine, lcs_share, answer_share``; ``word`` is about where the leak begins.

    ``benchmark`` has ``item_id`` and ``text``. An item leaks if 0.8 of its words stand in
    the text in their order close together, or 0.6 of them with 0.8 of its last six words,
    and if these words are not only common ones (0.6 of the inverse frequencies).
    NULL and empty texts and items give nothing, neither do empty tables; repeated rows
    give repeated leaks; equal items leak together; NULL ids are kept as they are. Texts
    are searched whole; further columns are ignored.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()
    id_field = docs.select(F.col(id_column).alias("doc_id")).schema["doc_id"]
    schema = T.StructType([id_field, *T.StructType.fromDDL(LEAK.format(item=kind)).fields])
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in item_blocks(benchmark):
        space = Space.of(ids, texts)
        coded = _coded(docs, space, id_column, text)
        fit_space(coded, space, rank)
        out = out.unionByName(coded.mapInArrow(_finder(space, schema), schema))
    return out


def _finder(space: Space, schema: T.StructType):
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(code, space.code_type) for code in batch.column("codes").to_pylist()]
            found = [*space.leaks(codes)]
            ids = batch.column("doc_id").take(pa.array([text for text, _, _ in found], pa.int64()))
            items = pa.array([space.item_ids[item] for _, item, _ in found])
            rest = [pa.array([x[2][name] for x in found]) for name in names[2:]]
            if found:
                yield pa.RecordBatch.from_arrays([ids, items, *rest], names=names)

    return run


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", rank: int = RANK
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those that leak an item.

    The space is fitted on codes; the texts then are read once more and filtered where
    they lie, without a shuffle.
    """
    for ids, texts in item_blocks(benchmark):
        space = fit_space(_coded(docs, fresh := Space.of(ids, texts), id_column, text), fresh, rank)

        def run(batches: Iterator[pa.RecordBatch], space: Space = space) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for found, _, _ in space.leaks([space.codes(value) for value in strings(batch, text)]):
                    clean[found] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
