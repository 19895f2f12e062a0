"""Byte-level BPE: merges are replayed over a corpus, not over one word at a time.

Each task takes its part of the corpus in slices of bounded size. The distinct words of a
slice are laid out as one long row of tokens, and an inverted index leads from each pair's
rank to the positions where the pair stands. The lowest rank is taken from the index
again and again; all its positions are merged, and only their two neighbours change the
index. Texts are then assembled from the words' codes, and nothing is shuffled.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import portions, strings, whole, with_columns

#: Bytes of text whose distinct words are merged together in one go.
SLICE_BYTES = 4_000_000
#: Longer texts are split into words one match at a time, not as one list.
LONG_TEXT = 2_000_000

# The letters, numbers and white space of Unicode up to U+024F.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPACES = r"\t-\r \x85\xa0"

NO_PAIR = np.iinfo(np.int64).max
#: In a row of tokens: the end of a word, and a byte that belongs to a token before it.
GAP, GONE = -1, -2


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class MergeReplay:
    """Codes of words under given ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks[bytes([value])] for value in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array([*sorted(pairs), 1 << 62], np.int64)
        self.pair_ranks = np.array([*(pairs[key] for key in sorted(pairs)), NO_PAIR], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of tokens, ``NO_PAIR`` where they do not merge."""
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_PAIR)

    def codes(self, words: Sequence[bytes]) -> list[bytes]:
        """For each word its token ids as little-endian unsigned 32-bit integers."""
        known = [self.ranks.get(word) for word in words]
        rest = [word for word, rank in zip(words, known) if rank is None]
        tokens, counts = self._merged(rest)
        data, ends = tokens.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        merged = map(data.__getitem__, map(slice, [0, *ends], ends))
        return [next(merged) if rank is None else rank.to_bytes(4, "little") for rank in known]

    def _merged(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in one row, and how many each word has.

        A position is a byte; a token stands where its first byte stands. Between words
        lies a position that merges with nothing. Each round merges the pair of lowest
        rank that is left anywhere, at the leftmost of its positions in each word.
        """
        data = np.frombuffer(b"\0".join([*words, b""]), np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        count = len(data)
        word_at = np.repeat(np.arange(len(words)), lengths + 1)[:count]
        token = self.byte_ids[data]
        gaps = np.cumsum(lengths + 1) - 1
        token[gaps[gaps < count]] = GAP
        after, before = np.arange(1, count + 1), np.arange(-1, count - 1)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(ranks: np.ndarray, lefts: np.ndarray) -> None:
            kept = ranks != NO_PAIR
            ranks, lefts = ranks[kept], lefts[kept]
            if not len(ranks):
                return
            order = ranks.argsort(kind="stable")
            ranks, lefts = ranks[order], lefts[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for start, stop in zip(cuts, cuts[1:]):
                rank = int(ranks[start])
                if rank in index:
                    index[rank].append(lefts[start:stop])
                else:
                    index[rank] = [lefts[start:stop]]
                    heappush(heap, rank)

        pair_at = np.full(count, NO_PAIR)  # rank of the pair that starts here
        pair_at[:-1] = self.rank_of(token[:-1], token[1:])
        enter(pair_at, np.arange(count))
        while heap:
            rank = heappop(heap)
            found = index.pop(rank)
            at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            at = at[pair_at[at] == rank]  # entries of pairs that are gone are passed over
            if not len(at):
                continue
            leftmost = np.ones(len(at), bool)
            word = word_at[at]
            leftmost[1:] = word[1:] != word[:-1]
            if not leftmost.all():  # the rest waits, as a lower rank may arise in between
                index[rank] = [at[~leftmost]]
                heappush(heap, rank)
                at = at[leftmost]
            second = after[at]
            third = after[second]
            token[at], token[second] = rank, GONE
            pair_at[second] = NO_PAIR
            after[at], before[third] = third, at
            right = self.rank_of(token[at], token[third])
            pair_at[at] = right
            first = before[at]
            left = np.where(first >= 0, self.rank_of(token[first], token[at]), NO_PAIR)
            pair_at[first[first >= 0]] = left[first >= 0]
            enter(np.concatenate([right, left]), np.concatenate([at, first]))
        stands = token >= 0
        return token[stands], np.bincount(word_at[stands], minlength=len(words))


class WordSplitter:
    """The matches of a pattern in a text.

    Where a text has Latin letters only, the pattern runs with its Unicode classes spelt
    out for these, which the plain regular expressions of Python do faster.
    """

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern)
        classes = ((r"\p{L}", LATIN_LETTERS), (r"\p{N}", LATIN_NUMBERS), (r"\s", LATIN_SPACES))
        bracket = r"[^\s\p{L}\p{N}]"
        for name, members in classes:
            bracket = bracket.replace(name, members)
        latin = pattern.replace(r"[^\s\p{L}\p{N}]", bracket)
        for name, members in classes:
            latin = latin.replace(name, f"[{members}]")
        latin = latin.replace(r"\S", f"[^{LATIN_SPACES}]")
        plain = "\\p" not in latin and "[[" not in latin
        self.latin = re.compile(latin) if plain else None
        self.beyond_latin = re.compile("[^\\x00-\\x1b\\x20-\u024f]")

    def words(self, text: str) -> Iterator[str]:
        latin = self.latin is not None and self.beyond_latin.search(text) is None
        pattern = self.latin if latin else self.any
        if len(text) > LONG_TEXT:
            return (match.group() for match in pattern.finditer(text))
        return iter(pattern.findall(text))


def encode_slice(texts: Sequence[str], splitter: WordSplitter, replay: MergeReplay) -> list[bytes]:
    """The codes of some texts, their words merged together."""
    index: dict[str, int] = defaultdict()
    index.default_factory = index.__len__
    rows = [array("i", map(index.__getitem__, splitter.words(text))) for text in texts]
    codes = replay.codes([word.encode() for word in index])
    return [b"".join(map(codes.__getitem__, row)) for row in rows]


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    id_column: str = "doc_id",
    text: str = "text",
    decoded: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids``; with ``decoded`` also the
    bytes that the ids stand for, as :func:`decode` gives them, made in the same task.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers, as a byte-pair
    encoder with these ranks gives them for each match of ``pattern`` on its own; there
    are no special tokens. NULL and empty texts have no tokens. Texts of any length are
    encoded whole. Repeated rows are encoded each; further columns are ignored; an empty
    table gives no rows. All 256 single bytes must be among the ranks.
    """
    replay = MergeReplay(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(replay)  # as large as the vocabulary

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, splitter = shared.value, WordSplitter(pattern)
        tokens = tokens_by_id(replay.ranks) if decoded else []
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_pylist()
            for part in portions(lengths, SLICE_BYTES):
                rows = batch.slice(part.start, part.stop - part.start)
                codes = encode_slice(strings(rows, "text"), splitter, replay)
                more = {"decoded": decoded_array(codes, tokens)} if decoded else {}
                yield with_columns(
                    rows,
                    ("text",),
                    n_tokens=pa.array([len(code) // 4 for code in codes], pa.int64()),
                    ids=pa.array(codes, pa.binary()),
                    **more,
                )

    rows = docs.select(F.col(id_column).alias("doc_id"), whole(text).alias("text"))
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType()))
    return rows.mapInArrow(encoded, T.StructType([rows.schema["doc_id"], *fields]))


def tokens_by_id(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decoded_array(codes: Sequence[bytes | None], tokens: Sequence[bytes]) -> pa.Array:
    token_of = tokens.__getitem__
    texts = (b"".join(map(token_of, np.frombuffer(code or b"", "<u4").tolist())) for code in codes)
    return pa.array(texts, pa.binary(), size=len(codes))


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the bytes that the token ids stand for. NULL ids give none."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_by_id(shared.value)
        for batch in batches:
            yield with_columns(batch, (), decoded=decoded_array(batch.column(ids).to_pylist(), tokens))

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(decoded, schema)
