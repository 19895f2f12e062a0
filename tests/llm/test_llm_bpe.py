"""Token ids against the encoder of a tokenizer library; exact round trips."""

import base64
import hashlib
import random

import numpy as np
import odd
import public_tokenizers
import pytest
import tiktoken

from folioscope.llm import bpe, queries, stages

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(code):
    return np.frombuffer(code, "<u4").tolist()


def test_ranks_are_read_as_written(ranks):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        token, rank = next(lines).split()
    assert ranks[base64.b64decode(token)] == int(rank)
    assert len(ranks) == 50_256


def test_words_and_merges_equal_the_library(ranks, reference):
    random_ = random.Random(3)
    letters = "aeiouth  \n\t'sé0x1日\U0001F600ABC\x1c\x1f\x85\xa0²½ªɏɐ"
    texts = ["".join(random_.choices(letters, k=random_.randrange(80))) for _ in range(2000)]
    texts += ["a" * 500, "ab" * 300, "abcabc " * 100, "", " ", "'s's", "\x00\x00", "x\x00y" * 9]
    codes = bpe.encode_slice(texts, bpe.WordSplitter(public_tokenizers.PATTERN), bpe.MergeReplay(ranks))
    assert [ids(code) for code in codes] == [reference.encode_ordinary(text) for text in texts]


def test_a_lower_rank_that_arises_late_goes_first():
    ranks = {bytes([value]): value for value in range(256)}
    for token in (b"bc", b"abca", b"ab", b"abc", b"ca", b"aa", b"aaa"):
        ranks[token] = len(ranks)
    reference = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    random_ = random.Random(5)
    words = ["".join(random_.choices("abc", k=random_.randrange(1, 14))) for _ in range(3000)]
    codes = bpe.MergeReplay(ranks).codes([word.encode() for word in words])
    assert [ids(code) for code in codes] == [reference.encode_ordinary(word) for word in words]


def test_long_texts_are_split_match_by_match(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 10)
    text = "several words, and more of them 日本"
    codes = bpe.encode_slice([text], bpe.WordSplitter(public_tokenizers.PATTERN), bpe.MergeReplay(ranks))
    assert ids(codes[0]) == reference.encode_ordinary(text)


def test_query_equals_the_library(spark, reference):
    rows = queries.op2_bpe(spark, FOLDER).collect()
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        expected = reference.encode_ordinary(texts[row.doc_id])
        packed = np.array(expected, "<u4").tobytes()
        assert row.n_tokens == len(expected)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_odd_documents(spark, ranks, reference):
    docs = odd.documents(spark, odd.ODD)
    rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    found = sorted(((r.doc_id or 0, ids(r.ids), bytes(r.decoded).decode(), r.n_tokens) for r in rows), key=repr)
    expected = []
    for i, text, _, _ in odd.ODD:
        tokens = reference.encode_ordinary(text or "")
        expected.append((i or 0, tokens, text or "", len(tokens)))
    assert found == sorted(expected, key=repr)


def test_empty_table(spark, ranks):
    docs = odd.documents(spark, [])
    assert stages.tokens(spark, docs, FOLDER).collect() == []
