"""Shards against running sums on one machine."""

import zlib
from collections import Counter

import odd
import pytest

from folioscope.llm import queries, sharding

FOLDER = "/root/testdata/sf0.001"


def expected(rows, shards):
    """(id, size, checksum, shard, slot) by plain running sums."""
    known = []
    for i, text in rows:
        data = (text or "").encode()
        known.append((i is not None, i or 0, zlib.crc32(data), len(data) + 1, i))
    known.sort(key=lambda x: x[:4])
    total, start, slots, out = sum(x[3] for x in known), 0, Counter(), []
    for _, _, checksum, size, i in known:
        shard = (2 * start + size) * shards // (2 * total)
        out.append((i, size, checksum, shard, slots[shard]))
        slots[shard] += 1
        start += size
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in frame.collect()), key=repr)


def test_query(spark):
    frame = queries.op3_sharding(spark, FOLDER)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert found(frame) == expected(rows, 8)
    assert {(r.law, r.grown_shard) for r in frame.select("law", "grown_shard").collect()} == {("bytes", None)}
    sizes = Counter()
    for row in frame.collect():
        sizes[row.shard] += row.size
    largest = max(len((text or "").encode()) + 1 for _, text in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


@pytest.mark.parametrize("shards", [1, 3, 50])
def test_odd_documents(spark, shards):
    docs = odd.documents(spark, odd.ODD).repartition(5)
    rows = [(i, text) for i, text, _, _ in odd.ODD]
    assert found(sharding.shard_by_bytes(docs, shards)) == expected(rows, shards)


def test_one_repeated_row_is_spread(spark):
    docs = odd.documents(spark, [(4, "one", "fr", "b")]).crossJoin(spark.range(400).select("id")).repartition(4)
    rows = sharding.shard_by_bytes(docs, 8).collect()
    assert Counter(row.shard for row in rows) == {shard: 50 for shard in range(8)}


def test_empty_table(spark):
    assert sharding.shard_by_bytes(odd.documents(spark, [])).collect() == []
