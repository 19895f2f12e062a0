"""Fingerprints and components against brute force over all pairs."""

import odd
import numpy as np
import pytest
from xxhash import xxh64_intdigest

from folioscope.llm import resemblance, components, queries, simhash

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxh64_intdigest(b" ".join(shingle), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """id -> (fingerprint, smallest id that can be reached), by comparing all pairs."""
    prints = [plain_fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[find(at)] = min(least.get(find(at), i), i)
    return sorted(((i, f"{prints[at]:016x}", least.get(find(at))) for at, (i, _) in enumerate(rows)), key=repr)


def found(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(queries.op7_simhash(spark, folder)) == plain_components(rows)


def test_odd_documents(spark):
    docs = odd.documents(spark, odd.ODD).repartition(4)
    assert found(simhash.near_duplicates(docs)) == plain_components([row[:2] for row in odd.ODD])


def test_text_in_pieces(monkeypatch):
    text = "  Some words, many words.\n" * 40 + "é end"
    whole = simhash.fingerprint(text)
    for piece in (1, 7, 64):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def clusters(seed, count):
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.integers(0, 2**63, 50, dtype=np.uint64)] + [0, 2**64 - 1]
    for _ in range(count):
        value = values[rng.integers(len(values))]
        for bit in rng.choice(64, rng.integers(1, 4), replace=False):
            value ^= 1 << int(bit)
        values.append(value)
    return np.unique(np.array(values, np.uint64))


@pytest.mark.parametrize("frontier", [10, 1 << 20])
def test_trie_finds_all_pairs(monkeypatch, frontier):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    values = clusters(1, 500)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    expected = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)))}
    assert {tuple(sorted(map(int, pair))) for pair in simhash.trie_links(values, 2, 0)} == expected
    assert len(simhash.trie_links(values[:0])) == 0


def test_links_connect_what_is_connected(spark):
    values = clusters(2, 800)
    near = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2, 1))
    expected = simhash.local_roots(len(values), near)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = [(r.u, r.v) for r in simhash.links_between(frame).collect()]
    place = {int(v): at for at, v in enumerate(values.view(np.int64))}
    got = simhash.local_roots(len(values), np.array([(place[u], place[v]) for u, v in links]).reshape(-1, 2))
    assert got.tolist() == expected.tolist()


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 400)] + [(7, 7), (200, 7)]
    links = spark.createDataFrame(path + star, "u long, v long")
    found_roots = {r.u: r.v for r in components.roots(links).collect()}
    assert found_roots == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 400)}}
    assert components.roots(links.limit(0)).collect() == []


def test_one_of_each_keeps_columns_and_the_smallest_id(spark):
    docs = odd.documents(spark, odd.ODD).repartition(3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    least = {component for _, _, component in plain_components([row[:2] for row in odd.ODD])}
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == sorted(least)
    texts = {row[0]: row[1] for row in odd.ODD}
    assert all(r.text == texts[r.doc_id] for r in rows)


def test_repeated_rows_and_null_ids_leave_one(spark):
    rows = [(None, "a b c d", "en", "s")] * 5 + [(3, "q r s t u v", "en", "s")] * 4 + [(3, "other words here", "en", "s")]
    kept = simhash.one_of_each(odd.documents(spark, rows).repartition(2)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [
        (0, "a b c d"),
        (3, "other words here"),
        (3, "q r s t u v"),
    ]
    assert simhash.one_of_each(odd.documents(spark, [])).collect() == []


def test_clashing_and_dotted_columns_pass_through(spark):
    rows = [(i, f"text number {i % 3} with some words", i, f"h{i}", 7) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __hash long, `a.b` string, doc int")
    for grouped in (simhash.near_duplicates, resemblance.near_copies):
        kept = simhash.one_of_each(docs, grouped=grouped)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_links_can_be_named_by_another_column(spark):
    values = clusters(2, 300).view(np.int64)
    rows = [(int(v), bytearray(b"n%d" % v)) for v in values]
    frame = spark.createDataFrame(rows, "fp long, node binary")
    named = {(bytes(r.u), bytes(r.v)) for r in simhash.links_between(frame, "node").collect()}
    plain = {(b"n%d" % r.u, b"n%d" % r.v) for r in simhash.links_between(frame.select("fp")).collect()}
    assert named == plain and named


def test_repeated_and_turned_links_give_each_node_once(spark):
    links = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (5, 4), (5, 4), (6, 6)], "u long, v long")
    assert sorted((r.u, r.v) for r in components.roots(links).collect()) == [(2, 1), (5, 4)]
