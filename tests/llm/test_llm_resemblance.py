"""Near copies against the exact similarity of all pairs, and what the pipeline keeps."""

import numpy as np
import odd

from folioscope.llm import resemblance, stages


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[at : at + 5]) for at in range(max(1, len(words) - 4))}


def plain_components(rows):
    sets, root = [shingles(text) for _, text in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for at, (i, _) in enumerate(rows):
        least[find(at)] = min(least.get(find(at), i), i)
    return {i: least[find(at)] for at, (i, _) in enumerate(rows)}


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 4000, 200)]
        rows.append((10 * k, " ".join(words)))
        for copy, changes in enumerate((1, 2, 3, 4, 12), 1):  # 12 changes: no near copy
            changed = list(words)
            for at in rng.choice(200, changes, replace=False):
                changed[at] = "changed"
            rows.append((10 * k + copy, " ".join(changed)))
    rows += [(900, ""), (901, None), (902, "two words"), (903, "Two  words"), (904, "two more"), (905, " ")]
    expected = plain_components(rows)
    docs = odd.documents(spark, [(i, text, "en", "s") for i, text in rows]).repartition(5)
    assert {r.doc_id: r.component_id for r in resemblance.near_copies(docs).collect()} == expected
    kept = stages.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(expected.values())
    assert len(set(expected.values())) < len(rows) / 2
    assert resemblance.near_copies(odd.documents(spark, [])).collect() == []


def test_the_trie_tells_near_copies(spark, monkeypatch):
    """Without a band in common, near copies are found by their fingerprints alone."""
    monkeypatch.setattr(resemblance, "bands_of", lambda least: [])
    rng = np.random.default_rng(6)
    rows = []
    for k in range(30):
        words = [f"w{x}" for x in rng.integers(0, 9000, 4000)]
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(words[:-1])), (3 * k + 2, " ".join([*words, "more"]))]
    # The same fingerprint, zero hashes apart, and no near copy: confirmed by the sets alone.
    rows += [(900, ""), (901, " "), (902, "two words"), (903, "two more")]
    docs = odd.documents(spark, [(i, text, "en", "s") for i, text in rows]).repartition(3)
    found = {r.doc_id: r.component_id for r in resemblance.near_copies(docs).collect()}
    expected = plain_components(rows)
    assert all(found[i] in (i, expected[i]) for i in found)
    assert sum(found[i] == expected[i] for i in found) >= 0.9 * len(rows)


def crowd(pages, body, own, changed):
    """Pages with a common body and words of their own, each with a copy."""
    rng = np.random.default_rng(7)
    common = [f"b{x}" for x in range(body)]
    rows = []
    for page in range(pages):
        words = common + [f"p{page}x{x}" for x in range(own)]
        copy = list(words)
        for at in rng.choice(np.arange(body, body + own), changed, replace=False):
            copy[at] = f"new{page}"
        rows += [(2 * page, " ".join(words)), (2 * page + 1, " ".join(copy))]
    return rows


def test_copies_in_a_crowd_are_found(spark):
    """All pages share every band with hundreds of others, below the bar."""
    rows = crowd(300, 350, 50, 3)
    first, second, other = (shingles(rows[at][1]) for at in (0, 1, 2))
    assert len(first & second) / len(first | second) > 0.9
    assert 0.7 < len(first & other) / len(first | other) < 0.8
    docs = odd.documents(spark, [(i, text, "en", "s") for i, text in rows]).repartition(7)
    found = {r.doc_id: r.component_id for r in resemblance.near_copies(docs).collect()}
    assert found == {i: i - i % 2 for i, _ in rows}


def test_a_crowd_of_near_copies_is_one_group(spark):
    rng = np.random.default_rng(8)
    words = [f"w{x}" for x in rng.integers(0, 4000, 300)]
    rows = []
    for i in range(400):
        changed = list(words)
        for at in rng.choice(300, rng.integers(1, 14), replace=False):
            changed[at] = f"c{i}"
        rows.append((i, " ".join(changed)))
    docs = odd.documents(spark, [(i, text, "en", "s") for i, text in rows] * 2).repartition(5)
    found = {r.doc_id: r.component_id for r in resemblance.near_copies(docs).collect()}
    assert found == plain_components(rows)


def test_prefix_pairs_miss_no_near_pair(spark):
    rng = np.random.default_rng(9)
    sets = {}
    for i in range(150):
        base = sets[int(rng.integers(0, i))] if i and rng.random() < 0.7 else rng.integers(0, 300, int(rng.integers(1, 60)))
        kept = base[rng.random(len(base)) > rng.random() * 0.3]
        sets[i] = np.unique(np.concatenate([kept, rng.integers(0, 300, int(rng.integers(0, 6)))])).astype(np.int64)
    name = {i: b"%03d" % i for i in sets}
    frame = spark.createDataFrame([(bytearray(name[i]), bytearray(s.tobytes())) for i, s in sets.items()], "node binary, value binary")
    for parts in (len(sets), 10):
        component = spark.createDataFrame([(bytearray(name[i]), bytearray(b"%03d" % (i % parts))) for i in sets], "node binary, part binary")
        found = {(bytes(r.u), bytes(r.v)) for r in resemblance._prefix_pairs(frame, component, 0.8).collect()}
        near = {
            (name[a], name[b]) for a in sets for b in sets
            if a < b and a % parts != b % parts and len(sets[a]) and resemblance.jaccard(sets[a].view(np.uint64), sets[b].view(np.uint64)) >= 0.8
        }
        assert near and near <= found


def test_prefix_pairs_of_alike_sets_that_are_not_near_are_few(spark):
    """Each set is a part of one and shares rare hashes with most others, hardly ever enough."""
    rng = np.random.default_rng(10)
    common = rng.integers(-(1 << 63), 1 << 63, 220)
    sets = [np.sort(common[rng.random(220) < 0.6].view(np.uint64)) for _ in range(120)]
    sets += [s[1:] for s in sets[:20]]
    name = [b"%03d" % i for i in range(len(sets))]
    frame = spark.createDataFrame([(bytearray(n), bytearray(s.tobytes())) for n, s in zip(name, sets)], "node binary, value binary")
    component = spark.createDataFrame([(bytearray(n), bytearray(n)) for n in name], "node binary, part binary")
    found = {(bytes(r.u), bytes(r.v)) for r in resemblance._prefix_pairs(frame, component, 0.8).collect()}
    pairs = [(a, b) for b in range(len(sets)) for a in range(b)]
    near = {(name[a], name[b]) for a, b in pairs if resemblance.jaccard(sets[a], sets[b]) >= 0.8}
    assert len(near) >= 20 and near <= found
    assert len(found) < 3 * len(near)


def test_near_copies_take_few_stages(spark):
    """Each stage costs a cluster the files and events of all its tasks, however few its rows."""
    docs = odd.documents(spark, [(i, text, "en", "s") for i, text in crowd(60, 350, 50, 3)]).repartition(3)
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("few stages", "near copies")
    try:
        kept = {r.doc_id for r in stages.near_duplicates(spark, docs, "").collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    ran = {s for job in tracker.getJobIdsForGroup("few stages") for s in tracker.getJobInfo(job).stageIds}
    found = [info for info in map(tracker.getStageInfo, ran) if info and info.numCompletedTasks]
    assert kept == {2 * page for page in range(60)}
    assert 20 < len(found) < 120
