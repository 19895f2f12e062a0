"""Near copies by the share of word shingles in common, for the corpus pipeline.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is
0.8 or more. Texts with equal sets are one node. Nodes that agree in a band of minhashes
are candidates, and so are nodes that the trie of SimHash fingerprints (:mod:`simhash`)
links; every candidate is confirmed on the whole sets, so none is wrong. A pair of
similarity 0.8 agrees in no band with probability 2e-5, and in under half of the minhashes,
which spares a candidate its sets, with probability 1e-6.

A band shared by few nodes compares them all. In a crowded one all are compared with one
of them, another for each band, which connects groups of near copies. What may then be
missing, links between nodes of crowded bands in different components, is found exactly:
shingles are ordered from rare to common, near copies share one within their prefixes,
and there their places leave room for the overlap they need. Shingles that only nodes of
one component have in their prefixes are left out, so large groups of copies cost no pairs.

Of all candidates those go on whose sets can be near by their parities: the places, of
512, that an odd number of hashes falls on. Two sets differ in as many hashes at least as their
parities in places, so this loses none, and alike texts that are not near cost no sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest, xxh64_intdigest

from folioscope.llm.common import settled, strings, whole, with_columns
from folioscope.llm.components import roots
from folioscope.llm.simhash import fingerprint, links_between, shingle_hashes
from folioscope.session import scratch_path

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS, BAND_ROWS = 16, 3
#: Bands shared by more nodes are crowded.
CROWD = 32
#: Candidates go on if so many of their minhashes agree, by 16 bits each.
LEAST_AGREEING = BANDS * BAND_ROWS // 2
#: Places on which the hashes of a set are counted, odd or even: 64 to a word.
PARITY_WORDS = 8
#: Pairs that meet the set of one node in one task, and copies of a text that do.
SHARE, SALTS = 256, 8

_RANDOM = np.random.default_rng(42).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)
FACTORS, TERMS = _RANDOM[0] << np.uint64(1) | np.uint64(1), _RANDOM[1]


def shingle_set(text: str) -> np.ndarray:
    """The distinct hashes of the text's shingles, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, SHINGLE)]))


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """One least value for each hash function; an empty set has the greatest number."""
    least = np.full(len(FACTORS), ~np.uint64(0))
    for start in range(0, len(hashes), 1 << 12):
        part = hashes[start : start + (1 << 12)]
        for at, (factor, term) in enumerate(zip(FACTORS, TERMS)):
            least[at] = min(least[at], (part * factor + term).min())
    return least


def bands_of(least: np.ndarray) -> list[int]:
    """One number for each band of minhashes."""
    rows = least.reshape(BANDS, BAND_ROWS)
    return [xxh64_intdigest(row.tobytes(), band) - (1 << 63) for band, row in enumerate(rows)]


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit for each place, set if an odd number of hashes falls on it."""
    places = hashes // np.uint64((1 << 64) // (64 * PARITY_WORDS))
    odd = np.bincount(places.astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_apart(least: float) -> float:
    """The share of the sizes of two sets, added, in which near ones differ at most."""
    return (1 - least) / (1 + least)


def jaccard(first: np.ndarray, second: np.ndarray) -> float:
    """Of two sets in order; 1 if both are empty."""
    common = len(np.intersect1d(first, second, assume_unique=True))
    either = len(first) + len(second) - common
    return common / either if either else 1.0


def _sketched(rows: DataFrame) -> DataFrame:
    """``node`` (128 bits of the set), ``bands``, ``sketch`` (minhashes, parity, size), ``fp``
    in place of ``__text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, bands, sketches, prints = [], [], [], []
            for value in strings(batch, "__text"):
                hashes = shingle_set(value)
                least = minhashes(hashes)
                nodes.append(xxh3_128_digest(hashes.tobytes()))
                bands.append(bands_of(least))
                least = (least >> np.uint64(48)).astype(np.uint16)
                sketches.append(least.tobytes() + parity(hashes).tobytes() + np.int64(len(hashes)).tobytes())
                prints.append(fingerprint(value))
            yield with_columns(
                batch,
                ("__text",),
                node=pa.array(nodes, pa.binary()),
                bands=pa.array(bands, pa.list_(pa.int64())),
                sketch=pa.array(sketches, pa.binary()),
                fp=pa.array(np.array(prints, np.uint64).view(np.int64)),
            )

    new = T.StructType.fromDDL("node binary, bands array<long>, sketch binary, fp long").fields
    return rows.mapInArrow(run, T.StructType([*rows.drop("__text").schema.fields, *new]))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("u") != F.col("v")).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    )


def _by_trie(nodes: DataFrame) -> DataFrame:
    """``u, v``: each node with the least of its fingerprint, and the least nodes of the
    fingerprints that the trie links; no more pairs than nodes and links."""
    least = nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"))
    same = nodes.join(least.filter(F.col("n") > 1).select("fp", "first"), "fp")
    pairs = same.select(F.col("node").alias("u"), F.col("first").alias("v"))
    return _ordered(pairs.union(links_between(least.select("fp", "first"), "first")))


def _candidates(nodes: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``u, v``: distinct pairs of nodes that the trie links or that share a band, in a crowded
    band those with one of its nodes; and the nodes of crowded bands, some repeated."""
    keys = nodes.select("node", F.explode("bands").alias("band"))
    seen = keys.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "band"), "node")).alias("x")
    )
    shared = seen.filter(F.col("n") > 1).select("band", "n", F.col("x.node").alias("v"))
    met = settled(keys.join(shared, "band").select("band", "n", F.col("node").alias("u"), "v"))
    few = met.filter(F.col("n") <= CROWD)
    pairs = few.select("band", "u").join(few.select("band", F.col("u").alias("v")), "band")
    crowded = met.filter(F.col("n") > CROWD)
    both = pairs.select("u", "v").filter(F.col("u") < F.col("v")).unionByName(_ordered(crowded.select("u", "v")))
    both = both.unionByName(_by_trie(nodes.select("node", "fp")))
    return settled(_alike(settled(both.distinct()), nodes, least)), crowded.select(F.col("u").alias("node"))


def _alike(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs of which enough minhashes agree, and whose parities leave room to be near."""
    kind = np.dtype([("least", np.uint16, BANDS * BAND_ROWS), ("parity", np.int64, PARITY_WORDS), ("size", np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(name).to_pylist()), kind) for name in ("a", "b"))
            apart = np.bitwise_count((a["parity"] ^ b["parity"]).view(np.uint64)).sum(axis=1)
            alike = (a["least"] == b["least"]).sum(axis=1) >= LEAST_AGREEING
            alike &= apart <= most_apart(least) * (a["size"] + b["size"]) + 1e-9
            yield batch.filter(pa.array(alike, pa.bool_())).select(["u", "v"])

    joined = _with_both(pairs, nodes.select("node", F.col("sketch").alias("value")))
    return joined.mapInArrow(run, "u binary, v binary")


def _with_both(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """``u, v, a, b``: the pairs with the ``value`` of either node.

    A node of very many pairs would gather them all in one task: its pairs are dealt into
    shares, and its value is repeated for each. Such nodes are few; they are written, so that
    Spark knows their size before it plans the joins, and neither pairs nor values are
    shuffled to meet them.
    """
    spark = pairs.sparkSession
    counts = pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.select("node", F.ceil(F.col("n") / SHARE).cast("int").alias("__shares")).filter("__shares > 1")
    path = scratch_path(spark, "shares")
    hot.write.parquet(path)
    hot = spark.read.schema(hot.schema).parquet(path)
    every = F.sequence(F.lit(0), F.coalesce(F.col("__shares") - 1, F.lit(0)))
    held = values.select("node", "value").join(hot, "node", "left").select("node", "value", F.explode(every).alias("__share"))
    for end, name, other in (("u", "a", "v"), ("v", "b", "u")):
        share = F.coalesce(F.pmod(F.xxhash64(other), F.col("__shares")), F.lit(0)).cast("int")
        dealt = pairs.join(hot.withColumnRenamed("node", end), end, "left").withColumn("__share", share)
        pairs = dealt.drop("__shares").join(
            held.withColumnsRenamed({"node": end, "value": name}), [end, "__share"]
        ).drop("__share")
    return pairs


def _sets(texts: DataFrame) -> DataFrame:
    """``value`` in place of ``__text``: the hashes of the shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(value).tobytes() for value in strings(batch, "__text")]
            yield with_columns(batch, ("__text",), value=pa.array(sets, pa.binary()))

    value = T.StructField("value", T.BinaryType())
    return texts.mapInArrow(run, T.StructType([*texts.drop("__text").schema.fields, value]))


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[np.frombuffer(x, np.uint64) for x in batch.column(name).to_pylist()] for name in ("a", "b")]
            near = [jaccard(a, b) >= least for a, b in zip(*columns)]
            yield batch.filter(pa.array(near, pa.bool_())).select(["u", "v"])

    return _with_both(pairs, sets).select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def _shingles(sets: DataFrame) -> DataFrame:
    """``node, token``: a row for each shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x, np.int64) for x in batch.column("value").to_pylist()]
            nodes = batch.column("node").take(pa.array(np.repeat(np.arange(len(values)), list(map(len, values)))))
            tokens = np.concatenate([np.zeros(0, np.int64), *values])
            yield pa.RecordBatch.from_arrays([nodes, pa.array(tokens)], names=["node", "token"])

    return sets.mapInArrow(run, "node binary, token long")


def _parities(sets: DataFrame) -> DataFrame:
    """``node, p0, p1, ...``: the parity of each set, word by word."""
    names = [f"p{word}" for word in range(PARITY_WORDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parity(np.frombuffer(x, np.uint64)) for x in batch.column("value").to_pylist()]
            words = np.array(found, np.int64).reshape(-1, PARITY_WORDS).T
            yield pa.RecordBatch.from_arrays([batch.column("node"), *map(pa.array, words)], names=["node", *names])

    return sets.mapInArrow(run, ", ".join(["node binary", *(f"{name} long" for name in names)]))


def _prefix_pairs(sets: DataFrame, component: DataFrame, least: float) -> DataFrame:
    """``u, v``: pairs of the given nodes, of different components (``node, part``; a node
    without is one of its own), that can be near by the prefixes of their shingles; no near
    pair is missing.

    Of two near sets the smaller has one of its first ``size - 2·least/(1 + least)·size + 1``
    shingles among the first ``size - least·size + 1`` of the larger. The rarest that they share is
    preceded by none in common, so what follows it in both bounds their overlap; so do their
    parities.
    """
    shingles = _shingles(sets)
    counts = shingles.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ordered = shingles.join(counts, "token").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("n", "token"))).alias("tokens")
    )
    size = F.size("tokens")
    probing = size - F.ceil(size * least - 1e-9) + 1
    prefixes = (
        ordered.join(component, "node", "left")
        .select("node", F.coalesce("part", "node").alias("part"), size.alias("size"), F.posexplode(F.slice("tokens", F.lit(1), probing.cast("int"))).alias("pos", "t"))
        .select("node", "part", "size", "pos", F.col("t.token").alias("token"))
    )
    prefixes = settled(prefixes)
    parities = _parities(sets)
    columns = ["node", "part", "size", "pos", *parities.columns[1:]]
    mixed = prefixes.groupBy("token").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q").select("token")
    rows = settled(prefixes.join(mixed, "token").join(parities, "node"))
    share = least / (1 + least)
    indexed = rows.filter(F.col("pos") < F.col("size") - F.ceil(2 * share * F.col("size") - 1e-9) + 1)
    a = indexed.select("token", *(F.col(c).alias(f"a_{c}") for c in columns))
    b = rows.select("token", *(F.col(c).alias(f"b_{c}") for c in columns))
    apart = sum(F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in parities.columns[1:])
    room = F.least(F.col("a_size") - F.col("a_pos"), F.col("b_size") - F.col("b_pos"))
    met = a.join(b, "token").filter(
        (F.col("a_part") != F.col("b_part"))
        & (F.col("a_size") <= F.col("b_size"))
        & (F.col("a_size") >= least * F.col("b_size") - 1e-9)
        & (room >= share * (F.col("a_size") + F.col("b_size")) - 1e-9)
        & (apart <= most_apart(least) * (F.col("a_size") + F.col("b_size")) + 1e-9)
    )
    return _ordered(met.select(F.col("a_node").alias("u"), F.col("b_node").alias("v"))).distinct()


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    least: float = LEAST_SIMILARITY,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the carried columns, ``component_id`` (the
    smallest id reachable over near copies) and ``group``.

    Words are as in :mod:`simhash`; a text of fewer than five has one shingle, one without
    words none, and equals all such. A NULL id never is a component's id unless all its ids
    are NULL. Texts are read whole; an empty table gives no rows.
    """
    hashed = docs.withColumn("__own", F.xxhash64(whole(text)))
    rows = settled(
        _sketched(hashed.select(F.col(id_column).alias("doc_id"), "__own", *carry, whole(text).alias("__text")))
    )
    nodes = settled(
        rows.groupBy("node").agg(
            F.min("__own").alias("own"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.min("fp").alias("fp"),
        )
    )
    pairs, crowded = _candidates(nodes, least)
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("node"), F.lit(False).alias("crowded"))
    wanted = wanted.union(crowded.withColumn("crowded", F.lit(True))).groupBy("node").agg(F.max("crowded").alias("crowded"))
    # One text for each wanted node: of rows with its text hash, all have the same text. The
    # copies of a text are dealt into shares, each of which keeps one.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")
    owns = nodes.join(wanted, "node").select("node", "crowded", F.col("own").alias("__own"), salts)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("__salt")
    texts = docs.select(F.xxhash64(whole(text)).alias("__own"), salt, whole(text).alias("__text"))
    held = texts.join(owns, ["__own", "__salt"]).groupBy("node", "crowded").agg(F.first("__text").alias("__text"))
    sets = settled(_sets(held))
    root = roots(_confirmed(pairs, sets, least))
    if crowded.head(1):
        component = root.select(F.col("u").alias("node"), F.col("v").alias("part"))
        further = _prefix_pairs(sets.filter("crowded"), component, least)
        root = roots(root.unionByName(_confirmed(settled(further), sets, least)))
    # Members of a group and its id meet last, by an outer join: who does not ask for the id
    # spares that join.
    rooted = rows.select("node", "doc_id", *carry).join(root.select(F.col("u").alias("node"), "v"), "node", "left")
    rooted = rooted.select("doc_id", *carry, F.coalesce("v", "node").alias("group"))
    ids = rooted.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(ids, "group", "left").select("doc_id", *carry, "component_id", "group")
