"""Near-duplicate detection by min-max hashing.

A text's set is that of its word shingles, as 64-bit hashes. Every permutation gives two
signature values, the smallest and the largest hash under it, so a signature costs half the
hash evaluations of one that keeps the smallest alone. Bands of signature values bring
together texts that may be similar, and every link is confirmed on the full sets.

How it stays linear in a group of copies:

1. Texts with equal sets form one class, found by the set's 128-bit fingerprint; only
   classes go on.
2. In each band bucket every class is compared with one of its members, the hub: the one
   that meets most others over all buckets. Confirmed links are joined into components.
3. A bucket whose classes are still in several components holds pairs that no link explains
   yet. The classes of such buckets with one hub are a family; what most of them share is its
   consensus, and each is described by its delta, the elements in which it differs from the
   consensus. How many elements two deltas must share for their classes to be similar follows
   from the sizes alone. Two classes for which that is none are similar for certain; those are
   linked to the class nearest to the consensus. Any other similar pair shares an element of
   both deltas early enough in an order from rare to common, and only pairs that do are
   compared. In a family of near copies the deltas are small and mostly their own, so few are.

Nothing is capped: after this every two classes that share a bucket are in one component, or
have been compared, or cannot be similar.

At a similarity of exactly 0.8, 32 bands of 4 values miss a pair with a chance of 5e-8, and
of 6e-7 if the sets have no more than five elements.

Defined cases: letters A-Z are lower-cased and words are runs without ASCII white space; a
text of fewer words than a shingle is one shingle; a null text or one without words has an
empty set and is linked with nothing. A document without an id takes part in links, but a
component is named by the smallest id in it (null if there is none, and then it keeps all its
rows). Repeated rows are copies of each other. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import by_place, kept, pick, ship

SHINGLE_WORDS = 5
MIN_PERCENT = 80
BANDS = 32
#: Permutations of a band; each gives two of its values.
BAND_PERMUTATIONS = 2
#: Shingles hashed at once, so that a very long text needs no more memory than others.
PIECE = 4096

_U = np.uint64
SKETCH = "doc_id long, text_key long, n_shingles long, fingerprint binary, bands array<long>"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, _U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), _U, len(tokens))
    width = min(words, len(tokens))
    shingles = np.full(len(tokens) - width + 1, width, _U)
    for k in range(width):
        shingles = _mix(shingles) + hashes[k : len(tokens) - width + 1 + k]
    return np.unique(_mix(shingles))


class MinMax:
    """Min-max signatures in bands."""

    def __init__(self, bands: int = BANDS, permutations: int = BAND_PERMUTATIONS, seed: int = 11):
        random = np.random.default_rng(seed)
        count = bands * permutations
        self.shape = bands, 2 * permutations
        self.factors = random.integers(0, 2**63, (count, 1), np.uint64) * _U(2) + _U(1)
        self.offsets = random.integers(0, 2**63, (count, 1), np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The smallest and the largest hash under each permutation, side by side."""
        low = np.full(len(self.factors), np.iinfo(_U).max, _U)
        high = np.zeros(len(self.factors), _U)
        for start in range(0, len(hashes), PIECE):
            permuted = hashes[None, start : start + PIECE] * self.factors + self.offsets
            np.minimum(low, permuted.min(axis=1), out=low)
            np.maximum(high, permuted.max(axis=1), out=high)
        return np.column_stack([low, high])

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        """One key for each band."""
        values = self.signature(hashes).reshape(self.shape)
        keys = np.arange(1, len(values) + 1, dtype=_U)
        for column in values.T:
            keys = _mix(keys) + column
        return _mix(keys).view(np.int64)


def text_key() -> Column:
    """With the id, what a document is found again by."""
    return F.xxhash64("text")


def sketches(documents: DataFrame, words: int, bands: int = BANDS) -> DataFrame:
    """For each document its id and key, the size and fingerprint of its set, its band keys."""
    ship(documents.sparkSession)

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        minmax = MinMax(bands)
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "text_key": batch["text_key"],
                    "n_shingles": [len(s) for s in sets],
                    "fingerprint": [
                        xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets
                    ],
                    "bands": [minmax.bands(s) if len(s) else [] for s in sets],
                }
            )

    return (
        pick(documents, "doc_id", "text")
        .select(F.col("doc_id").cast("long"), "text", text_key().alias("text_key"))
        .mapInPandas(sketched, SKETCH)
    )


def _classes(sketched: DataFrame) -> DataFrame:
    """One row for each set: ``node``, its smallest id, and the document that stands for it."""
    return (
        sketched.where(F.col("n_shingles") > 0)
        .groupBy("fingerprint")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.min(F.struct("doc_id", "text_key")).alias("stand_in"),
            F.first("bands").alias("bands"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )


def _sets(nodes: DataFrame, wanted: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """The full sets (sorted arrays) of the wanted nodes: only their texts are read again."""
    texts = pick(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc"), "text", text_key().alias("key")
    )
    wanted = nodes.select("node", "stand_in").join(wanted, "node")
    found = texts.join(
        wanted,
        F.col("doc").eqNullSafe(F.col("stand_in.doc_id")) & (F.col("key") == F.col("stand_in.text_key")),
    )

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.sort(shingle_set(text, words).view(np.int64)) for text in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "hashes": sets})

    return (
        found.select("node", "text")
        .mapInPandas(sets_of, "node long, hashes array<long>")
        .groupBy("node")  # repeated rows of one document give the same set again
        .agg(F.first("hashes").alias("hashes"))
    )


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which elements of the sorted ``a`` are in the sorted ``b``."""
    if not len(b):
        return np.zeros(len(a), bool)
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough."""

    @F.pandas_udf(T.BooleanType())
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(left, right, strict=True):
            both = int(_shared(a, b).sum())
            out.append(100 * both >= MIN_PERCENT * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    a = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    b = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))
    return pairs.join(a, "a").join(b, "b").where(similar("hashes_a", "hashes_b")).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of the edges
    (a, b). Alternating large-star and small-star steps: every step replaces a node's links
    by links to its smallest neighbour, until only stars are left. What is joined by node is
    written first, so that adaptive execution splits a node with very many links.
    """
    edges = kept(_downward(edges), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("least")).select(
            "a", F.least("a", "least").alias("least")
        )
        nearest = kept(nearest, "nearest")
        large = _downward(
            both.where("b > a").join(nearest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        )
        large = kept(large, "large")
        nearest = kept(large.groupBy("a").agg(F.min("b").alias("least")), "nearest")
        small = large.join(nearest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = kept(_downward(small.unionByName(nearest.toDF("a", "b"))), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _meetings(nodes: DataFrame) -> DataFrame:
    """``node`` and ``key`` of all buckets with more than one node, and each bucket's ``hub``.

    What is joined by key or hub is written first: of two written tables adaptive execution
    splits a hot bucket, of an aggregate it would not.
    """
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("nodes")).where("nodes > 1")
    sizes = kept(sizes, "sizes")
    met = kept(buckets.join(sizes, "key"), "buckets")
    score = met.groupBy("node").agg(F.sum("nodes").alias("score"))
    hubs = (
        met.join(score, "node")
        .groupBy("key")
        .agg(F.max(F.struct("score", "node")).getField("node").alias("hub"))
    )
    return met.join(kept(hubs, "hubs"), "key")


def _pair(rows: DataFrame, one: str, other: str) -> DataFrame:
    return rows.select(
        F.least(one, other).alias("a"), F.greatest(one, other).alias("b")
    ).distinct()


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _families(met: DataFrame, roots: DataFrame) -> DataFrame:
    """(``hub``, ``node``) of the buckets that hold pairs no component explains. In a bucket
    of two the pair has been compared."""
    open_keys = (
        _rooted(met, roots)
        .groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.first("nodes").alias("nodes"))
        .where("low < high and nodes > 2")
        .select("key")
    )
    return met.join(kept(open_keys, "open"), "key").select("hub", "node").distinct()


DELTA = "hub long, node long, closeness long, delta array<long>"


def _deltas(families: DataFrame, sets: DataFrame) -> DataFrame:
    """Each member's delta from its family's consensus, and its closeness to it.

    With c the consensus, x and z two sets and s the number of elements their deltas share,
    |x & z| = |x & c| + |z & c| - |c| + s. So 100 |x & z| >= 80 |x or z|, which is
    18 |x & z| >= 8 (|x| + |z|), reads 18 s >= -(closeness of x + closeness of z) with
    closeness = 18 |x & c| - 8 |x| - 9 |c|.
    """
    size = kept(families.groupBy("hub").agg(F.count("*").alias("size")), "sizes")
    members = families.join(size, "hub").join(sets, "node")
    consensus = (
        members.select("hub", "size", F.explode("hashes").alias("element"))
        .groupBy("hub", "element")
        .agg(F.count("*").alias("times"), F.first("size").alias("size"))
        .where("2 * times > size")  # at most twice as many as the family's mean set has
        .groupBy("hub")
        .agg(F.array_sort(F.collect_list("element")).alias("consensus"))
    )
    consensus = kept(consensus, "consensus")

    def deltas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            closeness, apart = [], []
            for own, common in zip(batch["hashes"], batch["consensus"], strict=True):
                common = np.empty(0, np.int64) if common is None else common
                shared = _shared(own, common)
                closeness.append(18 * int(shared.sum()) - 8 * len(own) - 9 * len(common))
                apart.append(np.concatenate([own[~shared], common[~_shared(common, own)]]))
            yield pd.DataFrame(
                {"hub": batch["hub"], "node": batch["node"], "closeness": closeness, "delta": apart}
            )

    return members.join(consensus, "hub", "left").select("hub", "node", "hashes", "consensus").mapInPandas(deltas, DELTA)


def _nearest(deltas: DataFrame) -> DataFrame:
    """Of each family the member closest to the consensus."""
    top = deltas.groupBy("hub").agg(F.max(F.struct("closeness", "node")).alias("top"))
    return top.select("hub", F.col("top.node").alias("top"), F.col("top.closeness").alias("top_closeness"))


def _candidates(deltas: DataFrame, tops: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of different components whose deltas may share enough elements.

    Elements are taken from rare to common. Two deltas that share enough share one with as
    many elements from it on, in both, as they must share.
    """
    elements = _rooted(deltas, roots).select(
        "hub", "node", "root", "closeness", F.size("delta").alias("size"), F.explode("delta").alias("element")
    )
    times = kept(elements.groupBy("hub", "element").agg(F.count("*").alias("times")), "times")
    by_rarity = Window.partitionBy("hub", "node").orderBy("times", "element")
    placed = (
        elements.join(times, ["hub", "element"])
        .withColumn("rest", F.col("size") - F.row_number().over(by_rarity) + 1)
        .where("times > 1")
        .join(tops, "hub")
        # A member close to the top needs no partner but the top unless that is far off.
        .withColumn("far", F.col("closeness") + F.col("top_closeness") < 0)
        .where("18 * rest >= if(far, -closeness - top_closeness, top_closeness + 1 - closeness)")
        .select("hub", "element", "node", "root", "closeness", "rest", "far")
    )
    placed = kept(placed, "placed")
    far = placed.where("far").select(
        "hub", "element", F.col("node").alias("one"), F.col("root").alias("one_root"),
        F.col("closeness").alias("one_closeness"), F.col("rest").alias("one_rest"),
    )
    return _pair(
        far.join(placed, ["hub", "element"])
        .where("one_root <> root and (not far or one < node)")
        .where("18 * least(rest, one_rest) >= -(closeness + one_closeness)"),
        "one", "node",
    )


def _components_of_sets(nodes: DataFrame, documents: DataFrame, words: int) -> DataFrame:
    """``node`` and ``root`` of all nodes that are linked with another."""
    met = kept(_meetings(nodes), "meetings")
    sets = kept(_sets(nodes, met.select("node").distinct(), documents, words), "sets")
    tried = kept(_pair(met.where("node <> hub"), "node", "hub"), "pairs")
    links = kept(_linked(tried, sets), "links")
    roots = kept(components(links), "roots")

    deltas = kept(_deltas(_families(met, roots), sets), "deltas")
    tops = kept(_nearest(deltas), "tops")
    certain = _pair(
        deltas.join(tops, "hub").where("node <> top and closeness + top_closeness >= 0"), "node", "top"
    )
    links = kept(links.unionByName(certain).distinct(), "links")
    roots = kept(components(links), "roots")
    rest = kept(_candidates(deltas, tops, roots).join(tried, ["a", "b"], "left_anti"), "pairs")
    more = kept(_linked(rest, sets), "links")
    return roots if more.isEmpty() else components(links.unionByName(more))


def near_duplicates(
    documents: DataFrame, words: int = SHINGLE_WORDS, bands: int = BANDS
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` and ``kept`` of every
    document: the smallest id of its component, and whether that is its own."""
    sketched = kept(sketches(documents, words, bands), "sketches")
    nodes = kept(_classes(sketched), "classes")
    roots = _components_of_sets(nodes, documents, words)
    named = kept(
        nodes.select("node", "fingerprint", "first_doc")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "named",
    )
    names = kept(named.groupBy("root").agg(F.min("first_doc").alias("component_id")), "names")
    of_set = named.join(names, "root").select("fingerprint", "component_id")
    return (
        sketched.select("doc_id", "text_key", "n_shingles", "fingerprint")
        .join(of_set, "fingerprint", "left")
        .select(
            "doc_id", "text_key", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_duplicates(documents: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents, all columns as they are, with one row left of each component."""
    judged = kept(near_duplicates(documents, words), "judged")
    plain, places = by_place(documents, "doc_id", "text")
    keyed = plain.withColumns(
        {"id": F.col(places[0]).cast("long"), "key": F.xxhash64(places[1])}
    )

    def matches(rows: DataFrame) -> Column:
        return F.col("id").eqNullSafe(rows["doc_id"]) & (F.col("key") == rows["text_key"])

    dropped = judged.where(~F.col("kept")).select("doc_id", "text_key").distinct()
    repeated = (
        judged.where(F.col("kept") & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("doc_id", "text_key").agg(F.count("*").alias("times")).where("times > 1")
        .select("doc_id", "text_key")
    )
    left = keyed.join(dropped, matches(dropped), "left_anti")
    if not repeated.isEmpty():
        once = Window.partitionBy("id", "key").orderBy("id")
        again = left.join(repeated, matches(repeated), "left_semi")
        left = left.join(repeated, matches(repeated), "left_anti").unionByName(
            again.withColumn("time", F.row_number().over(once)).where("time = 1").drop("time")
        )
    return left.drop("id", "key").toDF(*documents.columns)
