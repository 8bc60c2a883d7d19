"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard.

A document's set is its distinct word shingles, hashed to 64 bits.  Circulant
MinHash needs two permutations of a universe of D places: the first scatters
the shingles, the second is shifted circularly by k for coordinate k, so
coordinate k is the minimum over the set of pi[(sigma + k) mod D].  Signatures
are cut into bands; documents that agree in a band are candidates, and a link
needs intersection >= threshold * union on the full sets.

Groups of copies do not multiply: documents with one set are one class, a
bucket of a band first compares its members with its smallest class only (one
pair each), and buckets that still hold several components afterwards are
compared in blocks of bounded size inside tasks, which skip pairs already
connected and return spanning links.  Every pair of different classes that
shares a band is therefore either connected or compared; nothing is capped.

Defined cases: a null or empty text, or one without words, has the empty set
and is linked with nothing; a text with fewer words than a shingle has its
whole word sequence as its only shingle; rows that repeat an id are one
document if their texts agree and are otherwise each returned; a null
``doc_id`` is never the smallest id of a group that has another; an empty table
gives no rows; other columns are passed through by ``keep_one`` and otherwise
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blank, join_groups, raw, same, saved, slices

UNIVERSE = 1 << 22
BANDS, ROWS = 32, 4          # a pair at Jaccard 0.8 misses every band once in 2e7
SEED = 20240611
MEMO = 150_000
BLOCK = 100_000              # shingles of a block of a bucket
BIG = np.uint64(0x9E3779B97F4A7C15)


# -- sets and signatures ----------------------------------------------------

class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO:
            self.clear()
        if len(word) <= 64:
            self[word] = got
        return got


@lru_cache(maxsize=1)
def _word_hash() -> _WordHash:
    return _WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one whole text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hash().__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, np.uint64(min(size, len(h))))
    for k in range(min(size, len(h))):
        out = _mix(out * BIG + h[k:k + n])
    return np.unique(out)


@lru_cache(maxsize=2)
def circulant(coordinates: int) -> np.ndarray:
    """Row i holds pi[i], pi[i+1], ... of the second permutation, circularly:
    the values of element i under every shift, side by side."""
    pi = np.random.default_rng(SEED).permutation(UNIVERSE).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:coordinates - 1]]), coordinates)


def signature(s: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of a non-empty set.  The first permutation is a
    bijection of the 64-bit shingles whose top bits name the place."""
    table = circulant(coordinates)
    place = (_mix(s + np.uint64(SEED)) >> np.uint64(64 - 22)).astype(np.int64)
    low = table[place[:2048]].min(axis=0)
    for k in range(2048, len(place), 2048):
        np.minimum(low, table[place[k:k + 2048]].min(axis=0), out=low)
    return low


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different bands never sharing a key by design."""
    part = sig[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = _mix(key * BIG + part[:, k])
    return key.view(np.int64)


def describe(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, n, set_id, bands) per row; the set id is a 128-bit
    digest of the sorted set, null for the empty set."""
    id_field = docs.schema["doc_id"]
    schema = T.StructType([
        T.StructField("doc_id", id_field.dataType), T.StructField("text_hash", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("set_id", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            n, ids, keys = [], [], []
            for t in b.column("raw").to_pylist():
                s = shingles(t, size)
                n.append(len(s))
                if len(s):
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    keys.append(band_keys(signature(s, bands * rows), bands, rows))
                else:
                    ids.append(None)
                    keys.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(n, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                schema.fieldNames())

    return docs.select("doc_id", F.xxhash64(blank("text")).alias("text_hash"),
                       raw("text").alias("raw")).mapInArrow(run, schema)


# -- exact links ------------------------------------------------------------

def _linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def verify(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            keep = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold)
                    for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(
        run, "a BIGINT, b BIGINT")


def block_links(rows: pd.DataFrame, threshold: int) -> list[tuple[int, int]]:
    """Spanning links among the members of one block or pair of blocks.
    ``comp`` tells what is connected already, ``side`` (0, 1) the block; within
    a pair of blocks only members of different sides are compared."""
    sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
    flat, place = np.unique(np.concatenate(sets), return_inverse=True)
    size = np.array([len(s) for s in sets])
    starts = np.r_[0, size.cumsum()[:-1]]
    side, nodes = rows["side"].to_numpy(), rows["node"].to_numpy()
    _, group = np.unique(rows["comp"].to_numpy(), return_inverse=True)
    two = len(set(side)) > 1
    mark, out = np.zeros(len(flat), bool), []
    for i in range(len(sets)):
        open_ = (group != group[i]) & (np.arange(len(sets)) > i)
        open_ &= (100 * np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i]))
        if two:
            open_ &= side != side[i]
        if not open_.any():
            continue
        own = place[starts[i]:starts[i] + size[i]]
        mark[own] = True
        both = np.add.reduceat(mark[place], starts)
        mark[own] = False
        near = open_ & (100 * both >= threshold * (size + size[i] - both))
        for j in np.flatnonzero(near):
            if group[j] != group[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                group[group == group[j]] = group[i]
    return out


# -- components -------------------------------------------------------------

def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) of every linked node: the smallest node it can reach.

    Every round each node takes the least label among its neighbours' labels,
    then the label's label; the labels and the edges between different labels
    are written down per round, so lineage stays short and every round works on
    contracted edges only."""
    edges = saved(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name + "-edges")
    labels = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Hang every node under its least neighbour (or itself), then jump to
        # the roots of these trees.
        parent = saved(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p"))
                       .select(F.col("a").alias("node"), "p"), name + "-parents")
        while True:
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            jumped = saved(parent.join(up, "p").select("node", F.col("pp").alias("p"),
                                                       (F.col("p") != F.col("pp")).alias("moved")),
                           name + "-parents")
            parent = jumped.select("node", "p")
            if not jumped.filter("moved").limit(1).count():
                break
        if labels is None:
            labels = parent.select("node", F.col("p").alias("comp"))
        else:
            up = parent.select(F.col("node").alias("comp"), "p")
            labels = saved(labels.join(up, "comp", "left").select(
                "node", F.coalesce("p", "comp").alias("comp")), name + "-labels")
        low = parent.select(F.col("node").alias("a"), F.col("p").alias("ra"))
        high = parent.select(F.col("node").alias("b"), F.col("p").alias("rb"))
        edges = saved(edges.join(low, "a").join(high, "b").filter("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), name + "-edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0)
    return labels


# -- the operator -----------------------------------------------------------

def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id) per row."""
    seen = saved(describe(docs, size, bands, rows), "signatures")
    full = seen.filter("n > 0")
    # One class per distinct set, with a written (hence fixed) number.
    classes = saved(full.groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("any"), F.min("doc_id").alias("least"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("node"), "set_id", "least",
                F.col("any.doc_id").alias("any_id"), F.col("any.text_hash").alias("any_hash"),
                "n", "bands"), "classes")
    banded = classes.select("node", "n", F.explode("bands").alias("key"))
    heads = saved(banded.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"),
                                            F.count(F.lit(1)).alias("members")).filter("members > 1"), "heads")
    shared = saved(join_groups(banded, heads, "key", "members", bands * classes.count()).select(
        "key", "node", "n", "members", F.col("head.node").alias("head"), F.col("head.n").alias("head_n")),
        "buckets")
    pairs = saved(shared.filter(
        (F.col("node") != F.col("head"))
        & (100 * F.least("n", "head_n") >= threshold * F.greatest("n", "head_n")))
        .select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    # Full sets of the classes that share a bucket, from one document each.
    wanted = shared.select("node").distinct().join(classes, "node").select("node", "any_id", "any_hash")
    own = docs.select(F.col("doc_id").alias("__id"), F.xxhash64(blank("text")).alias("__hash"),
                      raw("text").alias("raw"))
    texts = own.join(wanted, same(own["__id"], wanted["any_id"]) & (own["__hash"] == wanted["any_hash"]))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            s = [shingles(t, size).tobytes() for t in b.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(s, pa.binary())],
                                             ["node", "shingles"])

    sets = saved(texts.select("node", "raw").mapInArrow(build, "node BIGINT, shingles BINARY")
                 .dropDuplicates(["node"]), "sets")
    links = saved(verify(pairs, sets, threshold), "links")
    comps = components(links, "first")
    links = links.unionByName(saved(_rest(shared, comps, sets, threshold), "rest-links"))
    comps = components(links, "groups")
    member = classes.select("set_id", "node", "least").join(comps, "node", "left").select(
        "set_id", "least", F.coalesce("comp", "node").alias("comp"))
    lowest = member.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = saved(member.join(lowest, "comp").select("set_id", "component_id"), "members")
    return seen.join(named, "set_id", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def _rest(shared: DataFrame, comps: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links among buckets of three and more members that are not yet one
    component: pairs with the head are decided, all others are compared in
    blocks."""
    known = saved(shared.filter("members > 2").join(comps, "node", "left").select(
        "key", "node", "n", "members", F.coalesce("comp", "node").alias("comp")), "known")
    torn = known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.sum("n").alias("weight"),
                                    F.first("members").alias("members")).filter("x <> y")
    blocks = saved(torn.select("key", "members", F.ceil(F.col("weight") / BLOCK).cast("int").alias("blocks")), "torn")
    members = join_groups(known.drop("members"), blocks, "key", "members", known.count()).select(
        "key", "node", "comp", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    # A member meets every block: its own once, and each other as one side.
    meetings = members.select("key", "node", "comp", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
            F.least("block", o).alias("i"), F.greatest("block", o).alias("j"),
            F.when(F.col("block") <= o, 0).otherwise(1).alias("side")))).alias("m")).select(
        "key", "node", "comp", "m.*")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(block_links(rows, threshold), columns=["a", "b"], dtype="int64")

    return (meetings.join(sets, "node").groupBy("key", "i", "j")
            .applyInPandas(compare, "a BIGINT, b BIGINT"))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs`` without those that another document of their group
    stands for; the document with the smallest id stays."""
    found = near_duplicates(docs, size, threshold).filter(
        ~same(F.col("doc_id"), F.col("component_id"))).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    gone = saved(found, "dropped")
    own = docs.withColumn("__own", F.xxhash64(blank("text")))
    return own.join(gone, same(own["doc_id"], gone["__id"]) & (own["__own"] == gone["__hash"]),
                    "left_anti").select(*docs.columns)
