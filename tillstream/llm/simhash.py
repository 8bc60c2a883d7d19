"""SimHash near-duplicates through tables of distances to reference fingerprints.

The Hamming distance of a fingerprint to a fixed reference fingerprint is a
coordinate; by the triangle inequality two fingerprints are at least as far
apart as their coordinates differ.  Each of the ``REFERENCES`` coordinates is
kept by part of the fingerprint (``PARTS`` parts of its bits), where the same
inequality holds, so for every pair

    distance >= sum over parts of the greatest coordinate difference there.

A pair at ``distance`` or less therefore has all coordinates equal in at least
``PARTS - distance`` parts: pairs that share the distance rows of so many parts
meet in an equi-join, are discarded by their coordinate differences, and only
the survivors' fingerprints are compared.

Copies do not multiply: documents of one fingerprint are one class, a bucket of
classes is first compared with its least class only, and buckets that still
hold several components are compared in blocks of bounded size inside tasks,
which return spanning links.  Nothing is capped.

Defined cases: a null or empty text, or one without words, has fingerprint zero
and is linked like any other; rows that repeat an id are each returned, and a
null ``doc_id`` is never the smallest id of a group that has another; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_groups, raw, saved, slices
from .near_dup import components

SIZE, DISTANCE = 4, 4
HASH_SEED = 42
REFERENCES, PARTS = 16, 6
SEED = 20240917
BLOCK = 4096                 # classes of one bucket that are compared at a time
SMALL = 64                   # buckets up to this size are compared side by side


# -- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes, size: int = SIZE) -> int:
    """64 bits: each is the majority of that bit over the shingles' XXH64."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(size, len(words))
    last = ends[k - 1:].tolist()
    first = [0, *(ends[:len(words) - k] + 1).tolist()]
    h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in zip(first, last)),
                    np.uint64, len(first))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, fingerprint) per row, the bits as a signed 64-bit integer."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            f = np.array([fingerprint(t, size) for t in b.column("raw").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(f.view(np.int64))],
                                             schema.fieldNames())

    return docs.select("doc_id", raw("text").alias("raw")).mapInArrow(run, schema)


# -- distance tables --------------------------------------------------------

def _bits() -> list[tuple[int, int]]:
    """(shift, width) of the parts of 64 bits."""
    cuts = [64 * k // PARTS for k in range(PARTS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=1)
def tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """Per part the distances of each of its values to the references' parts,
    and the number of the value's distance row among the different rows."""
    references = np.random.default_rng(SEED).integers(0, 2 ** 64, REFERENCES, dtype=np.uint64)
    out = []
    for shift, width in _bits():
        values = np.arange(1 << width, dtype=np.uint64)
        own = (references >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        distance = np.bitwise_count(values[:, None] ^ own[None, :]).astype(np.int8)
        _, row = np.unique(distance, axis=0, return_inverse=True)
        out.append((distance, row.reshape(-1).astype(np.int64)))
    return out


def _values(f: np.ndarray) -> list[np.ndarray]:
    u = f.view(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in _bits()]


def bucket_keys(f: np.ndarray, distance: int) -> np.ndarray:
    """One key per choice of ``PARTS - distance`` parts: the choice and the
    numbers of the distance rows there (exact, not hashed)."""
    rows = [t[1][v] for t, v in zip(tables(), _values(f))]
    keys = []
    for k, parts in enumerate(combinations(range(PARTS), PARTS - distance)):
        key = np.full(len(f), k, np.int64)
        for p in parts:
            key = (key << 11) | rows[p]
        keys.append(key)
    return np.stack(keys, axis=1)


def near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs (a[i], b[i]) are within ``distance``: those whose coordinates
    differ by more are discarded, the others' fingerprints decide."""
    bound = np.zeros(len(a), np.int64)
    for (table, _), x, y in zip(tables(), _values(a), _values(b)):
        bound += np.abs(table[x] - table[y]).max(axis=1, initial=0)
    keep = bound <= distance
    keep[keep] = np.bitwise_count(a[keep].view(np.uint64) ^ b[keep].view(np.uint64)) <= distance
    return keep


# -- links ------------------------------------------------------------------

def _head_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = (b.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
        yield b.filter(pa.array(near(x, y, distance), pa.bool_()))


def _root(parent: dict, x: int) -> int:
    while (up := parent.get(x, x)) != x:
        parent[x] = parent.get(up, up)
        x = up
    return x


def _span(pairs, comp: np.ndarray, parent: dict) -> list[int]:
    """Numbers of those pairs of rows that join two components so far."""
    out = []
    for k, (i, j) in enumerate(pairs):
        x, y = _root(parent, int(comp[i])), _root(parent, int(comp[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(k)
    return out


def group_links(group: np.ndarray, node: np.ndarray, comp: np.ndarray, side: np.ndarray,
                distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between different components within each run of equal
    ``group``.  ``side`` is -1, or 0 and 1 where only rows of different sides are
    to be compared."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    size = np.diff(np.r_[starts, len(group)])
    a, b = [], []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        open_ = (comp[i] != comp[j]) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[open_], j[open_]
        hit = near(node[i], node[j], distance)
        a.append(i[hit])
        b.append(j[hit])

    # Small groups: every row with the row k places on, all groups at once.
    left = np.repeat(size, size) - (np.arange(len(group)) - np.repeat(starts, size)) - 1
    small = np.repeat(size, size) <= SMALL
    for k in range(1, min(SMALL, int(size.max(initial=0)))):
        i = np.flatnonzero(small & (left >= k))
        if not len(i):
            break
        add(i, i + k)
    i, j = (np.concatenate([np.zeros(0, np.int64), *v]).astype(np.int64) for v in (a, b))
    # Links of different groups may join the same components; one of each is enough.
    spanning = _span(zip(i.tolist(), j.tolist()), comp, {})
    out = [(i[spanning], j[spanning])]
    # Large groups: a row outside the largest component with all others.
    for s, n in zip(starts[size > SMALL], size[size > SMALL]):
        c = comp[s:s + n].copy()
        names, label, many = np.unique(c, return_inverse=True, return_counts=True)
        for r in np.flatnonzero(label.reshape(-1) != many.argmax()):
            other = np.flatnonzero((c != c[r]) & ((side[s + r] < 0) | (side[s:s + n] != side[s + r])))
            hit = other[near(np.full(len(other), node[s + r]), node[s + other], distance)]
            # One link for each component met; it takes this row's name.
            _, one = np.unique(c[hit], return_index=True)
            out.append((np.full(len(one), s + r), s + hit[one]))
            c[np.isin(c, c[hit])] = c[r]
    i, j = (np.concatenate(v).astype(np.int64) for v in zip(*out))
    return node[i], node[j]


def _block_links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of the groups of a partition sorted by (key, i, j); a group is at
    most two blocks long, and only the last one of a batch is carried on."""
    held = None

    def links(t: pa.Table) -> pa.RecordBatch:
        key, i, j, node, comp, side = (t.column(c).to_numpy() for c in ("key", "i", "j", "node", "comp", "side"))
        new = np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        a, b = group_links(new.cumsum(), node, comp, np.where(i == j, -1, side), distance)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = t if held is None else pa.concat_tables([held, t])
        key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
        inside = (key == key[-1]) & (i == i[-1]) & (j == j[-1])
        cut = t.num_rows - int(inside.sum())
        held = t.slice(cut)
        if cut:
            yield links(t.slice(0, cut))
    if held is not None and held.num_rows:
        yield links(held)


def _rest(shared: DataFrame, comps: DataFrame, distance: int) -> DataFrame:
    """Links of the buckets of three and more classes that are not yet one
    component; the pairs with the least class are decided."""
    known = saved(shared.filter("members > 2").join(comps, "node", "left").select(
        "key", "node", "members", F.coalesce("comp", "node").alias("comp")), "simhash-known")
    torn = saved(known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                          F.first("members").alias("members"))
                 .filter("x <> y").select("key", "members"), "simhash-torn")
    open_ = join_groups(known.drop("members"), torn, "key", "members", known.count()).withColumn(
        "blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    # A class meets every block: its own once, and each other as one side.
    meetings = open_.select("key", "node", "comp", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
            F.least("block", o).alias("i"), F.greatest("block", o).alias("j"),
            F.when(F.col("block") <= o, 0).otherwise(1).alias("side")))).alias("m")).select(
        "key", "node", "comp", "m.*")
    return (meetings.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(lambda b: _block_links(b, distance), "a BIGINT, b BIGINT"))


# -- the operator -----------------------------------------------------------

def near_duplicates(docs: DataFrame, size: int = SIZE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row; the fingerprint as a signed
    64-bit integer.  ``distance`` must be below ``PARTS``."""
    if not 0 <= distance < PARTS:
        raise ValueError(f"distance {distance} is not below {PARTS}")
    seen = saved(fingerprints(docs, size), "fingerprints")
    classes = saved(seen.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-classes")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.column("fingerprint").to_numpy(zero_copy_only=False)
            keys = bucket_keys(f, distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1)), pa.array(np.repeat(f, keys.shape[1]))], ["key", "node"])

    placed = classes.select("fingerprint").mapInArrow(spread, "key BIGINT, node BIGINT")
    heads = saved(placed.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members"))
                  .filter("members > 1"), "simhash-heads")
    shared = saved(join_groups(placed, heads, "key", "members", comb(PARTS, distance) * classes.count()),
                   "simhash-buckets")
    pairs = shared.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = saved(pairs.mapInArrow(lambda b: _head_links(b, distance), "a BIGINT, b BIGINT"), "simhash-links")
    rest = saved(_rest(shared, components(links, "simhash-first"), distance), "simhash-rest")
    comps = components(links.unionByName(rest), "simhash-groups")
    member = classes.join(comps, classes["fingerprint"] == comps["node"], "left").select(
        "fingerprint", "least", F.coalesce("comp", "fingerprint").alias("comp"))
    lowest = member.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = saved(member.join(lowest, "comp").select("fingerprint", "component_id"), "simhash-members")
    return seen.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
