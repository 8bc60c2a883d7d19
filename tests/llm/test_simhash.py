import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import awkward
from tillstream.llm import simhash
from tillstream.llm.queries import op12_simhash_near_dup


def _fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 3)
    h = [xxhash.xxh64_intdigest(" ".join(words[k:k + 4]).encode(), 42) for k in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def _components(prints, distance=4):
    """Root of every distinct fingerprint, all pairs compared."""
    f = np.array(sorted(set(prints)), np.uint64)
    root = np.arange(len(f))
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= distance):
            root[root == root[j]] = root[i]
    return {int(x): int(r) for x, r in zip(f, root)}


def _brute(texts):
    prints = [_fingerprint(t) for _, t in texts]
    root = _components(prints)
    least = {}
    for (i, _), p in zip(texts, prints):
        r = root[p]
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
    return sorted(((i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(texts, prints)),
                  key=lambda t: tuple(map(str, t)))


def _run(docs):
    return rows(simhash.near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component_id"))


def test_rows_of_the_tables_tell_all_values_apart():
    for table, row in simhash.tables():
        assert len(set(row.tolist())) == len(table)
    assert sum(w for _, w in simhash._bits()) == 64


def test_coordinates_never_discard_a_near_pair():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 64, 4000, dtype=np.uint64)
    flips = rng.integers(0, 9, 4000)
    b = a.copy()
    for k, n in enumerate(flips):
        for bit in rng.choice(64, n, replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    got = simhash.near(a.view(np.int64), b.view(np.int64), 4)
    assert (got == (flips <= 4)).all()
    shared = (simhash.bucket_keys(a.view(np.int64), 4) == simhash.bucket_keys(b.view(np.int64), 4)).any(axis=1)
    assert shared[flips <= 4].all()


def test_awkward_documents_equal_brute_force(make):
    texts = [(i, t) for i, t, *_ in awkward()]
    assert _run(make(awkward())) == _brute(texts)
    assert _run(make([])) == []


def test_near_copies_equal_brute_force(make):
    rng = np.random.default_rng(2)
    texts, k = [], 0
    for base in range(12):
        words = [f"w{x}" for x in rng.integers(0, 3000, 300)]
        for copy in range(25):
            own = list(words)
            for at in rng.integers(0, 300, copy % 4):
                own[at] = f"z{k}"
            texts.append((k, " ".join(own)))
            k += 1
    got = _run(make(texts))
    assert got == _brute(texts)
    assert len({r[2] for r in got}) < 150


def test_hot_buckets_in_blocks(spark, make, monkeypatch):
    """Thousands of near fingerprints that share buckets, compared in blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 60)
    monkeypatch.setattr(simhash, "SMALL", 8)
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2 ** 64, 5, dtype=np.uint64)
    chain = set()
    for x in a:
        for _ in range(120):
            y = x
            for bit in rng.choice(24, rng.integers(0, 7), replace=False):   # equal in the upper parts
                y ^= np.uint64(1) << np.uint64(bit)
            chain.add(int(y))
    f = sorted(chain)
    docs = spark.createDataFrame([(k, int(np.uint64(x).view(np.int64))) for k, x in enumerate(f)],
                                 "doc_id BIGINT, fingerprint BIGINT")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, size: docs)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    root, least = _components(f), {}
    for k, x in enumerate(f):
        least.setdefault(root[x], k)
    assert got == {k: least[root[x]] for k, x in enumerate(f)}


def test_group_links_in_memory():
    rng = np.random.default_rng(6)
    node = (rng.integers(0, 2 ** 64, 30, dtype=np.uint64)[rng.integers(0, 30, 900)]
            ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))).view(np.int64)
    node = np.unique(node)
    group = np.sort(rng.integers(0, 6, len(node)))
    a, b = simhash.group_links(group, node, node.copy(), np.full(len(node), -1), 4)
    assert (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= 4).all()
    for g in range(6):
        own = node[group == g]
        want = _components([int(x) for x in own.view(np.uint64)])
        root = {int(x): int(x) for x in own}

        def up(x):
            while root[x] != x:
                x = root[x]
            return x
        for x, y in zip(a.tolist(), b.tolist()):
            if x in root and y in root:
                root[up(x)] = up(y)
        assert len({up(int(x)) for x in own}) == len(set(want.values()))


def test_distance_must_be_below_the_parts(make):
    with pytest.raises(ValueError):
        simhash.near_duplicates(make([(1, "a")]), distance=6)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows(op12_simhash_near_dup(spark, sf)) == _brute(texts)
