import random

from tests.llm.conftest import awkward
from tillstream.llm import near_dup


def sets_of(t, size):
    w = (t or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(zip(*[w[k:] for k in range(size)]))


def brute(rows, size, threshold=80):
    sets = [sets_of(t, size) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                group[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(words, rng, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def family(rng, n_words, copies, edits, first):
    base = [f"v{rng.randrange(5000)}" for _ in range(n_words)]
    return [(first + k, edited(base, rng, rng.randrange(edits + 1))) for k in range(copies)]


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for f in range(25):
        rows += family(rng, rng.randrange(8, 150), rng.randrange(1, 7), rng.randrange(0, 9), 100 * f)
    rows += family(rng, 60, 60, 6, 10_000)         # a large group near the threshold
    # a chain: each text is linked with the next only
    base = [f"c{k}" for k in range(120)]
    for k in range(12):
        rows.append((20_000 + k, " ".join(base)))
        for j in range(5):
            base[(k * 5 + j) * 2 % 120] = f"n{k}x{j}"
    rng.shuffle(rows)
    return rows


def test_against_brute_force(make):
    rows = corpus(3)
    for size in (2, 5):
        assert result(near_dup.near_duplicates(make(rows), size)) == brute(rows, size)


def test_awkward_rows(make):
    rows = awkward()
    assert result(near_dup.near_duplicates(make(rows), 2)) == brute(rows, 2)
    assert near_dup.near_duplicates(make([]), 2).count() == 0


def test_buckets_are_split_into_blocks(make, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 300)
    rows = [r for r in corpus(5) if r[0] >= 10_000]
    assert result(near_dup.near_duplicates(make(rows), 2)) == brute(rows, 2)


def test_components_of_long_chains(spark):
    n = 200
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a BIGINT, b BIGINT")
    got = near_dup.components(links, "chain").collect()
    assert len(got) == n and {r.comp for r in got} == {0}


def test_one_of_each_group_stays(make):
    rows = corpus(7)
    docs = make(rows)
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute(rows, 5) if i == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_signatures_estimate_jaccard():
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2 ** 63, 800).astype(np.uint64)
    b = np.r_[a[:600], rng.integers(0, 2 ** 63, 200).astype(np.uint64)]
    same = np.mean([near_dup.signature(a, 128)[k] == near_dup.signature(b, 128)[k] for k in range(128)])
    assert abs(same - 0.6) < 0.15
    table = near_dup.circulant(8)
    assert (table[1][:7] == table[0][1:]).all()      # one permutation, shifted
