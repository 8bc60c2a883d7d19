import hashlib
import re
from collections import defaultdict

from tests.llm.conftest import awkward
from tillstream.llm import exact_dedup
from tillstream.session import scratch_path


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append((i, t or ""))
    out = []
    for key, g in groups.items():
        top = max(len(t) for _, t in g)
        ids = [i for i, t in g if len(t) == top and i is not None]
        keep = min(ids) if ids else None
        for i, t in g:
            out.append((i, keep, len(g), i == keep and len(t) == top,
                        hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()],
                  key=str)


def test_against_brute_force(make):
    rows = awkward()
    assert result(exact_dedup.exact_dedup(make(rows), buckets=4)) == brute(rows)


def test_empty_table(make):
    assert exact_dedup.exact_dedup(make([]), buckets=2).count() == 0
    assert exact_dedup.exact_keep(make([]), buckets=2).count() == 0


def test_index_persists_between_batches(spark, make):
    path = scratch_path(spark, "digest-index-test")
    first = exact_dedup.exact_dedup(make([(1, "a b"), (2, "c")]), path, 4).collect()
    assert all(r.kept for r in first)
    second = {r.doc_id: r for r in exact_dedup.exact_dedup(
        make([(3, "a  b"), (4, "new"), (5, "n ew"), (6, "ab")]), path, 4).collect()}
    assert (second[3].kept, second[3].keep_id, second[3].group_size) == (False, 1, 3)
    assert second[6].keep_id == 1 and not second[6].kept
    assert (second[5].kept, second[4].kept, second[4].keep_id) == (True, False, 5)
    index = exact_dedup.DigestIndex(spark, path)
    assert index.buckets == 4 and index.read().count() == 3
    plan = index.read()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_kept_rows_keep_their_columns(make):
    docs = make(awkward())
    kept = exact_dedup.exact_keep(docs, buckets=4)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    groups = {normal(t) for _, t in awkward()}
    assert len(got) == len(groups)
    best = {normal(t): i for i, t in got}
    assert best["onetwothree"] == 6          # longest original text
    assert best[""] == 3


def test_a_repeated_batch_gives_the_same_rows(spark, make):
    path = scratch_path(spark, "digest-index-replay")
    batch = make(awkward())
    want = brute(awkward())
    assert result(exact_dedup.exact_dedup(batch, path, 4)) == want
    assert result(exact_dedup.exact_dedup(batch, path, 4)) == want
    assert exact_dedup.exact_keep(batch, path).count() == len({normal(t) for _, t in awkward()})
    index = exact_dedup.DigestIndex(spark, path)
    assert index.rows().count() == len({normal(t) for _, t in awkward()})


def test_a_third_batch_counts_the_second(spark, make):
    path = scratch_path(spark, "digest-index-three")
    one, two, three = make([(1, "a b"), (2, "c")]), make([(3, "ab"), (4, "d")]), make([(5, "a b "), (6, "d")])
    exact_dedup.exact_dedup(one, path, 4)
    exact_dedup.exact_dedup(two, path, 4)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(three, path, 4).collect()}
    assert (got[5].keep_id, got[5].group_size, got[5].kept) == (1, 3, False)
    assert (got[6].keep_id, got[6].group_size, got[6].kept) == (4, 2, False)
    # The second again: its own rows do not count twice, the third's do.
    again = {r.doc_id: r for r in exact_dedup.exact_dedup(two, path, 4).collect()}
    assert (again[3].keep_id, again[3].group_size) == (1, 3)
    assert (again[4].keep_id, again[4].kept, again[4].group_size) == (4, True, 2)
    # A document that comes again in another batch is the one that stays.
    later = {r.doc_id: r for r in exact_dedup.exact_dedup(make([(1, "a b"), (7, "a b")]), path, 4).collect()}
    assert later[1].kept and not later[7].kept


def test_a_batch_stopped_within_its_append(spark, make):
    path = scratch_path(spark, "digest-index-stopped")
    batch = make([(k, f"text {k % 7}") for k in range(30)])
    name = exact_dedup.batch_identity(exact_dedup.digests(batch))
    want = brute([(k, f"text {k % 7}") for k in range(30)])
    first = exact_dedup.DigestIndex(spark, path, buckets=4)
    groups = exact_dedup.batch_groups(exact_dedup.digests(batch))
    first.append(groups.orderBy("digest").limit(3), name)          # only a part arrived
    assert result(exact_dedup.exact_dedup(batch, path)) == want
    assert first.rows().count() == 7


def test_index_in_another_number_of_buckets(spark, make):
    path = scratch_path(spark, "digest-index-narrow")
    exact_dedup.exact_dedup(make([(k, f"t{k}") for k in range(40)]), path, 2)
    wide = exact_dedup.DigestIndex(spark, path).copy(scratch_path(spark, "digest-index-wide"), 8)
    assert wide.buckets == 8 and wide.read().count() == 40
    got = exact_dedup.exact_dedup(make([(99, "t7")]), wide.path).first()
    assert (got.keep_id, got.group_size, got.kept) == (7, 2, False)
