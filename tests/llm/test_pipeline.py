"""The pipeline stage by stage against brute force."""

import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_exact_dedup import normal
from tests.llm.test_text_matching import brute as brute_matches
from tests.llm.test_tokens import check_packing
from tillstream.llm import quality

GOOD = "Good clean prose about rivers and towns"
COLUMNS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def _passage(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


VOCABULARY = [a + b for a in ("riv", "town", "hill", "sto", "bread", "lam", "quie", "gar", "nor", "win")
              for b in ("er", "s", "ing", "ed", "ne", "p", "t", "den", "th", "ter", "al", "ow")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Nulls, empty texts, exact and near copies, benchmark passages and junk."""
    rng = random.Random(8)
    docs, labels = [], []
    bench = [(k, " ".join(rng.choice(VOCABULARY) for _ in range(30))) for k in range(5)] + [(9, None)]
    for k in range(120):
        docs.append((k, " ".join(_passage(rng, 12) for _ in range(10))))
        labels.append((k, 1))
    for k in range(120, 180):
        docs.append((k, " ".join("$$$ ### !!! 0x%08x" % rng.getrandbits(32) for _ in range(40))))
        labels.append((k, 0))
    for k in range(200, 220):                                   # exact copies, other white space
        docs.append((k, docs[k - 200][1].replace(" ", "  \n", k % 3)))
    for k in range(220, 240):                                   # near copies: one word differs
        w = docs[k - 190][1].split(" ")
        w[60] = "changed"
        docs.append((k, " ".join(w)))
    for k in range(240, 250):                                   # a benchmark item inside
        docs.append((k, docs[k - 180][1][:300] + " " + bench[k % 5][1] + " " + _passage(rng, 60)))
    docs += [(300, None), (301, ""), (302, " \n"), (None, _passage(rng, 80)), (5, docs[5][1])]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(i, t, "en", "s", None) for i, t in docs], COLUMNS).repartition(4) \
        .write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id BIGINT, text STRING").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT").withColumn("toxic", quality.F.lit(0)) \
        .write.parquet(f"{folder}/labels.parquet")
    return folder, docs, bench


def _plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def _shingles(t, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def _exact(rows):
    """Of texts equal without white space the longest, then the smallest id."""
    best = {}
    for i, t in rows:
        rank = (-len(t or ""), i is None, i)
        key = normal(t)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, (i, t))
    return sorted((v for _, v in best.values()), key=str)


def _near(rows):
    """One row, the smallest id, of each group linked at Jaccard 0.8."""
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def up(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[up(a)] = up(b)
    least = {}
    for k, row in enumerate(rows):
        r = up(k)
        if r not in least or (row[0] is None, row[0]) < (least[r][0] is None, least[r][0]):
            least[r] = row
    return sorted(least.values(), key=str)


def test_every_stage_equals_brute_force(spark, tables):
    folder, docs, bench = tables
    table = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "minhash near-dedup", "benchmark decontamination",
                     "best-fit packing"]
    stage = dict(corpus_pipeline.STAGES)
    good = stage[names[0]](spark, table, folder)
    assert good.columns == table.columns
    scores = quality.classify(table, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = _plain(good)
    assert len(kept) == scores.filter("predicted = 1").count()
    assert all(i not in range(120, 180) for i, _ in kept)             # junk goes
    clean_ids = set(range(120)) | set(range(200, 250))
    assert len(clean_ids - {i for i, _ in kept}) <= 0.02 * len(clean_ids)   # clean documents stay

    # Each later stage on all that its predecessor kept.
    once = stage[names[1]](spark, good, folder)
    want = _exact(kept)
    assert _plain(once) == want and len(want) < len(kept)
    lone = stage[names[2]](spark, spark.createDataFrame(
        [(i, t, "en", "s", None) for i, t in want], COLUMNS), folder)
    far = _near(want)
    assert _plain(lone) == far and len(far) <= len(want) - 15
    clean = stage[names[3]](spark, spark.createDataFrame(
        [(i, t, "en", "s", None) for i, t in far], COLUMNS), folder)
    bad = {i for i, *_ in brute_matches(far, bench, whole_if_short=True)}
    rest = sorted(((i, t) for i, t in far if i not in bad), key=str)
    assert _plain(clean) == rest and bad >= {i for i, _ in far} & set(range(240, 250))
    packed = stage[names[4]](spark, spark.createDataFrame(
        [(i, t, "en", "s", None) for i, t in rest], COLUMNS), folder).collect()
    n, least = check_packing(rest, packed, 2048)
    assert n <= least + 1

    # The whole run gives the pieces of the same documents.
    whole = corpus_pipeline.run(spark, folder).collect()
    place = lambda rs: sorted(((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rs), key=str)
    assert place(whole) == place(packed)


def test_empty_tables(spark, tmp):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp}/benchmark.parquet")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp}/labels.parquet")
    out = corpus_pipeline.run(spark, tmp)
    assert out.count() == 0 and "sequence_id" in out.columns
