import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import awkward
from tillstream.llm import common, language_id, lm_score, quality

SF = "/root/testdata/sf0.01"


# -- language identification --------------------------------------------------

def test_held_out_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) == sum(crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_blocks_stay_small_beside_a_long_text():
    """One text of many trigrams is a block alone, not a row of the others'."""
    long = "".join(chr(0x4E00 + k % 20_000) + chr(0x61 + k % 26) for k in range(400_000)).encode()
    texts = [b"abc"] * 100 + [long] + [b"defg", b""] * 20
    blocks = [(rows.tolist(), counts.shape) for rows, _, counts in language_id._counted(texts)]
    assert [100] in [rows for rows, _ in blocks]
    assert max(a * b for _, (a, b) in blocks if a > 1) < 1000
    assert sorted(r for rows, _ in blocks for r in rows) == [*range(101), *range(101, 141, 2)]


def test_language_of_awkward_rows(make):
    got = language_id.identify(make(awkward())).collect()
    assert len(got) == len(awkward())
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (1, 2, 3))
    assert by[7].lang_pred == "en"
    assert language_id.identify(make([])).count() == 0
    nothing = language_id.identify(make([(1, "text", None), (2, "more", None)])).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_vectors_are_bound_and_bundled():
    text = "abcab".encode()
    codes = language_id.trigrams(text)
    a, b, c = language_id.letter_vectors(256)
    sym = [int(language_id._symbols()[ord(x)]) for x in "abcab"]
    s = [0, *sym, 0]
    want = sum(a[x].astype(int) * b[y] * c[z] for x, y, z in zip(s, s[1:], s[2:]))
    (rows, distinct, counts), = list(language_id._counted([text]))
    assert (language_id.bundled(counts, distinct, 256)[0] == want).all() and len(codes) == 5


# -- quality ------------------------------------------------------------------

def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    good = [r for r in held if r.quality == 1]
    bad = [r for r in held if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.97
    assert np.mean([1 - r.predicted for r in bad]) > 0.7
    assert np.mean([g.score > b.score for g in good for b in bad]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_of_awkward_rows(spark, make):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 0, 0), (7, None, 0), (None, 1, 0), (9, 1, 0)],
                                   "doc_id BIGINT, quality INT, toxic INT")
    docs = make(awkward())
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality.classify(make([]), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_risk_is_not_negative():
    rng = np.random.default_rng(0)
    p = rng.normal(1, 1, (400, quality.FEATURES))
    u = np.concatenate([rng.normal(1, 1, (600, quality.FEATURES)), rng.normal(-1, 1, (400, quality.FEATURES))])
    m = quality.fit(p, u, 0.6)
    s = m.score(u)
    assert (s[:600] > 0.5).mean() > 0.95 and (s[600:] < 0.5).mean() > 0.95


# -- language model -----------------------------------------------------------

def brute_base(rows):
    tok = [[w for w in (t or "").encode().lower().split()] + ["<end>"] for _, t in rows]
    held = [i is not None and crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for t, h in zip(tok, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return sorted(((i, h, len(t), sum(w in c for w in t), n,
                    round(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in t), 6))
                   for (i, _), t, h in zip(rows, tok, held)), key=str)


def lm_rows(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in df), key=str)


def test_base_scores(make, monkeypatch):
    rows = awkward() + [(k, f"A b{k % 3} C the the end {k % 7}") for k in range(100, 160)]
    got = lm_score.lm_scores(make(rows)).collect()
    assert lm_rows(got) == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    # with a head of a few words the rest meet their counts in the join
    monkeypatch.setattr(lm_score, "HEAD", 3)
    assert lm_rows(lm_score.lm_scores(make(rows)).collect()) == brute_base(rows)


def test_no_training_text(make):
    held = [k for k in range(200) if crc32(str(k).encode()) % 10 == 0][:3]
    got = lm_score.lm_scores(make([(k, "some words") for k in held])).collect()
    assert lm_rows(got) == brute_base([(k, "some words") for k in held])
    assert lm_score.lm_scores(make([])).count() == 0


def test_model_beats_the_base_on_held_out_text(spark):
    rows = lm_score.lm_scores(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.98 * sum(r.base_score for r in held)
    assert np.mean([r.score > r.base_score for r in held]) > 0.8


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    n, s = lm_score.CLASSES, lm_score.SIZE
    p = lm_score.Parameters("k", *(rng.normal(0, .5, (n, s)).astype(np.float32) for _ in range(3)),
                            rng.normal(0, 1, n).astype(np.float32))
    model = lm_score.Scorer(p)
    for u, v in ((0, 5), (7, n - 1), (n - 1, n - 1)):
        w = np.arange(n)
        total = (10 ** model(w, np.full(n, u), np.full(n, v))).sum()
        assert total == pytest.approx(1, abs=1e-4)


def test_training_learns_bigrams():
    rng = random.Random(0)
    docs = []
    for _ in range(300):
        start = rng.choice([0, 10])        # after 0 come 1 2 3, after 10 come 11 12 13
        docs.append(np.array([start, start + 1, start + 2, start + 3, lm_score.END_CLASS], np.uint16))
    count = np.bincount(np.concatenate(docs), minlength=lm_score.CLASSES).astype(float)
    vocab = lm_score.Vocabulary({}, None, None, 1, 1, count)
    noise = (count + 1) ** 0.75
    t = lm_score.Trainer(lm_score.start(vocab), noise / noise.sum(), 1)
    for _ in range(60):
        t.train(docs)
    model = lm_score.Scorer(lm_score.Parameters("x", t.c1, t.c2, t.q, t.b))
    at = lambda w, u, v: float(model(np.array([w]), np.array([u]), np.array([v]))[0])
    assert at(11, 10, lm_score.END_CLASS) > at(1, 10, lm_score.END_CLASS) + 0.5
    assert at(2, 1, 0) > at(12, 1, 0) + 0.5


def two_topics(seed, n):
    """Texts of one of two topics: a common word of the topic, then a rare word
    of the topic; every topic has 2,000 rare words, too many for own classes."""
    rng = random.Random(seed)
    out = []
    for k in range(n):
        t = rng.choice("xy")
        out.append((k, " ".join(f"{t}{rng.randrange(40)} {t}rare{rng.randrange(2000)}" for _ in range(60))))
    return out


def learnt(docs):
    """The operator's parts over small tables."""
    sc = docs.sparkSession.sparkContext
    counts = lm_score.count_tokens(docs.filter("crc32(encode(cast(doc_id as string), 'UTF-8')) % 10 != 0")).cache()
    vocab = lm_score.vocabulary(counts)
    sent = sc.broadcast(vocab)
    encoded = lm_score.encode(docs, sent, 10, 0).cache()
    model = lm_score.train(encoded, vocab)
    d, noise = lm_score.anchor_vectors(model, vocab)
    words = lm_score.learn_words(encoded.filter("not held_out"), sent, d, noise).cache()
    return counts, vocab, words, lm_score.inner_model(words, vocab, d, noise)


@pytest.mark.parametrize("head", [lm_score.HEAD, 500])
def test_words_within_a_class(make, monkeypatch, head):
    monkeypatch.setattr(lm_score, "HEAD", head)
    docs = make(two_topics(1, 700))
    counts, vocab, words, inner = learnt(docs)
    n = {bytes(r.token): r.c for r in counts.collect()}
    rows = words.collect()
    own = {w for w, k in vocab.head.items() if not lm_score.WORDS <= vocab.head_class[k] < lm_score.END_CLASS}
    # every training word has a class of its own or a row with its count and vector
    assert {bytes(r.token): r.c for r in rows} == {w: c for w, c in n.items() if w not in own}
    assert all((r.vec is None) == (r.c == 1) == (r.once is not None) for r in rows)
    # the words of a class and the unseen word of a class by hash: probabilities sum to one
    kinds = np.array([r.kind for r in rows])
    vec = np.array([np.frombuffer(r.vec, np.float32) if r.vec else inner.ones[r.once] for r in rows])
    log_c = np.log10(np.array([r.c for r in rows]) + lm_score.SMOOTH)
    for h in (0, 3, lm_score.WORDS):
        p = 10 ** (log_c + inner.lift(vec, np.full(len(rows), h)) - inner.log_z[kinds - lm_score.WORDS, h])
        for k in np.unique(kinds):
            unseen = lm_score.SMOOTH * 10 ** -inner.log_z[k - lm_score.WORDS, h] * (k >= lm_score.FIRST_RARE)
            assert p[kinds == k].sum() + unseen == pytest.approx(1, abs=1e-4)
    # a rare word is likelier after a common word of its topic
    place = {w: k for w, k in vocab.head.items() if vocab.head_class[k] < lm_score.WORDS}
    x, y = (np.array([vocab.head_class[k] for w, k in place.items() if w[:1] == t and b"rare" not in w])
            for t in (b"x", b"y"))
    often = [k for k, r in enumerate(rows) if r.c >= 4]
    better = 0
    for k in often:
        a, b = (10 ** inner.lift(np.repeat(vec[k:k + 1], len(t), 0), t) / 10 ** inner.log_z[
            kinds[k] - lm_score.WORDS, t] for t in (x, y))
        better += (a.mean() > b.mean()) == (bytes(rows[k].token)[:1] == b"x")
    assert better > 0.95 * len(often)


def test_scores_do_not_depend_on_where_words_are_held(make, monkeypatch):
    """Base scores and known words are the same with a head of 500 words."""
    rows = two_topics(2, 200)
    docs = make(rows)
    assert lm_rows(lm_score.lm_scores(docs).collect()) == brute_base(rows)
    monkeypatch.setattr(lm_score, "HEAD", 500)
    got = lm_score.lm_scores(docs).collect()
    assert lm_rows(got) == brute_base(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_anchor_is_the_last_own_word_of_the_text():
    w, tail = lm_score.WORDS, lm_score.WORDS + 1
    kinds = np.array([tail, 5, tail, tail, lm_score.END_CLASS, tail, 7, lm_score.END_CLASS])
    first = np.array([1, 0, 0, 0, 0, 1, 0, 0], bool)
    assert lm_score.anchors(kinds, first).tolist() == [w, w, 5, 5, 5, w, w, 7]


def test_words_are_split_as_bytes_are():
    """Arrow's words are those of bytes.lower().split(), in pieces of any size."""
    texts = [b"", b" ", b"\n\n", b" A  b\tC\n", b"x\x1cY\x0bz\x0c\r", "\u00c9 \u00e9\u3000Q\u0085 \u212a".encode(), b"\xff\xfe A\x00b",
             b"one"] * 3
    got = []
    for piece in (1, 20, 1 << 20):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["raw"]).slice(1)
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lm_score, "PIECE", piece)
            parts = [lm_score.split(b.column("raw")) for b in lm_score.pieces(batch)]
        words, n = [w for p, _ in parts for w in p.to_pylist()], [k for _, p in parts for k in p]
        assert words == [w for t in texts[1:] for w in t.lower().split()]
        assert n == [len(t.lower().split()) for t in texts[1:]]
        got.append(len(parts))
    assert got[0] > got[1] > got[2] == 1


def test_words_beyond_the_head_follow_their_vector(spark, monkeypatch):
    """Sums by row over parts of two rows, and the vector is not joined to every
    row: no join in the plan."""
    monkeypatch.setattr(lm_score, "slices", lambda b, rows: common.slices(b, 2))
    rng = np.random.default_rng(3)
    a = lm_score.ANCHORS
    inner = lm_score.Inner(rng.normal(size=(a, lm_score.SIZE)).astype(np.float32), None, None,
                           rng.normal(size=(a, lm_score.SIZE + 1)).astype(np.float32))
    known = {b"often": (5, rng.normal(size=lm_score.SIZE + 1).astype(np.float32), None), b"once": (1, None, 7)}
    rare = [(w, row, h, n) for w in (b"never", b"often", b"once", b"other") for row, h, n in
            ((1, 3, 1), (2, 4, 2), (2, 9, 1), (5, a - 1, 3), (1 << 34, 0, 1))]
    words = spark.createDataFrame([(bytearray(w), c, v if v is None else bytearray(v.tobytes()), o)
                                   for w, (c, v, o) in known.items()], "token BINARY, c BIGINT, vec BINARY, once INT")
    docs = spark.createDataFrame([(bytearray(w), *x) for w, *x in rare], "token BINARY, row BIGINT, h INT, n BIGINT")
    found = lm_score.score_rare(docs, words, spark.sparkContext.broadcast(inner))
    assert "Join" not in found._jdf.queryExecution().toString()
    want = {}
    for w, row, h, n in rare:
        c, v, o = known.get(w, (0, np.zeros(lm_score.SIZE + 1, np.float32), None))
        v = inner.ones[o] if o is not None else v
        base, sums = n * math.log10(c + lm_score.SMOOTH), want.setdefault(row, np.zeros(3))
        sums += base, base + n * inner.lift(v[None], np.array([h]))[0], n if c else 0
    got = {r.row: (r.rare_base, r.rare_log, r.rare_known) for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(tuple(want[k])) for k in want)
