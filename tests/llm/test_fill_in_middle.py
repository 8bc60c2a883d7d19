import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import awkward
from tillstream.llm import fill_in_middle as fim
from tillstream.llm.queries import op13_fill_in_middle


def _reference(doc_id, text, seed=7, fim_percent=100, spm_percent=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    lo, hi = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = "".join(lines[:lo]), "".join(lines[lo:hi]), "".join(lines[hi:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim_percent:
        return (doc_id, len(lines), "plain", None, None, text)
    if h4 % 100 < spm_percent:
        return (doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def _texts():
    rng = np.random.default_rng(3)
    long = "\n".join("é" * int(k) for k in rng.integers(0, 90, 40_000))
    out = [*awkward(), (20, "a\nb\nc\n"), (21, "\n"), (22, "\n\n\n"), (23, "no end"), (24, "x\r\ny\r\nz"),
           (25, "holds <P> a mark\nb"), (26, "<P\n>\n<S\n"), (27, "你好\n世界\n😀"), (28, long), (28, long)]
    return out + [(k, "\n".join(f"line {k} {j}" for j in range(k % 9))) for k in range(100, 160)]


def test_index_gives_every_offset_back():
    rng = np.random.default_rng(5)
    tables = [[0], [0, 5], np.arange(500) * 7, np.r_[0, rng.integers(1, 900, 5000).cumsum()],
              np.r_[0, rng.integers(60, 80, 50_000).cumsum()], np.r_[0, 1, 2, 10 ** 7, 10 ** 7 + 1, 3 * 10 ** 9]]
    for y in tables:
        index = fim.fit(np.array(y))
        ranks = np.arange(len(y))
        assert (index.offsets(ranks) == y).all()
        assert np.abs(index.predict(ranks) - y).max() <= fim.ERROR
    regular = fim.fit(np.arange(100_000) * 61)
    assert len(regular.first) == 1 and regular.residual.itemsize == 2
    assert len(fim.fit(np.r_[0, rng.integers(60, 80, 50_000).cumsum()]).first) < 500


def test_equals_a_plain_version_and_restores(spark, make):
    docs = make(_texts())
    made = fim.fill_in_middle(docs).cache()
    want = [_reference(i, t) for i, t, *_ in _texts()]
    cols = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert rows(made, *cols) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert {r[2] for r in want} == {"plain", "spm", "psm"}
    back = made.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("t"))
    assert rows(back) == sorted(((i, t or "") for i, t, *_ in _texts()), key=lambda r: tuple(map(str, r)))


def test_rates_and_seed(make):
    docs = make([(k, f"a{k}\nb\nc\nd") for k in range(300)])
    made = rows(fim.fill_in_middle(docs, seed=11, fim_percent=50, spm_percent=0),
                "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    want = [_reference(k, f"a{k}\nb\nc\nd", 11, 50, 0) for k in range(300)]
    assert made == sorted(want, key=lambda r: tuple(map(str, r)))
    assert 90 < sum(r[2] == "psm" for r in made) < 210 and all(r[2] != "spm" for r in made)


def test_stored_index_answers_ranks(make):
    text = "\n".join("w" * (k % 50) for k in range(3000))
    got = fim.rank_index(make([(1, text), (2, None), (3, "one")])).orderBy("doc_id").collect()
    assert [r.n for r in got] == [3000, 0, 1]
    r = got[0]
    index = fim.RankIndex(np.array(r["first"]), np.array(r["offset"]), np.array(r["slope"]),
                          np.frombuffer(bytes(r["residual"]), f"<i{r['width']}"))
    assert index.offsets(np.arange(3001)).tolist() == fim.line_ends(text.encode()).tolist()


def test_query_over_an_empty_table_and_a_driver_table(spark, make, tmp):
    make([]).write.parquet(f"{tmp}/documents.parquet")
    empty = op13_fill_in_middle(spark, tmp)
    assert empty.count() == 0 and "restored_sha256" in empty.columns
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op13_fill_in_middle(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        want = _reference(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[1:5]
        assert r.output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
