import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.conftest import rows
from tests.llm.conftest import awkward
from tillstream.llm import token_align as ta
from tillstream.llm.queries import op11_token_alignment

SPECIAL = [(30, "a <|endoftext|> b <s> </s> <unk>"), (31, "low ▁ line"), (32, "  two  spaces\n\n\tand tabs "),
           (33, "<0x0A>"), (34, "日本語テキスト 😀😀 ﷺ"), (35, "ﬁ ① é"), (36, " "), (37, "a")]


def _spans(ids, table):
    at, out = 0, []
    for k in ids:
        out.append((k, at, at + len(table[k])))
        at += len(table[k])
    return out


def _brute(texts):
    """Spans compared pair by pair; counts over all documents."""
    s, docs = ta.sides(ta.A_FILE, ta.B_FILE), []
    for i, text in texts:
        text = text or ""
        a, b = _spans(s.a.encode([text])[0], s.a.bytes), _spans(s.b.encode([text])[0], s.b.bytes)
        whole = b" " + text.encode()
        if not text or b"".join(s.a.bytes[k] for k, *_ in a) != whole or b"".join(s.b.bytes[k] for k, *_ in b) != whole:
            docs.append((i, [], [], []))
            continue
        links, j = [], 0
        for x, lo, hi in a:
            while j and (j == len(b) or b[j][1] > lo):
                j -= 1
            while j < len(b) and b[j][1] < hi:
                if b[j][2] > lo:
                    links.append((x, b[j][0]))
                j += 1
        docs.append((i, a, b, links))
    count = Counter(pair for d in docs for pair in d[3])
    best = {}
    for (x, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for i, a, b, links in docs:
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        parts, x, y = [], 0, 0
        for end in ends:
            own = [[], []]
            while x < len(a) and a[x][2] <= end:
                own[0].append(str(a[x][0]))
                x += 1
            while y < len(b) and b[y][2] <= end:
                own[1].append(str(b[y][0]))
                y += 1
            parts.append("|".join(",".join(k) for k in own))
        text = ";".join(parts)
        out.append((i, len(a), len(b), len(ends), len(links),
                    sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), text))
    return sorted(out, key=lambda t: tuple(map(str, t[:-1])))


def _check(df, texts, groups):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", groups]
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple(map(str, t[:-1])))
    want = _brute(texts)
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    for g, w in zip(got, want):
        assert g[-1] == (w[-1] if groups == "groups" or not w[-1] else hashlib.sha256(w[-1].encode()).hexdigest())


def test_awkward_and_special_texts_equal_brute_force(make):
    texts = [(i, t) for i, t, *_ in [*awkward(), *SPECIAL]]
    made = ta.numbered(ta.aligned(make(texts)))
    _check(ta.link_scores(made), texts, "groups")
    # Beyond the size of a broadcast the counts come by a salted shuffle.
    _check(ta.link_scores(made, few=0), texts, "groups")
    assert {r.doc_id for r in made.filter("n_a = 0").collect()} >= {1, 2, 31}


def test_empty_table(make):
    assert ta.link_scores(ta.numbered(ta.aligned(make([])))).count() == 0


def test_tokens_of_both_sides_cover_the_text():
    s = ta.sides(ta.A_FILE, ta.B_FILE)
    assert len(set(s.a.bytes)) == len(s.a.bytes) == 50_257 and len(s.b.bytes) == 32_000
    text = "été 😀 <|endoftext|>\n"
    assert b"".join(s.a.bytes[k] for k in s.a.encode([text])[0]) == b" " + text.encode()
    assert b"".join(s.b.bytes[k] for k in s.b.encode([text])[0]) == b" " + text.encode()


def test_ids_are_the_library_s_at_every_code_point():
    path = ta._path(ta.A_FILE)
    fast, slow = ta.ByteSide(path).encode, ta.ByteSide.library(path)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0)]
    texts = [f"a{c}b {c}{c} 1{c}2  {c}. {c}'s\n{c} \t{c}!{c}  " for c in points]
    assert fast(texts) == slow(texts)
    runs = [x * 20_000 for x in ("a", " ", "\n", "é", "1", "!?", "\u3000", "ab ", "<|endoftext|>")]
    assert fast(runs) == slow(runs)


def test_portions_hold_few_or_one_text(monkeypatch):
    monkeypatch.setattr(ta, "CHARS", 10)
    b = pa.RecordBatch.from_pydict({"chars": [3, 4, 5, 40, 1, 1, 8, 2]})
    parts = [p.column("chars").to_pylist() for p in ta._portions(b)]
    assert parts == [[3, 4], [5], [40], [1, 1, 8], [2]]
    assert [p.num_rows for p in ta._portions(b.slice(0, 0))] == [0]


def test_batches_do_not_change_results():
    s = ta.sides(ta.A_FILE, ta.B_FILE)
    texts = ["one two", None, "three\nfour five", "", "six <s> seven", "日本語", "eight"]
    whole = ta.align_batch(texts, s)
    single = [ta.align_batch([t], s) for t in texts]
    for c in ("n_a", "n_b", "n_groups", "n_links"):
        assert np.asarray(whole[c]).tolist() == [int(x[c][0]) for x in single]
    assert whole["groups"] == [x["groups"][0] for x in single]
    for c in ("pairs", "times"):
        assert whole[c].to_pylist() == [x[c].to_pylist()[0] for x in single]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    _check(op11_token_alignment(spark, sf), texts, "groups_sha256")
    assert rows(op11_token_alignment(spark, sf), "doc_id")
