import random
import re

import pytest

from tests.llm.conftest import awkward
from tillstream.llm import decontaminate, license_scan


# -- decontamination ----------------------------------------------------------

def distances(p, t):
    """Least edit distance of p to a passage ending at each place (dynamic programme)."""
    prev, out = list(range(len(p) + 1)), []
    for w in t:
        cur = [0]
        for k, x in enumerate(p):
            cur.append(min(prev[k] + (x != w), prev[k + 1] + 1, cur[k] + 1))
        prev = cur
        out.append(cur[-1])
    return out


def words(t):
    return re.sub(r"[\W_]+", " ", (t or "").lower()).split()


def brute(rows, items, whole_if_short=False):
    out = []
    for i, t in rows:
        w = words(t)
        for k, x in items:
            p = words(x)
            if not p or not w:
                continue
            if whole_if_short and len(p) < decontaminate.PIECE and w != p:
                continue
            best = min(distances(p, w))
            if best <= decontaminate.budget(len(p)):
                out.append((i, k, best))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.item_id, r.distance) for r in df.collect()), key=str)


def planted(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 3, 4, 6, 9, 15, 20, 33, 59, 59])]
    items += [(50, None), (51, "  ..."), (52, items[7][1]), (None, items[5][1])]
    rows = [(k, " ".join(word() for _ in range(120))) for k in range(20)]
    for k in range(60):
        p = words(items[rng.randrange(10)][1])
        for _ in range(rng.randrange(0, max(1, len(p) // 3))):
            j = rng.randrange(len(p))
            p[j:j + 1] = rng.choice([[], [word()], [p[j], word()]])
        lead = [word() for _ in range(rng.randrange(0, 40))]
        rows.append((100 + k, " ".join(lead) + ", " + " ".join(p).upper() + "! " + word()))
    rows += [(500, items[0][1]), (501, items[1][1].upper() + ".")]
    return rows, items


def test_matches_against_brute_force(spark, make):
    rows, items = planted()
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    want = brute(rows, items)
    assert len(want) > 40
    assert found(decontaminate.matches(make(rows), bench)) == want
    assert found(decontaminate.matches(make(rows), bench, block=4)) == want     # several blocks


def test_kept_documents(spark, make):
    rows, items = planted(2)
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    docs = make(rows + awkward())
    kept = decontaminate.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns
    bad = {i for i, _, _ in brute(rows, items, whole_if_short=True)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (i for i, _ in rows + awkward() if i not in bad), key=str)


def test_short_items_and_scripts_without_blanks(spark, make):
    han, thai = "水在标准大气压下的沸点是一百摄氏度", "กรงเทพมหานครเปนเมองหลวงของไทย"
    items = [(1, "Photosynthesis converts sunlight"), (2, "one two"), (3, han), (4, thai), (5, "人工智能"),
             (6, "東京は日本の首都です"), (7, "alpha bravo charlie delta echo foxtrot golf hotel india juliet")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows = [(1, "It says: photosynthesis converts SUNLIGHT, and more."), (2, "one two three"), (3, "One, two!"),
            (4, f"问题：{han}。答案是对的"), (5, f"问题：{han.replace('标', '檩')}，对吗"), (6, f"ก่อน{thai}นั้น"),
            (7, "他研究人工智能技术"), (8, "人工智能。"), (9, "質問:東京は日本の首都ですか?"),
            (10, "so alpha bravo x charlie delta echo foxtrot y golf hotel india juliet so"),
            (11, "so alpha bravo x charlie delta z echo foxtrot y golf hotel india juliet so"),
            (12, "photosynthesis slowly converts sunlight"), (13, "水在标准中")]
    want = [(1, 1, 0), (2, 2, 0), (3, 2, 0), (4, 3, 0), (5, 3, 1), (6, 4, 0), (7, 5, 0), (8, 5, 0), (9, 6, 0),
            (10, 7, 2)]
    got = decontaminate.matches(make(rows), bench)
    assert found(got) == sorted(want, key=str)
    assert {r.item_id for r in got.filter("not telling").collect()} == {2, 5}
    capital = spark.createDataFrame([(9, "capital of France")], "item_id BIGINT, text STRING")
    inside = make([(1, "the capital of France is"), (2, "France: capital of it"), (3, "Capital of France!")])
    assert found(decontaminate.matches(inside, capital)) == [(1, 9, 0), (3, 9, 0)]
    assert [r.doc_id for r in decontaminate.keep_uncontaminated(inside, capital).orderBy("doc_id").collect()] == [1, 2]
    assert sorted(r.doc_id for r in decontaminate.keep_uncontaminated(make(rows), bench).collect()) == [2, 7, 11, 12, 13]


def test_error_rate_holds_for_short_items():
    # m words with m // 5 edits spread evenly: each is found.
    for m in range(4, 40):
        item = [f"w{k}" for k in range(m)]
        passage, e = list(item), m // 5
        for k in range(e):
            passage[(2 * k + 1) * m // (2 * e)] = "changed"
        got = decontaminate.Matcher([(1, " ".join(item))]).find("before it " + " ".join(passage) + " after")
        assert [x[:2] for x in got] == [(1, e)], m


def test_awkward_benchmark(spark, make):
    bench = spark.createDataFrame([], "item_id BIGINT, text STRING")
    docs = make(awkward())
    assert decontaminate.matches(docs, bench).count() == 0
    assert decontaminate.keep_uncontaminated(docs, bench).count() == len(awkward())
    some = spark.createDataFrame([(1, "one two three")], "item_id BIGINT, text STRING")
    assert decontaminate.matches(make([]), some).count() == 0
    assert found(decontaminate.matches(docs, some)) == [(-3, 1, 0), (5, 1, 0), (5, 1, 0), (6, 1, 0)]


def test_myers_equals_the_dynamic_programme():
    rng = random.Random(4)
    for _ in range(300):
        p = [rng.choice("abcd") for _ in range(rng.randrange(1, 80))]
        t = [rng.choice("abcd") for _ in range(rng.randrange(1, 90))]
        assert decontaminate.myers(p, t) == distances(p, t)


# -- licences -----------------------------------------------------------------

def grams(t):
    w = re.sub("[^a-z0-9]+", " ", re.sub("['’]", "", t.lower())).split()
    return set(zip(w, w[1:]))


def brute_excerpts(text, threshold):
    """(dice, license, words) of the excerpts of a text that no better one covers."""
    w = re.sub("[^a-z0-9]+", " ", re.sub("['’]", "", text.lower())).split()
    found = []
    for lic, body in license_scan.TEMPLATES:
        b, n = grams(body), len(license_scan.body_words(body))
        runs = []
        for at in range(len(w) - 1):
            if (w[at], w[at + 1]) in b:
                x = w[at:at + n]
                a = set(zip(x, x[1:]))
                d = 2 * len(a & b) / (len(a) + len(b))
                if d >= threshold - 1e-12:
                    runs.append((at, d, tuple(x)))
        for k, (at, d, x) in enumerate(runs):
            before = k and at - runs[k - 1][0] < n and runs[k - 1][1] >= d
            after = k + 1 < len(runs) and runs[k + 1][0] - at < n and runs[k + 1][1] > d
            if not before and not after:
                found.append((d, len(x), lic, -at, x))
    return [(d, lic, x) for d, n, lic, at, x in found
            if not any(2 * (min(n - at, m - s) - max(-at, -s)) > n and (e, m, other, s) > (d, n, lic, at)
                       for e, m, other, s, _ in found)]


def brute_licenses(rows, threshold=license_scan.THRESHOLD):
    best, count = {}, {}
    for i, t in rows:
        if t is None:
            continue
        parts = [("document", t)]
        for kind, cut in (("paragraph", re.split(r"\n[ \t\r]*\n\s*", t)), ("line", t.split("\n"))):
            if len(cut) > 1:
                parts += [(kind, x) for x in cut]
        for kind, x in set(parts):
            a = grams(x)
            scored = []
            for lic, body in license_scan.TEMPLATES:
                b = grams(body)
                if a and b:
                    scored.append((2 * len(a & b) / (len(a) + len(b)), lic))
            if scored and max(scored)[0] >= threshold - 1e-12:
                d, lic = max(scored)
                key = (i, lic)
                best[key] = max(best.get(key, (0, "")), (d, kind))
                count.setdefault(key, set()).add((kind, x))
        for d, lic, x in brute_excerpts(t, threshold):
            best[i, lic] = max(best.get((i, lic), (0, "")), (d, "excerpt"))
            count.setdefault((i, lic), set()).add(("excerpt", x))
    return sorted(((i, lic, round(d, 9), kind, len(count[i, lic])) for (i, lic), (d, kind) in best.items()),
                  key=str)


def test_licenses_against_brute_force(make):
    rng = random.Random(6)
    rows = list(awkward())
    for k, (_, body) in enumerate(license_scan.TEMPLATES):
        w = body.split()
        for j in range(3):
            v = list(w)
            for _ in range(j * len(w) // 12):
                v[rng.randrange(len(v))] = "changed"
            rows.append((1000 + 10 * k + j, "Some text here.\n" + " ".join(v).upper() + "\n\nmore text\n"
                         + ("" if j else "\n\n" + body)))
        rows.append((2000 + k, "Copyright 2021 Jane Doe. " + body + " Thanks to all! " + body))
        comment = "\n".join("# " + " ".join(w[j:j + 6]) for j in range(0, len(w), 6))
        rows.append((3000 + k, "#!/bin/sh\n#\n" + comment + "\n#\nset -e\n"))
    many = " ".join(body for _, body in license_scan.TEMPLATES)
    rows += [(4000, many), (4001, many), (4000, many), (None, many), (4002, "word " * 30_000 + many + " word" * 30_000)]
    rows += [(5000, license_scan.TEMPLATES[0][1]), (5001, "cc by 4 0"), (5002, "Li'censed under CC BY 4.0")]
    got = sorted(((r.doc_id, r.license, round(r.dice, 9), r.kind, r.segments)
                  for r in license_scan.scan(make(rows)).collect()), key=str)
    want = brute_licenses(rows)
    assert got == want and len(want) > 50
    assert license_scan.scan(make([])).count() == 0


def test_notices_inside_lines_and_comments(make):
    gpl = license_scan.TEMPLATES[7][1].split()
    block = "\n".join("# " + " ".join(gpl[k:k + 9]) for k in range(0, len(gpl), 9))
    rows = [(1, "Copyright 2021 Jane Doe. Released under the MIT License."), (2, "#!/bin/sh\n" + block + "\nexit 0\n"),
            (3, "We met at the school and were released under the care of a teacher.")]
    got = {(r.doc_id, r.license): (r.kind, r.dice) for r in license_scan.scan(make(rows)).collect()}
    assert got == {(1, "MIT"): ("excerpt", 1.0), (2, "GPL-3.0"): ("excerpt", 1.0)}


def test_long_templates_and_bounds(make):
    body = " ".join(f"w{k % 701} v{k % 1009}" for k in range(3000))
    rows = [(1, "x " * 500 + body + " y" * 500), (2, body[:len(body) // 2])]
    got = license_scan.scan(make(rows), [("Long", body)]).collect()
    assert [(r.doc_id, r.license, r.kind, r.dice) for r in got] == [(1, "Long", "excerpt", 1.0)]
    with pytest.raises(ValueError):
        license_scan.scan(make(rows), [("Long", "word " * (license_scan.MAX_WORDS + 1))])


def test_no_python_runs(make):
    plan = license_scan.scan(make([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
