import pytest

from tillstream.llm import url_reputation as u

URLS = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/y", "http://x.net/es/1", "http://net/es/",
        "http://notnet/es/", "ftp://example.com", "http://example.com?x=/en/", "no scheme/en/", None, "",
        "http://user@h.org:80/p#x", "://odd/en/", "http://a.com/b://c.net/es/", "http://sub.example.com/en",
        "HTTP://WWW.EXAMPLE.COM/en/", "http://ÄB.com/é\n/x"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    end = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in u.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def pages(spark, urls):
    return spark.createDataFrame([(k, x, "h", "v", True) for k, x in enumerate(urls)],
                                 "page_id BIGINT, url STRING, host STRING, verdict STRING, good BOOLEAN")


def test_hosts_paths_and_rules(spark):
    none = spark.createDataFrame([], "page_id BIGINT, good BOOLEAN")
    got = {r.page_id: r for r in u.judge_urls(pages(spark, URLS), none).collect()}
    assert len(got) == len(URLS)
    for k, url in enumerate(URLS):
        r = got[k]
        assert (r.host, r.path) == parts(url), url
        name, verdict = rule(r.host, r.path)
        assert r.rule == name
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert u.judge_urls(pages(spark, URLS).limit(0), none).count() == 0


def test_reputation_is_shrunk(spark):
    urls, good = [], []
    for host, n, share in (("good.site.org", 40, 1.0), ("bad.farm.org", 40, 0.0), ("new.farm.org", 1, None),
                           ("one.site.org", 1, 0.0), ("mixed.else.org", 30, 0.9)):
        for k in range(n):
            good += [] if share is None else [(len(urls), k < share * n)]
            urls.append(f"http://{host}/p{k}")
    outcomes = spark.createDataFrame(good + [(0, None), (10 ** 6, True)], "page_id BIGINT, good BOOLEAN")
    r = {x.host: x for x in u.reputations(pages(spark, urls), outcomes).collect()}
    assert r["good.site.org"].verdict == "allow" and r["bad.farm.org"].verdict == "block"
    assert r["new.farm.org"].verdict == "block"              # takes its domain's rate
    assert 0 < r["one.site.org"].rate                        # one bad page is shrunk
    assert r["one.site.org"].rate > r["bad.farm.org"].rate
    assert r["bad.farm.org"].rate < r["new.farm.org"].rate < r["mixed.else.org"].rate < r["good.site.org"].rate
    assert all(x.bound < x.rate for x in r.values())
    plan = u.judge_urls(pages(spark, urls), outcomes)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_registered_domains(spark):
    want = {"a.foo.co.uk": ("foo.co.uk", "co.uk"), "foo.co.uk": ("foo.co.uk", "co.uk"),
            "co.uk": ("co.uk", "co.uk"), "www.example.com:8080": ("example.com", "com"),
            "192.168.0.1": ("192.168.0.1", "#ip"), "192.168.0.1:80": ("192.168.0.1", "#ip"),
            "[::1]:443": ("[::1]", "#ip"), "[2001:db8::7]": ("[2001:db8::7]", "#ip"),
            "me:pw@shop.example.org": ("example.org", "org"), "example.org.": ("example.org", "org"),
            "example.org.:80": ("example.org", "org"), "localhost": ("localhost", "localhost"),
            "": ("", ""), "x.com.au": ("x.com.au", "com.au"), "com.com": ("com.com", "com"),
            "1.2.3": ("2.3", "3"), "a.b.example.net": ("example.net", "net"), ":": ("", "")}
    rows = spark.createDataFrame([(h,) for h in want], "host STRING")
    got = {r.host: (r.d, r.s) for r in rows.select(
        "host", u.domain_of(rows["host"]).alias("d"), u.suffix_of(rows["host"]).alias("s")).collect()}
    assert got == want


def test_a_multi_label_suffix_parts_domains(spark):
    urls = [f"http://h{k}.good.co.uk/" for k in range(30)] + [f"http://h{k}.bad.co.uk/" for k in range(30)]
    urls += ["http://new.good.co.uk/", "http://new.bad.co.uk/"]
    outcomes = spark.createDataFrame([(k, k < 30) for k in range(60)], "page_id BIGINT, good BOOLEAN")
    r = {x.host: x for x in u.reputations(pages(spark, urls), outcomes).collect()}
    assert r["new.good.co.uk"].verdict == "allow" and r["new.bad.co.uk"].verdict == "block"


def test_rules_as_a_table(spark):
    none = spark.createDataFrame([], "page_id BIGINT, good BOOLEAN")
    many = [(f"s{k}.org", f"/p{j}/", "allow" if (k + j) % 2 else "block") for k in range(4000) for j in range(3)]
    with pytest.raises(ValueError):
        u.rule_table(spark, many)
    many += [("s7.org", "/p1/deep", "block"), ("s7.org", "/p1/deep", "allow"), (None, "/", "block")]
    table = spark.createDataFrame(many, "host STRING, path STRING, verdict STRING")
    urls = ["http://s7.org/p1/x", "http://a.b.s7.org/p1/deeper", "http://xs7.org/p1/", "http://s3999.org/p2/",
            "http://s3999.org/p3/", None]
    got = {r.page_id: (r.rule, r.verdict) for r in u.judge_urls(pages(spark, urls), none, table).collect()}
    assert got == {0: ("s7.org/p1/", "block"), 1: ("s7.org/p1/deep", "block"), 2: (None, "block"),
                   3: ("s3999.org/p2/", "allow"), 4: (None, "block"), 5: (None, "block")}
    assert {r.rule for r in u.judge_urls(pages(spark, urls), none, []).collect()} == {None}


def test_repeated_and_null_ids(spark):
    rows = [(1, "http://a.org/"), (1, "http://a.org/"), (None, "http://a.org/"), (None, None)]
    twice = spark.createDataFrame(rows, "page_id BIGINT, url STRING")
    outcomes = spark.createDataFrame([(1, True), (1, False), (None, True)], "page_id BIGINT, good BOOLEAN")
    got = sorted(((r.page_id, r.host) for r in u.judge_urls(twice, outcomes).collect()), key=str)
    assert got == sorted([(1, "a.org"), (1, "a.org"), (None, "a.org"), (None, "")], key=str)
    counted = {r.host: r.rate for r in u.reputations(twice, outcomes).collect()}
    assert abs(counted["a.org"] - 0.5) < 1e-9
