"""URL filter: explicit rules, then empirical-Bayes host reputation.

Labelled page outcomes (good / bad) are counted per host, registered domain
and suffix.  Each level is shrunk towards the level above it by a beta-binomial
prior whose mean is the parent's posterior mean and whose strength is estimated
from the spread of the children (method of moments).  A page is allowed when
the lower bound of its host's posterior good rate reaches the threshold.

Only DataFrame functions run here.  Counts are partial aggregates, so a host
with a third of all pages is one row per map task; the verdicts per host are
written down and joined back by an equi-join, those of hosts with a large share
of all pages by a broadcast of these few.
Rules are a table that meets the parent domains of each distinct host in an
equi-join; a page compares its path with the rules of its own host only.

Levels are taken from the host's name: user, port and closing dots do not
count.  The suffix is the last label, or the last two where a country code
follows one of ``SECOND_LEVEL``; the registered domain has one label more.  A
numeric address is a domain of its own under the common suffix ``#ip``.

Defined cases: a null url, or one without ``://``, has empty host and path, and
the empty host is judged by the outcomes of its own pages like any other; a
host without labelled pages takes its domain's posterior, a domain without any
its suffix's; without any label the prior rate is ``PRIOR_RATE``; repeated or
null page ids are each returned (a null id has no outcome); of equal rules the
verdict that sorts last counts; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import fixed_table

from .common import join_groups, saved

# (host, path, verdict); a rule covers its host and every subdomain.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
MAX_RULES = 10_000       # a list of rules travels inside the plan; more are given as a table
# Labels under which country codes register names.
SECOND_LEVEL = ["ac", "co", "com", "edu", "go", "gob", "gov", "gouv", "ltd", "mil", "ne", "net", "nhs",
                "nom", "or", "org", "plc", "sch"]
ADDRESS_SUFFIX = "#ip"   # no host holds the sign
PRIOR_RATE = 0.5         # rate assumed when nothing is labelled
MIN_STRENGTH, MAX_STRENGTH = 2.0, 200.0
THRESHOLD = 0.5          # least good rate
Z = 1.645                # one-sided 95 % bound

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    with A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes_of(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat_ws(
        ".", F.slice(labels, k, F.size(labels))))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """(rule_host, path, rule, size, verdict) of a list of rules, or of a table
    (host, path, verdict) of any length."""
    if not isinstance(rules, DataFrame):
        if len(rules) > MAX_RULES:
            raise ValueError(f"at most {MAX_RULES} rules in a list; give a table (host, path, verdict)")
        rules = (fixed_table(spark, rules, "host STRING, path STRING, verdict STRING") if rules else
                 spark.createDataFrame([], "host STRING, path STRING, verdict STRING"))
    rule = F.concat("host", "path")
    return rules.select(F.col("host").alias("rule_host"), "path", rule.alias("rule"),
                        F.length(rule).alias("size"), "verdict").filter("rule is not null")


def host_rules(hosts: DataFrame, rules) -> DataFrame:
    """(host, rules) of the distinct ``hosts`` that have any: their own rules
    and those of their parent domains.  The array is as long as the rules that
    name the host or a parent."""
    parents = hosts.select("host", F.explode(suffixes_of(F.col("host"))).alias("rule_host"))
    return parents.join(rule_table(hosts.sparkSession, rules), "rule_host").groupBy("host").agg(
        F.collect_list(F.struct("size", "path", "rule", "verdict")).alias("rules"))


def longest_rule(path: Column, rules: Column) -> Column:
    """struct(size, rule, verdict) of the longest of the host's rules whose
    path begins ``path``, or null."""
    fitting = F.filter(rules, lambda r: path.startswith(r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["size"], r["rule"], r["verdict"])))


def name_of(host: Column) -> Column:
    """The host without user, port and closing dots."""
    return F.regexp_replace(host, r"(?s)\A.*@|:[0-9]*\z|\.+(?::[0-9]*)?\z", "")


def _is_address(name: Column) -> Column:
    return name.rlike(r"(?s)\A(?:\[.*\]|[0-9]{1,3}(?:\.[0-9]{1,3}){3})\z")


def _suffix_labels(name: Column) -> Column:
    two = name.rlike(rf"(?:\A|\.)(?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}\z")
    return F.when(two, 2).otherwise(1)


def _last_labels(name: Column, n: Column) -> Column:
    labels = F.split(name, r"\.")
    return F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n, F.lit(0)) + 1, n))


def domain_of(host: Column) -> Column:
    """Registered domain: one label more than the suffix."""
    name = name_of(host)
    return F.when(_is_address(name), name).otherwise(_last_labels(name, _suffix_labels(name) + 1))


def suffix_of(host: Column) -> Column:
    name = name_of(host)
    return F.when(_is_address(name), ADDRESS_SUFFIX).otherwise(_last_labels(name, _suffix_labels(name)))


def _strength(level: DataFrame, parent: str) -> DataFrame:
    """Prior strength of a level: the beta precision that explains the spread
    of its members' rates around their parents' means,
    s = sum w m(1-m) / sum w (rate-m)^2 - 1 with w = labelled pages, within bounds."""
    m, rate = F.col(parent), F.try_divide(F.col("good"), F.col("n"))
    raw = F.try_divide(F.sum(F.col("n") * m * (1 - m)), F.sum(F.col("n") * (rate - m) * (rate - m))) - 1
    return level.filter("n > 0").agg(F.least(F.greatest(F.coalesce(raw, F.lit(MAX_STRENGTH)),
                                                        F.lit(MIN_STRENGTH)),
                                             F.lit(MAX_STRENGTH)).alias("s"))


def _posterior(level: DataFrame, parent: str, out: str) -> DataFrame:
    """Add the posterior's alpha, beta and mean given the parent's mean."""
    s = _strength(level, parent).first()["s"]
    s = MAX_STRENGTH if s is None else float(s)
    a = F.lit(s) * F.col(parent) + F.col("good")
    b = F.lit(s) * (1 - F.col(parent)) + F.col("n") - F.col("good")
    return level.withColumn("alpha", a).withColumn("beta", b).withColumn(out, a / (a + b))


def reputations(pages: DataFrame, outcomes: DataFrame, threshold: float = THRESHOLD,
                z: float = Z) -> DataFrame:
    """(host, pages, rate, bound, verdict) of every host in ``pages``.  ``outcomes`` is
    (page_id, good): labelled pages; several labels of a page count each."""
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"))
    judged = outcomes.select(F.col("page_id").alias("__page"),
                             F.col("good").cast("boolean").alias("__good")).filter("__good is not null")
    labelled = hosts.join(judged, hosts["page_id"] == judged["__page"])
    counts = labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(F.col("__good").cast("long")).alias("good"))
    per_host = saved(
        hosts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
        .join(counts, "host", "left").select(
            "host", "pages", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"),
            F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("good", F.lit(0)).alias("good")),
        "hosts")
    total = per_host.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (total["good"] + 1.0) / (total["n"] + 2.0) if total["n"] else PRIOR_RATE
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    suffix = _posterior(per_host.groupBy("suffix").agg(*sums).withColumn("m0", F.lit(overall)),
                        "m0", "m1")
    domain = per_host.groupBy("domain", "suffix").agg(*sums).join(suffix.select("suffix", "m1"), "suffix")
    domain = saved(_posterior(domain, "m1", "m2").select("domain", "m2"), "domains")
    host = _posterior(per_host.join(domain, "domain"), "m2", "rate")
    a, b = F.col("alpha"), F.col("beta")
    bound = F.col("rate") - F.lit(z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return host.select("host", "pages", "rate", bound.alias("bound")).withColumn(
        "verdict", F.when(F.col("bound") >= threshold, "allow").otherwise("block"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = THRESHOLD,
               z: float = Z) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) for every page.  ``rules``
    is a list or a table of (host, path, verdict)."""
    known = saved(reputations(pages, outcomes, threshold, z), "reputations")
    own = pages.select("page_id", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"))
    hosts = known.withColumnRenamed("verdict", "__verdict").join(host_rules(known, rules), "host", "left")
    total = known.agg(F.sum("pages")).first()[0] or 0
    judged = join_groups(own, hosts, "host", "pages", total).withColumn("__rule", longest_rule(F.col("path"), F.col("rules")))
    return judged.select(
        "page_id", "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", "__verdict").alias("verdict"), "bound")
