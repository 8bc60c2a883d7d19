"""Driver contract: entry() runs, every query is registered with an oracle
(or listed as stream/state-only), and names/columns line up."""

import __spark_entry__ as E
from tillstream.plans.queries import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct",
                          "pv_ct", "dur_sum"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.queries()) == set(QUERIES) | set(E.EXTRA_QUERIES)
    assert len(QUERIES) >= 50


def test_small_queries_run(spark):
    for name in ["fn_age_zodiac", "run_summary", "dws_keyword_count", "moderation_p1"]:
        assert E.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0
