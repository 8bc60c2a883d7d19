from tests.conftest import rows
from tillstream.operators.joins import interval_join, lookup

MIN30 = 1_800_000


def test_interval_join_bounds_inclusive(spark):
    left = spark.createDataFrame([("k", 1_000_000_000)], "k string, t bigint")
    right = spark.createDataFrame([
        ("k", 1_000_000_000 - MIN30, "lo"), ("k", 1_000_000_000 - MIN30 - 1, "lo-1"),
        ("k", 1_000_000_000 + MIN30, "hi"), ("k", 1_000_000_000 + MIN30 + 1, "hi+1"),
        ("j", 1_000_000_000, "other key")], "rk string, rt bigint, tag string")
    out = interval_join(left, right, [("k", "rk")], "t", "rt", -MIN30, MIN30)
    assert rows(out, "tag") == [("hi",), ("lo",)]


def test_interval_join_hot_key_small_buckets(spark):
    # one key with many rows: bucketed join returns exactly the pairs in range
    n = 300
    left = spark.createDataFrame([("hot", i * 1000) for i in range(n)], "k string, t bigint")
    right = spark.createDataFrame([("hot", i * 1000 + 500) for i in range(n)], "rk string, rt bigint")
    out = interval_join(left, right, [("k", "rk")], "t", "rt", -1000, 1000, bucket_ms=700)
    # each right row (t+500) is within 1 s of left rows t and t+1000
    assert out.count() == 2 * n - 1


def test_lookup_default_and_no_multiplication(spark):
    df = spark.createDataFrame([("1",), ("2",)], "k string")
    dim = spark.createDataFrame([("1", "a"), ("1", "a")], "id string, name string")
    out = lookup(df, dim, [("k", "id")], {"name": "nm"}, default="N/A")
    assert rows(out) == [("1", "a"), ("2", "N/A")]
