"""File loaders (SRC-14 … SRC-17) and dimension reads (SRC-10 … SRC-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_region_codes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14: lines ``<code> <province>,<city>,<area>`` → code bigint,
    province, city, area (missing parts are null)."""
    raw = spark.read.text(path)
    parts = F.split(F.trim("value"), r"\s+", 2)
    origin = F.split(F.get(parts, 1), ",", 3)
    return raw.where(F.trim("value") != "").select(
        F.get(parts, 0).cast("bigint").alias("code"),
        F.get(origin, 0).alias("province"), F.get(origin, 1).alias("city"),
        F.get(origin, 2).alias("area"))


def load_words(spark: SparkSession, path: str) -> DataFrame:
    """SRC-15: one word per line, trimmed, blanks skipped, de-duplicated."""
    return (spark.read.text(path).select(F.trim("value").alias("word"))
            .where(F.col("word") != "").distinct())


def city_list(regions: DataFrame, excluded_provinces: Sequence[str]) -> DataFrame:
    """SRC-16: rows with a city, outside the excluded provinces."""
    return regions.where(F.col("city").isNotNull() & (F.col("city") != "")
                         & ~F.col("province").isin(*excluded_provinces))


WEATHER_LIVE = T.StructType([T.StructField(n, T.StringType()) for n in [
    "province", "city", "adcode", "weather", "temperature", "winddirection", "windpower",
    "humidity", "reporttime"]])
WEATHER = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("info", T.StringType()),
    T.StructField("lives", T.ArrayType(WEATHER_LIVE))])


def flatten_weather(responses: DataFrame, payload_col: str = "payload") -> DataFrame:
    """SRC-17: landed API responses joined to their region row → one detail row
    per successful response: code, province, city (falls back to the region's
    city), area (falls back to the region's area), info, the first ``lives``
    element as JSON, and the report time."""
    p = responses.withColumn("_w", F.from_json(F.col(payload_col), WEATHER))
    live = F.get(F.col("_w.lives"), 0)
    return p.where(F.col("_w.status") == "1").select(
        "code", "province", F.coalesce(live["city"], F.col("city")).alias("city"),
        F.coalesce(F.col("area"), live["city"]).alias("area"), F.col("_w.info").alias("info"),
        F.to_json(live).alias("lives"), F.to_timestamp(live["reporttime"]).alias("report_time"))


def write_dimension(df: DataFrame, path: str, key_col: str, row_group_bytes: int = 8 << 20,
                    files: int | None = None) -> None:
    """A dimension laid out for point reads (SRC-10): ranges of the key, sorted
    within each file, with a Bloom filter of the key per row group.  A read of
    one key opens the one file, and decodes the one row group, whose key range
    and filter admit it.  ``files`` defaults to Spark's own number."""
    ranged = df.repartitionByRange(files, key_col) if files else df.repartitionByRange(key_col)
    (ranged.sortWithinPartitions(key_col).write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{key_col}", "true").parquet(path))


def point_lookup(dim: DataFrame, key_col: str, key) -> DataFrame:
    """SRC-10: the row of one key (empty when absent); the comparison is pushed
    down to the scan."""
    return dim.where(F.col(key_col) == F.lit(key))


def scan_limit(dim: DataFrame, n: int, key_col: str) -> DataFrame:
    """SRC-11 / TOP-1: the first ``n`` rows of a dimension in the order of its
    row key, as a table scan gives them; the key is also the column
    ``row_key``.  Planned as a top-n, so no task returns more than ``n`` rows."""
    return dim.withColumn("row_key", F.col(key_col).cast("string")).orderBy("row_key").limit(n)


def row_count(dim: DataFrame) -> int:
    """SRC-12."""
    return dim.count()
