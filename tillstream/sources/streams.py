"""Text and JSON sources (SRC-1 … SRC-6).

The wire format is one JSON message per record.  In production it is a Kafka
topic; offline (tests, replays) it is a folder of text files — the same
DataFrame comes out either way: one ``value STRING`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.operators.cdc import parse_envelope, parse_json_once
from tillstream.operators.logs import parse_log


def read_json_text(spark: SparkSession, path_or_topic: str, start: str = "earliest",
                   bootstrap_servers: str | None = None, streaming: bool = True,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-1 / SRC-2: a text stream of JSON messages as ``value STRING``.

    With ``bootstrap_servers`` the source is the Kafka topic ``path_or_topic``
    starting at ``start`` (``earliest``, ``latest`` or a JSON offset map);
    otherwise it is a folder of newline-delimited text files."""
    if bootstrap_servers:
        reader = spark.readStream if streaming else spark.read
        kafka = (reader.format("kafka")
                 .option("kafka.bootstrap.servers", bootstrap_servers)
                 .option("subscribe", path_or_topic)
                 .option("startingOffsets", start))
        if not streaming:
            kafka = kafka.option("endingOffsets", "latest")
        return kafka.load().select(F.col("value").cast("string").alias("value"))
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path_or_topic)
    return spark.read.text(path_or_topic)


def read_changes(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-3 / SRC-4: change envelopes (and the bad messages)."""
    return parse_envelope(text)


def read_fact(text: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """SRC-5: a DWD fact topic read with its fixed schema."""
    return parse_json_once(text, value_col, schema).drop("_raw")


def read_page_log(text: DataFrame, delay: str = "3 seconds") -> DataFrame:
    """SRC-6: page logs with event time ``et`` = ``ts`` (epoch ms) and a
    bounded-out-of-order watermark.  Logs without a time are left out (the
    reference maps them to time 0)."""
    good, _bad = parse_log(text)
    pages = good.where(F.col("page").isNotNull())
    return (pages.withColumn("et", F.timestamp_millis(F.col("ts")))
            .where(F.col("et").isNotNull()).withWatermark("et", delay))
