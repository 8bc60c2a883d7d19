"""JDBC reader and writer (SRC-7 … SRC-9, SNK-9, SNK-10, UDX-4).

Spark's JDBC source keeps SQL aliases as column names (what ``queryList2``
adds over ``queryList``); ``camel=True`` renames snake_case columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def snake_to_camel(name: str) -> str:
    """SRC-9: ``sink_table`` → ``sinkTable``."""
    return re.sub(r"_([a-z0-9])", lambda m: m.group(1).upper(), name)


def read_jdbc(spark: SparkSession, url: str, query: str, camel: bool = False,
              properties: dict | None = None, num_partitions: int | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None) -> DataFrame:
    """SRC-7 / SRC-8: rows of ``query``.  For large tables pass a numeric
    ``partition_column`` with bounds so the read is split over tasks."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper)
             .option("numPartitions", num_partitions or 8))
    else:
        r = r.option("query", query)
    df = r.load()
    return df.toDF(*[snake_to_camel(c) for c in df.columns]) if camel else df


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 500,
               types: str | None = None, mode: str = "append",
               properties: dict | None = None) -> None:
    """SNK-9 / SNK-10: append rows in batches of ``batchsize`` (one transaction
    per partition batch); ``types`` sets the created table's column types."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batchsize)
    if types:
        w = w.option("createTableColumnTypes", types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def run_sql(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """UDX-4: a parameterised query against registered views / tables."""
    return spark.sql(query, args=args or {})
