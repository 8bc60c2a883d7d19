"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import materialize, scratch_path, ship_package

__all__ = ["table", "saved", "scratch_path", "ship_package", "path_exists", "blank", "raw", "without_space",
           "crc_remainder", "same", "slices", "join_groups"]

# The ASCII white space that the contracts name: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark only (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    lineage is cut by files every executor sees, and values that Spark may not
    compute twice alike (random numbers, generated ids) become fixed."""
    return materialize(df, name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def blank(c: str | Column) -> Column:
    """Null text counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def raw(c: str | Column) -> Column:
    """UTF-8 bytes of a text column, null as empty: Python workers split bytes
    at ASCII white space without decoding."""
    return F.encode(blank(c), "UTF-8")


def without_space(c: str | Column) -> Column:
    """Delete every ASCII white-space character."""
    return F.regexp_replace(c, r"[\x20\x09-\x0D]+", "")


def crc_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null id: null)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(c.cast("string"), "UTF-8")) % n


def slices(batch, rows: int = 256):
    """A record batch in small parts: a worker then holds the Python objects of
    few texts at a time, whatever size Spark gives its batches."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def same(a: Column, b: Column) -> Column:
    """Null-safe equality (an equi-join key for Spark as well)."""
    return a.eqNullSafe(b)


HOT_KEYS = 512           # a key with over 1/512 of all rows is joined by broadcast


def join_groups(rows: DataFrame, groups: DataFrame, key: str, members: str, total: int) -> DataFrame:
    """``rows`` (``total`` of them) joined with the one row per ``key`` of
    ``groups``, which says in ``members`` how many rows the key has.  Fewer than
    ``HOT_KEYS`` keys can have more than a ``HOT_KEYS``-th of all rows: these are
    broadcast, so that a hot key's rows stay where they are; the rest meet by a
    shuffle."""
    many = F.col(members) > total / HOT_KEYS
    hot, cold = groups.filter(many), groups.filter(~many)
    other = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(other.join(cold, key))
