"""Application-log ETL: parse, new-visitor repair, split (PRJ-1, PRJ-25,
PRJ-26, SEQ-6, SPL-1 … SPL-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.cdc import parse_json_once
from tillstream.operators.sequence import repair_is_new  # noqa: F401  (re-export)
from tillstream.schemas import LOG


def parse_log_tagged(text: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ-1 for jobs that route good and bad messages from one parse: the log's
    fields, ``_raw`` and ``_ok`` (a log needs ``common`` and ``ts``)."""
    return parse_json_once(text, value_col, LOG).withColumn(
        "_ok", F.col("common").isNotNull() & F.col("ts").isNotNull())


def parse_log(text: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """PRJ-1: JSON text → (parsed logs, bad text)."""
    keep = [c for c in text.columns if c != value_col]
    parsed = parse_log_tagged(text, value_col)
    good = parsed.where("_ok").select(*LOG.fieldNames(), *keep)
    bad = parsed.where("not _ok").select(*keep, F.col("_raw").alias(value_col))
    return good, bad


def split_counts(log: DataFrame) -> DataFrame:
    """Rows of each output of :func:`split_log`, counted in one pass."""
    is_start = F.col("start").isNotNull()
    elements = lambda c: F.when(is_start, 0).otherwise(F.coalesce(F.size(c), F.lit(0)))
    each = {"err": F.col("err").isNotNull().cast("int"), "start": is_start.cast("int"),
            "display": elements("displays"), "action": elements("actions"),
            "page": (~is_start).cast("int")}
    counts = log.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in each.items()])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("stream"), F.col(k).alias("n_rows")) for k in each])).alias("s")).select("s.*")


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """SPL-1 … SPL-3: five outputs from one parsed log.

    * ``err``: logs carrying an ``err`` object (whole log);
    * ``start``: start logs, without ``err``;
    * ``display`` / ``action``: one row per array element with the page context
      (actions carry no top-level ``ts``);
    * ``page``: page logs without ``err``, ``displays`` and ``actions``.

    Each output is a filter/explode over the same input; written together from
    one ``foreachBatch`` the input is read once per micro-batch.
    """
    no_err = log.drop("err")
    is_start = F.col("start").isNotNull()
    pages = no_err.where(~is_start)
    return {
        "err": log.where(F.col("err").isNotNull()),
        "start": no_err.where(is_start).drop("page", "displays", "actions"),
        "display": pages.where(F.size(F.coalesce("displays", F.array())) > 0).select(
            "common", "page", F.explode("displays").alias("display"), "ts",
            *[c for c in log.columns if c not in LOG.fieldNames()]),
        "action": pages.where(F.size(F.coalesce("actions", F.array())) > 0).select(
            "common", "page", F.explode("actions").alias("action"),
            *[c for c in log.columns if c not in LOG.fieldNames()]),
        "page": pages.drop("displays", "actions", "start"),
    }
