"""Change-record core: parse, filter, row images, config routing, upsert
(SRC-3/4, PRJ-1/2/4/12/13/14, JN-8/9/10, SNK-4/6/7).

A change record is ``before``/``after`` row images (string maps), ``source``
metadata, ``op`` (r/c/u/d) and ``ts_ms``.  Routing configuration is a small
table joined by broadcast; its size is checked, never assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions.text import map_keep_keys
from tillstream.schemas import ENVELOPE

# Fixed value: how a configured source_type maps to a change op.
SOURCE_TYPE_TO_OP = {"insert": "c", "update": "c", "delete": "d"}
SOURCE_TYPE_DEFAULT_OP = "u"


def parse_envelope(text: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """SRC-3 / PRJ-1: JSON text → (good envelopes, bad text).

    Each message is parsed once (``inline_outer`` materialises the struct, so
    the optimizer cannot split it into one parse per field).  Malformed text
    parses to nulls; a record without ``op`` and ``source`` is bad.  Bad rows
    are returned, not silently dropped."""
    parsed = parse_envelope_tagged(text, value_col)
    good = parsed.where(F.col("_ok")).drop("_raw", "_ok")
    bad = parsed.where(~F.col("_ok")).select(F.col("_raw").alias(value_col))
    return good, bad


def parse_envelope_tagged(text: DataFrame, value_col: str = "value") -> DataFrame:
    """One parse of every message with an ``_ok`` flag (for single-pass jobs
    that route good and bad records from the same scan)."""
    parsed = parse_json_once(text, value_col, ENVELOPE)
    return parsed.withColumn("_ok", F.col("op").isNotNull() & F.col("source").isNotNull())


def parse_json_once(text: DataFrame, value_col: str, schema) -> DataFrame:
    """``text`` columns (minus ``value_col``) + ``_raw`` + the schema's fields."""
    keep = [c for c in text.columns if c != value_col]
    return text.select(*keep, F.col(value_col).alias("_raw"), F.inline_outer(F.array(
        F.from_json(F.col(value_col), schema, {"mode": "PERMISSIVE"}))))


def ods_filter(changes: DataFrame, keep_deletes: bool = False) -> DataFrame:
    """PRJ-2 / PRJ-3: keep records whose ``after`` image is present and non-empty
    (deletes too when ``keep_deletes``)."""
    return changes.where(ods_filter_cond(keep_deletes))


def ods_filter_cond(keep_deletes: bool = False):
    has_after = F.col("after").isNotNull() & (F.size("after") > 0)
    if keep_deletes:
        has_after = has_after | ((F.col("op") == "d") & F.col("before").isNotNull())
    return has_after


def table_changes(changes: DataFrame, table: str | Sequence[str],
                  ops: Sequence[str] | None = None) -> DataFrame:
    """PRJ-4: records of one (or several) source tables, optionally by op."""
    tables = [table] if isinstance(table, str) else list(table)
    cond = F.col("source")["table"].isin(*tables)
    if ops:
        cond = cond & F.col("op").isin(*ops)
    return changes.where(cond)


def row_image(changes: DataFrame, data_col: str = "data") -> DataFrame:
    """PRJ-12: the ``before`` image for deletes, else ``after``."""
    return changes.withColumn(
        data_col, F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")))


def row_image_flat(changes: DataFrame, data_col: str = "data") -> DataFrame:
    """PRJ-13: ``after`` when present and non-empty, else ``before``; ``op`` and
    ``tm_ms`` are added to the image."""
    img = F.when(F.col("after").isNotNull() & (F.size("after") > 0), F.col("after")) \
           .otherwise(F.col("before"))
    extra = F.create_map(F.lit("op"), F.col("op"), F.lit("tm_ms"), F.col("ts_ms").cast("string"))
    return changes.withColumn(data_col, map_put(img, extra))


def map_put(image: Column, extra: Column) -> Column:
    """A map with the entries of ``extra``, which replace its own."""
    own = F.coalesce(image, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key(extra, k)), extra)


def source_type_op(source_type) -> Column:
    """JN-9 key: configured ``source_type`` → change op."""
    st = F.col(source_type) if isinstance(source_type, str) else source_type
    expr = None
    for k, v in SOURCE_TYPE_TO_OP.items():
        expr = F.when(st == k, v) if expr is None else expr.when(st == k, v)
    return expr.otherwise(F.lit(SOURCE_TYPE_DEFAULT_OP))


def latest_config(config: DataFrame, keys: Sequence[str] = ("source_table", "source_type")) -> DataFrame:
    """JN-10: latest config row per key by ``ts_ms``; a latest ``op='d'`` removes it."""
    cols = [c for c in config.columns if c not in keys]
    last = (config.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.struct("ts_ms", *cols)).alias("_l"))
            .select(*keys, "_l.*"))
    return last.where(F.coalesce(F.col("op"), F.lit("r")) != "d").drop("op")


def prune(df: DataFrame, data_col: str = "data", columns_col: str = "sink_columns") -> DataFrame:
    """PRJ-14: keep only the image keys listed in the config's column list."""
    return df.withColumn(data_col, map_keep_keys(data_col, columns_col))


def route_dims(changes: DataFrame, config: DataFrame) -> DataFrame:
    """JN-8: dimension routing.  Each change of a configured table becomes
    ``(sink_table, row_key, op, data)`` with the image pruned to the configured
    columns; the row key is the *value* of the configured key column.  Deletes
    carry their ``before`` image so the sink can remove the key (SNK-7)."""
    cfg = (latest_config(config, ["source_table"]).select(
        "source_table", "sink_table", "sink_columns", "sink_row_key"))
    img = row_image(ods_filter(changes, keep_deletes=True))
    j = img.join(cfg, img["source"]["table"] == cfg["source_table"], "inner")
    out = prune(j).select(
        "sink_table", F.col("data")[F.col("sink_row_key")].alias("row_key"), "op",
        "data", "ts_ms")
    return out


def route_facts(changes: DataFrame, config: DataFrame,
                tables: Sequence[str] | None = None) -> DataFrame:
    """JN-9: fact routing keyed by ``(table, op)``; the config's ``source_type``
    is mapped to an op.  Output ``(sink_table, data)`` where ``data`` is the
    pruned ``after`` image plus ``ts_ms``."""
    cfg = latest_config(config.withColumn("source_type", source_type_op("source_type")))
    if tables is not None:
        cfg = cfg.where(F.col("source_table").isin(*tables))
    cfg = (cfg.select("source_table", "source_type", "sink_table", "sink_columns"))
    c = ods_filter(changes)
    j = c.join(cfg, (c["source"]["table"] == cfg["source_table"]) & (c["op"] == cfg["source_type"]))
    j = j.withColumn("data", F.col("after"))
    j = prune(j)
    return j.select("sink_table", map_put(
        F.col("data"), F.create_map(F.lit("ts_ms"), F.col("ts_ms").cast("string"))).alias("data"), "ts_ms")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order`` — a partial + final aggregate."""
    cols = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in order])).alias("_l"))
            .select(*keys, "_l.*"))


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           order: Sequence[str], delete_col: str | None = None,
           keep_tombstones: bool = False) -> DataFrame:
    """SNK-4 / SNK-6 / SNK-7 upsert by primary key, keeping the max version.

    Target and batch rows compete in one aggregate; the latest by ``order``
    wins, whatever the arrival order, so a replayed or late batch never
    overwrites newer data.  A winning row flagged by ``delete_col`` removes the
    key (or stays as a tombstone with ``keep_tombstones``, so an older row
    arriving later cannot resurrect it).  Each side is read once, and the
    aggregate's map-side half already leaves one row per key and task."""
    flag = delete_col or "__deleted"
    rows = batch if flag in batch.columns else batch.withColumn(flag, F.lit(False))
    if target is not None:
        t = target if flag in target.columns else target.withColumn(flag, F.lit(False))
        rows = t.unionByName(rows, allowMissingColumns=True)
    latest = latest_per_key(rows, keys, order)
    if keep_tombstones:
        return latest
    return latest.where(~F.coalesce(F.col(flag), F.lit(False))).drop(flag)


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-7: remove rows whose key is listed."""
    return target.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")
