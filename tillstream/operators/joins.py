"""Lookup and interval joins (SRC-10, SRC-13, JN-6/7, JN-11…17, JN-20/21, PRJ-23)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(df: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]] | str,
           cols: Sequence[str] | dict[str, str], default=None, how: str = "left") -> DataFrame:
    """Enrich ``df`` with ``cols`` of ``dim`` matched on ``on`` (``[(df_col, dim_col)]``
    or one shared name).  ``cols`` may map dim column → output name.  Misses keep
    ``default`` (``how='left'``) or are dropped (``how='inner'``).  The dimension
    is de-duplicated on its key first so a lookup never multiplies rows.  Whether
    the dimension is broadcast is Spark's decision, by its measured size."""
    pairs = [(on, on)] if isinstance(on, str) else list(on)
    names = dict(cols) if isinstance(cols, dict) else {c: c for c in cols}
    dkeys = [f"_lk_{i}" for i in range(len(pairs))]
    d = dim.select(*[F.col(dc).alias(k) for (_, dc), k in zip(pairs, dkeys)],
                   *[F.col(c).alias(f"_lv_{o}") for c, o in names.items()])
    d = d.dropDuplicates(dkeys)
    cond = [df[lc] == d[k] for (lc, _), k in zip(pairs, dkeys)]
    j = df.join(d, cond, how)
    out = [df[c] for c in df.columns]
    for o in names.values():
        v = F.col(f"_lv_{o}")
        out.append((F.coalesce(v, F.lit(default)) if default is not None else v).alias(o))
    return j.select(*out)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                  left_ts: str, right_ts: str, lower_ms: int, upper_ms: int,
                  how: str = "inner", right_prefix: str | None = None,
                  bucket_ms: int | None = None) -> DataFrame:
    """Rows of ``right`` whose ``right_ts`` lies in
    ``[left_ts + lower_ms, left_ts + upper_ms]`` (both inclusive), per key.

    Both sides are also keyed by a time bucket of width ``bucket_ms`` (default:
    the interval length); each right row is copied into the few buckets its
    interval touches.  A hot key is thus spread over its time span, and the
    join never pairs all rows of one key.  ``right_prefix`` renames every right
    column (PRJ-23).
    """
    width = max(int(bucket_ms or (upper_ms - lower_ms)), 1)
    rp = right_prefix or ""
    r = right.select(*[F.col(c).alias(rp + c) for c in right.columns])
    rts = F.col(rp + right_ts)
    r = r.withColumn("_ib", F.explode(F.sequence(
        F.floor((rts - upper_ms) / width), F.floor((rts - lower_ms) / width))))
    lft = left.withColumn("_ib", F.floor(F.col(left_ts) / width))
    cond = [lft["_ib"] == r["_ib"]] + [lft[lc] == r[rp + rc] for lc, rc in on]
    cond += [r[rp + right_ts] >= lft[left_ts] + lower_ms, r[rp + right_ts] <= lft[left_ts] + upper_ms]
    j = lft.join(r, cond, how)
    return j.select(*[lft[c] for c in left.columns], *[r[rp + c] for c in right.columns])
