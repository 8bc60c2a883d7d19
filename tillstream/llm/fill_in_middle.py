"""Fill-in-the-middle rearrangement behind a learned rank index.

A text is cut into units (lines).  The offsets of all its unit ends form a
sorted table from rank to offset; a piecewise-linear model replaces that table:
segments, each a straight line that stays within ``ERROR`` of every offset it
covers, and one small residual per rank.  A cut at a rank is predicted by the
line of its segment and corrected exactly by the stored residual, so the index
answers any rank without the offsets.  :func:`rank_index` gives the index of
every document as a table; :func:`fill_in_middle` builds it for a text, asks it
for the two cuts and writes prefix, suffix and middle in one of two orders.

Everything is row-local: no shuffle, a task holds the index of one text.

Defined cases: a null or empty text has no units and stays plain; a text that
contains a marker stays plain; a null ``doc_id`` is hashed as an empty id;
repeated rows give equal results; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import raw, slices

ERROR = 127                  # greatest distance of an offset from its line
STEP = 64                    # ranks looked at first when a segment grows
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


# -- the index --------------------------------------------------------------

@dataclass
class RankIndex:
    """Offsets of ranks 0..n: segment k starts at rank ``first[k]`` and predicts
    ``offset[k] + slope[k] * (rank - first[k])``."""
    first: np.ndarray
    offset: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.first, ranks, side="right") - 1
        return self.offset[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offsets(self, ranks) -> np.ndarray:
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residual[ranks]


def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of a sorted table of offsets, in one pass.

    A segment begins at an offset; every further offset narrows the cone of
    slopes that pass within ``error`` of all of them, and the segment ends
    where the cone closes."""
    y, n = np.asarray(offsets, np.int64), len(offsets)
    first, slope, s = [], [], 0
    while s < n:
        low, high, k, step, closed = -np.inf, np.inf, 0, STEP, False
        while s + k + 1 < n and not closed:
            run = np.arange(k + 1, min(k + step, n - 1 - s) + 1)
            rise = y[s + run] - y[s]
            lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
            highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
            fits = int(np.argmin(lows <= highs)) if (lows > highs).any() else len(run)
            closed = fits < len(run)
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            k, step = k + fits, 2 * step
        first.append(s)
        slope.append((low + high) / 2 if k else 0.0)
        s += k + 1
    index = RankIndex(np.array(first, np.int64), y[first] if n else y, np.array(slope, np.float64),
                      np.zeros(n, np.int16))
    gap = y - index.predict(np.arange(n))
    index.residual = gap.astype(np.int16 if n == 0 or np.abs(gap).max() < 2 ** 15 else np.int64)
    return index


def line_ends(text: bytes) -> np.ndarray:
    """Byte offsets of ranks 0..n of a text of n lines."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if len(text) and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends])


def rank_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """(doc_id, n, segments, residuals) per row: the stored form of the index;
    residuals are little-endian 64-bit integers narrowed to ``width`` bytes."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("first", T.ArrayType(T.LongType())), T.StructField("offset", T.ArrayType(T.LongType())),
        T.StructField("slope", T.ArrayType(T.DoubleType())), T.StructField("residual", T.BinaryType()),
        T.StructField("width", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            got = [fit(line_ends(t), error) for t in b.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([len(g.residual) - 1 for g in got], pa.int64()),
                pa.array([g.first for g in got], pa.list_(pa.int64())),
                pa.array([g.offset for g in got], pa.list_(pa.int64())),
                pa.array([g.slope for g in got], pa.list_(pa.float64())),
                pa.array([g.residual.tobytes() for g in got], pa.binary()),
                pa.array([g.residual.itemsize for g in got], pa.int32())], schema.fieldNames())

    return docs.select("doc_id", raw("text").alias("raw")).mapInArrow(run, schema)


# -- the transformation -----------------------------------------------------

def draws(doc_id, seed: int) -> list[int]:
    """Four 32-bit numbers that depend on the id and the seed only."""
    name = "" if doc_id is None else str(doc_id)
    d = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return [int.from_bytes(d[k:k + 4], "big") for k in (0, 4, 8, 12)]


def _points(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def rearrange(doc_id, text: bytes, seed: int, fim_percent: int, spm_percent: int):
    """(n, form, prefix_chars, middle_chars, output, segments) of one text."""
    index = fit(line_ends(text))
    n = len(index.residual) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text, len(index.first)
    lo, hi = index.offsets(sorted((h1 % (n + 1), h2 % (n + 1)))).tolist()
    head, middle, tail = text[:lo], text[lo:hi], text[hi:]
    p, s, m = MARKS
    spm = h4 % 100 < spm_percent
    out = b"".join([s, tail, p, head, m, middle] if spm else [p, head, s, tail, m, middle])
    return n, "spm" if spm else "psm", _points(head), _points(middle), out, len(index.first)


def fill_in_middle(docs: DataFrame, seed: int = 7, fim_percent: int = 100,
                   spm_percent: int = 50) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, segments) per row;
    ``segments`` is the number of line segments of the text's index."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
        T.StructField("segments", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch)):
            got = [rearrange(i, t, seed, fim_percent, spm_percent)
                   for i, t in zip(b.column("doc_id").to_pylist(), b.column("raw").to_pylist())]
            n, form, head, middle, out, segments = zip(*got) if got else [[]] * 6
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                pa.array(head, pa.int64()), pa.array(middle, pa.int64()),
                pa.array(out, pa.binary()).cast(pa.string()), pa.array(segments, pa.int64())],
                schema.fieldNames())

    return docs.select("doc_id", raw("text").alias("raw")).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  No marker occurs in its parts, so
    each marker names one place."""
    def between(start: str, end: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(start), F.lit(2)), F.lit(end), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
