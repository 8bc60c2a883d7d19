"""Language identification with hyperdimensional profiles.

Every letter has a random ±1 vector; the trigram abc is bound as
rot2(a) * rot1(b) * c (rotation is the permutation, the product the binding)
and a text is the bundle (sum) of its trigrams' vectors.  A language's
prototype bundles the texts labelled with it; a document gets the language
whose prototype has the largest cosine with the document's vector.

Sums are integers, so prototypes do not depend on the order of rows or tasks.
Letters are lower-cased; runs of anything else are one blank, which is a
symbol of its own at word ends.

Defined cases: a text that is null or has no letter is ``und`` with score 0,
as is every text when no labelled language could be learnt; equal cosines go
to the alphabetically first language; empty tables give no rows; repeated rows
are each returned; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_remainder, raw

DIMENSIONS = 1024
SYMBOLS = 128            # blank, then letters; rarer letters share a symbol by hash
SEED = 20240917
MAX_LANGUAGES = 2_000    # prototypes travel to the workers; larger sets are refused
BLOCK = 1 << 18          # characters whose trigrams are counted at once
ROWS = 128               # documents in a block
SLICE = 1 << 13          # trigrams whose vectors are built at once


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Code point -> symbol: 0 for non-letters, a-z and Latin letters on their
    own symbols, letters of other scripts spread over the rest."""
    table = np.zeros(0x110000, np.int16)
    own: dict[int, int] = {}
    for c in list(range(0x61, 0x7B)) + list(range(0xDF, 0x100)) + [0x153]:
        if chr(c).isalpha():
            own[c] = len(own) + 1
    first = len(own) + 1
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = own.get(low) or first + (low * 2654435761 >> 7) % (SYMBOLS - first)
    return table


@lru_cache(maxsize=2)
def letter_vectors(dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols' vectors, rotated by two places, by one and not at all."""
    v = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions))
    return np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v


def trigram_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    a, b, c = letter_vectors(dimensions)
    return (a[codes // (SYMBOLS * SYMBOLS)] * b[codes // SYMBOLS % SYMBOLS] * c[codes % SYMBOLS])


def bundled(counts: np.ndarray, codes: np.ndarray, dimensions: int) -> np.ndarray:
    """counts (rows x trigrams) times the trigrams' vectors, a slice at a time."""
    out = np.zeros((len(counts), dimensions), counts.dtype)
    for k in range(0, len(codes), SLICE):
        out += counts[:, k:k + SLICE] @ trigram_vectors(codes[k:k + SLICE], dimensions).astype(counts.dtype)
    return out


def trigrams(text: bytes) -> np.ndarray:
    """Codes of a text's trigrams of symbols, blanks collapsed."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
    s = _symbols()[points]
    if not s.any():
        return np.zeros(0, np.int32)
    s = np.concatenate(([0], s, [0]))
    s = s[(s > 0) | np.r_[True, s[:-1] > 0]].astype(np.int32)
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


def _counted(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of documents: (rows of the block, distinct trigrams, counts as a
    rows x trigrams matrix).  A block holds at most ``BLOCK`` trigrams, or one
    longer text alone: it ends before a text that would pass this."""
    rows, codes, size = [], [], 0

    def block():
        flat = np.concatenate(codes)
        seen = np.zeros(SYMBOLS ** 3, bool)
        seen[flat] = True
        distinct = np.flatnonzero(seen)
        place = np.zeros(SYMBOLS ** 3, np.int32)
        place[distinct] = np.arange(len(distinct))
        at = np.repeat(np.arange(len(rows)), [len(c) for c in codes])
        counts = np.bincount(at * len(distinct) + place[flat], minlength=len(rows) * len(distinct))
        return np.array(rows), distinct, counts.reshape(len(rows), -1)

    for r, t in enumerate(texts):
        c = trigrams(t)
        if not len(c):
            continue
        if rows and (size + len(c) > BLOCK or len(rows) == ROWS):
            yield block()
            rows, codes, size = [], [], 0
        rows.append(r)
        codes.append(c)
        size += len(c)
    if rows:
        yield block()


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of every non-null language: the sum of its texts' vectors.
    Workers bundle per batch; Spark sums (language, dimension) cells."""
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), dtype=object)
            for rows, codes, counts in _counted(b.column("raw").to_pylist()):
                names = sorted(set(lang[rows]))
                mine = np.array([counts[lang[rows] == n].sum(axis=0) for n in names], np.float64)
                for name, v in zip(names, bundled(mine, codes, dimensions)):
                    total[name] = total.get(name, 0) + v.astype(np.int64)
        for name, v in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions), pa.int32()),
                 pa.array(v, pa.int64())], ["lang", "dim", "value"])

    cells = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
             .select(F.col("lang").cast("string").alias("lang"), raw("text").alias("raw"))
             .mapInArrow(bundle, "lang STRING, dim INT, value BIGINT")
             .groupBy("lang", "dim").agg(F.sum("value").alias("value")))
    rows = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
    found = rows.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array([x["value"] for x in r["v"]], np.float64) for r in found}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dimensions: int = DIMENSIONS,
            keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score = the winning cosine, within 0..1."""
    names = sorted(n for n, v in prototypes.items() if np.any(v))
    unit = np.array([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names], np.float32)
    fields = [docs.schema[k] for k in keep] + [T.StructField("lang_pred", T.StringType()),
                                               T.StructField("score", T.DoubleType())]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.full(b.num_rows, "und", dtype=object)
            score = np.zeros(b.num_rows)
            if names:
                for rows, codes, counts in _counted(b.column("raw").to_pylist()):
                    v = bundled(counts.astype(np.float32), codes, dimensions)
                    norm = np.linalg.norm(v, axis=1)
                    cosine = v @ unit.T / np.where(norm > 0, norm, 1)[:, None]
                    best = cosine.argmax(axis=1)
                    lang[rows] = [names[k] for k in best]
                    score[rows] = np.clip(cosine[np.arange(len(rows)), best], 0, 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in keep] + [pa.array(lang.tolist(), pa.string()),
                                               pa.array(score, pa.float64())],
                [f.name for f in fields])

    return docs.select(*keep, raw("text").alias("raw")).mapInArrow(compare, T.StructType(fields))


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2,
             dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): prototypes from the documents whose
    crc32 remainder is not ``held_out``, applied to all."""
    fold = F.coalesce(crc_remainder("doc_id", folds) == held_out, F.lit(False))
    learnt = learn(docs.select("doc_id", "text", "lang").filter(~fold), dimensions)
    own = docs.select("doc_id", "text", fold.alias("held_out"))
    return predict(own, learnt, dimensions, ("doc_id", "held_out"))
