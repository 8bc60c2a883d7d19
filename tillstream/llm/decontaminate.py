"""Benchmark decontamination by pigeonhole edit matching.

Texts and benchmark items are compared as sequences of words: lower-cased, with
everything but letters and digits taken as a separator and every letter of a
script written without blanks as a word.  An item of m words may differ from a
passage by e word edits, e the whole part of ``ERRORS`` of m.  A passage within
e edits must contain one of e+1 pieces unchanged, so exact piece hits
(Aho-Corasick, one pass over the text) name all candidates, and each is
verified by Myers' bit-parallel edit distance over the words around the hit.

The benchmark is a stated query set: it is taken in blocks of at most ``BLOCK``
items, each broadcast and held against every row.

Defined cases: null and empty texts match nothing; items that are null or have
no word are skipped; an item too short to be telling (``telling``) matches only
a text that has exactly its words; an item that occurs several times in a text is
returned once with its closest (then first) place; several items with one text
are each returned; repeated rows are each returned; an empty benchmark or
table gives no matches; other columns are passed through by
``keep_uncontaminated`` and otherwise ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import raw, slices

ERRORS = 0.2
PIECE = 4
BLOCK = 20_000
MEMO = 150_000
LETTERS = 20             # letters that are telling in fewer than PIECE words: those of PIECE usual ones
_SEPARATOR = re.compile(r"[\W_]+")
_HAN = "\u3005-\u3007\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
# Thai, Lao, Myanmar, Khmer, Tai, Balinese, kana, Bopomofo, Yi, Javanese
_OTHERS = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\u3040-\u312f"
           "\u31a0-\u31bf\u31f0-\u31ff\ua000-\ua48f\ua980-\ua9df\uff66-\uff9f\U0001b000-\U0001b16f")
_UNSPACED = re.compile(f"([{_HAN}{_OTHERS}])")
_IS_HAN, _IS_OTHER = re.compile(f"[{_HAN}]"), re.compile(f"[{_OTHERS}]")


class Words(dict):
    """Chunk -> its normal words joined by blanks, memoised per process."""

    def __missing__(self, chunk: str) -> str:
        low = chunk.lower()
        if not low.isascii():
            low = _UNSPACED.sub(r" \1 ", low)
        got = _SEPARATOR.sub(" ", low).strip()
        if len(self) >= MEMO:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = got
        return got

    def normal(self, text: str) -> str:
        return " ".join(filter(None, map(self.__getitem__, text.split())))


def budget(m: int) -> int:
    """Largest number of edits allowed for an item of ``m`` words."""
    return int(m * ERRORS)


def telling(words: list[str]) -> bool:
    """Whether finding an item inside a longer text tells that it was copied: it has ``PIECE`` words, two
    Han letters or four of another script without blanks counting as one, or
    ``LETTERS`` letters and digits in fewer words with blanks."""
    quarters, letters = 0, 0
    for w in words:
        if _IS_HAN.match(w):
            quarters += 2
        elif _IS_OTHER.match(w):
            quarters += 1
        else:
            quarters += 4
            letters += len(w)
    return quarters >= 4 * PIECE or letters >= LETTERS


def pieces(m: int, e: int) -> list[tuple[int, int]]:
    """e+1 consecutive (begin, end) word ranges that cover 0..m evenly."""
    cuts = [m * k // (e + 1) for k in range(e + 2)]
    return list(zip(cuts, cuts[1:]))


def myers(pattern: list[str], text: list[str]) -> list[int]:
    """For every end position of ``text`` (words read so far, from 1) the least
    edit distance of ``pattern`` to a passage that ends there; Myers' bit
    vectors, one Python integer each."""
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    bits: dict[str, int] = {}
    for k, w in enumerate(pattern):
        bits[w] = bits.get(w, 0) | 1 << k
    plus, minus, distance, out = full, 0, m, []
    for w in text:
        eq = bits.get(w, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        out.append(distance)
    return out


class Matcher:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple[object, str]]):
        import ahocorasick
        self.words = Words()
        self.items = []
        at: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            w = self.words.normal(text).split()
            if not w:
                continue
            k = len(self.items)
            self.items.append((item_id, w, budget(len(w)), telling(w)))
            for begin, end in pieces(len(w), self.items[k][2]):
                at.setdefault(" " + " ".join(w[begin:end]) + " ", []).append((k, begin))
        self.automaton = ahocorasick.Automaton()
        for key, where in at.items():
            self.automaton.add_word(key, (key.count(" ") - 1, where))
        if at:
            self.automaton.make_automaton()
        self.any = bool(at)

    def find(self, text: str) -> list[tuple[object, int, int, int, bool]]:
        """(item id, distance, begin word, end word, telling) of each item in
        ``text``."""
        normal = self.words.normal(text)
        found = self._places(normal) if normal and self.any else {}
        return [(self.items[k][0], *v, self.items[k][3]) for k, v in sorted(found.items())]

    def leaks(self, text: str) -> bool:
        """Whether ``text`` holds a telling item, or is nothing but an item."""
        normal = self.words.normal(text)
        found = self._places(normal) if normal and self.any else {}
        whole = (0, normal.count(" ") + 1)
        return any(self.items[k][3] or place[1:] == whole for k, place in found.items())

    def _places(self, normal: str) -> dict[int, tuple[int, int, int]]:
        """(distance, begin word, end word) by item number."""
        found: dict[int, tuple[int, int, int]] = {}
        hits = list(self.automaton.iter(f" {normal} "))
        if hits:
            w = normal.split(" ")
            starts, place = {}, 0
            for k, x in enumerate(w):  # character after a word -> its number
                place += len(x) + 1
                starts[place] = k
            tried: set[tuple[int, int]] = set()
            for end, (size, where) in hits:
                first = starts[end] - size + 1
                for k, begin in where:
                    start = first - begin
                    if (k, start) not in tried:
                        tried.add((k, start))
                        self._verify(k, start, w, found)
        return found

    def _verify(self, k: int, start: int, w: list[str], found: dict) -> None:
        _, pattern, e, _ = self.items[k]
        if e == 0:      # the hit is the whole item
            if k not in found:
                found[k] = (0, start, start + len(pattern))
            return
        low, high = max(0, start - e), min(len(w), start + len(pattern) + e)
        passage = w[low:high]
        distances = myers(pattern, passage)
        best = min(distances)
        if best > e:
            return
        end = distances.index(best) + 1
        back = myers(pattern[::-1], passage[:end][::-1])
        begin = end - (back.index(min(back)) + 1)
        place = (best, low + begin, low + end)
        if k not in found or place < found[k]:
            found[k] = place


_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, items) -> Matcher:
    """The worker's matcher of a broadcast block, built once per process."""
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items.value)
    return _MATCHERS[key]


def _blocks(benchmark: DataFrame, block: int):
    """Broadcasts of at most about ``block`` items each, one at a time."""
    items = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    n = -(-items.count() // block)
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield uuid.uuid4().hex, benchmark.sparkSession.sparkContext.broadcast(
            sorted([(r["item_id"], r["text"]) for r in rows], key=lambda x: (x[0] is None, x)))


def matches(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, distance, begin_word, end_word, telling): every item
    found in every document, places counted in normal words."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("item_id", benchmark.schema["item_id"].dataType),
        T.StructField("distance", T.IntegerType()), T.StructField("begin_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("telling", T.BooleanType())])
    out = None
    for key, items in _blocks(benchmark, block):
        def find(batches: Iterator[pa.RecordBatch], key=key, items=items) -> Iterator[pa.RecordBatch]:
            m = _matcher(key, items)
            for b in (part for batch in batches for part in slices(batch)):
                row, hit = [], []
                for r, t in enumerate(b.column("raw").to_pylist()):
                    for h in m.find(t.decode("utf-8", "replace")):
                        row.append(r)
                        hit.append(h)
                columns = list(zip(*hit)) or [()] * 5
                item_type = pa.array([x[0] for x in m.items]).type if m.items else pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(columns[0], item_type),
                     pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                     pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.bool_())], schema.fieldNames())
        part = docs.select("doc_id", raw("text").alias("raw")).mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _clean(key: str, items):
    @F.pandas_udf(T.BooleanType())
    def clean(t: pd.Series) -> pd.Series:
        m = _matcher(key, items)
        return t.map(lambda x: not m.leaks(x.decode("utf-8", "replace"))).astype(bool)
    return clean


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without those that hold a telling item or are nothing
    but an item, all columns kept: the few words of a shorter item inside a text
    (:func:`matches` names them) do not condemn it."""
    for key, items in _blocks(benchmark, block):
        docs = docs.filter(_clean(key, items)(raw(docs["text"])))
    return docs
