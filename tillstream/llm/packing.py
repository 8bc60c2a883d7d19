"""Best-fit packing of tokenised documents with a swap-based local search.

Documents are tokenised where they are read and cut into pieces of at most
``capacity`` tokens.  Pieces get a random slot that is written down with them,
and slots divide them into groups of about ``GROUP`` pieces: each group is
packed on its own, so no task sees more than a bounded number of (slim) rows.
Within a group, best-fit decreasing is followed by a local search among
underfull bins: a document moves, one is exchanged for one, two for one or one
for two, whenever that raises the sum of squared fills, until no fewer bins are
possible or no such exchange is left.  The underfull bins of all groups are
then dealt into groups and packed a second time.

Defined cases: null text is empty and is one piece holding only the closing
id; repeated rows are packed each; a null ``doc_id`` is kept; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import raw, saved, slices
from .tokens import DEFAULT_VOCABULARY, encoder, without_cycles

CAPACITY = 2048
CLOSING_ID = 0
GROUP = 8192             # pieces packed together


# -- pieces -----------------------------------------------------------------

def cut(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, capacity: int = CAPACITY,
        with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType),
              T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, closing, step = encoder(vocabulary), CLOSING_ID.to_bytes(4, "little"), 4 * capacity
        for b in (part for batch in batches for part in slices(batch)):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            with without_cycles():
                encoded = [enc.ids(t) for t in b.column("raw").to_pylist()]
            for r, data in enumerate(encoded):
                data += closing
                for k, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    row.append(r)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            out = [b.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                   pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                   pa.array(crc, pa.int64())]
            if with_ids:
                out.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return docs.select("doc_id", raw("text").alias("raw")).mapInArrow(pieces, T.StructType(fields))


# -- one group --------------------------------------------------------------

def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Each item, largest first, goes to the bin it leaves the least room in.
    A bit set of the free capacities finds that bin without a scan."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        fitting = mask >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            k = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
            bins[k].append(int(i))
        else:
            room, k = capacity, len(bins)
            bins.append([int(i)])
        left = room - size
        if left:
            free[left].append(k)
            mask |= 1 << left
    return bins


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs (Martello and Toth's L2): the volume, and for
    every k the items over ``capacity - k``, alone in a bin, and those over half
    of it, which leave room that items of at least k can fill."""
    n = np.bincount(sizes, minlength=capacity + 1)
    count, volume = n.cumsum(), (n * np.arange(capacity + 1)).cumsum()
    half = capacity // 2
    k = np.arange(half + 1)
    big = count[capacity] - count[half]
    left = (count[capacity - k] - count[half]) * capacity - (volume[capacity - k] - volume[half])
    small = volume[half] - np.r_[0, volume[:half]]
    return int((big + np.maximum(0, -((left - small) // capacity))).max())


class LocalSearch:
    """Underfull bins exchanging documents.

    A step takes tokens out of one bin into a bin at least as full, so the sum
    of squared fills rises with every step and the search ends.  A work list
    holds the bins that changed since they were last held against all others:
    a bin that finds no exchange leaves it until it changes, so every pair of
    bins has been tried as it is when the list is empty."""

    def __init__(self, bins: list[list[int]], sizes: np.ndarray, capacity: int):
        self.bins = [np.array(b, dtype=np.int64) for b in bins]
        self.sizes = sizes
        self.room = np.array([capacity - int(sizes[b].sum()) for b in self.bins])
        self.owner = np.zeros(len(sizes), np.int64)
        for k, b in enumerate(self.bins):
            self.owner[b] = k
        # Pairs of documents of all bins, a bin's rows from begin to end; rows
        # of a bin that changed are dead (owner -1) until they are removed.
        found = [self._pairs(b) for b in self.bins]
        self.pairs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        self.pair_owner = np.repeat(np.arange(len(found)), [f.shape[1] for f in found])
        self.used = self.pairs.shape[1]
        ends = np.cumsum([f.shape[1] for f in found], dtype=np.int64)
        self.span = [(int(e) - f.shape[1], int(e)) for e, f in zip(ends, found)]

    def _pairs(self, items: np.ndarray) -> np.ndarray:
        """Rows sum, first, second of the pairs in a bin; documents of one size
        stand for each other, so two of each are enough."""
        items = items[np.argsort(self.sizes[items], kind="stable")]
        mine = self.sizes[items]
        items = items[np.r_[True, True, mine[2:] != mine[:-2]][:len(items)]]
        x, y = np.triu_indices(len(items), 1)
        return np.stack([self.sizes[items[x]] + self.sizes[items[y]], items[x], items[y]])

    def _renew(self, b: int) -> None:
        """Replace the pairs of a bin that changed."""
        begin, end = self.span[b]
        self.pair_owner[begin:end] = -1
        new = self._pairs(self.bins[b])
        n = new.shape[1]
        if self.used + n > self.pairs.shape[1]:
            live = np.flatnonzero(self.pair_owner[:self.used] >= 0)
            size = 2 * (len(live) + n) + 64
            pairs, owner = np.zeros((3, size), np.int64), np.full(size, -1)
            pairs[:, :len(live)], owner[:len(live)] = self.pairs[:, live], self.pair_owner[live]
            self.pairs, self.pair_owner, self.used = pairs, owner, len(live)
            first = np.flatnonzero(np.r_[True, owner[1:len(live)] != owner[:len(live) - 1]][:len(live)])
            self.span = [(0, 0)] * len(self.bins)
            for k, x, y in zip(owner[first], first, np.r_[first[1:], len(live)]):
                self.span[int(k)] = (int(x), int(y))
        self.pairs[:, self.used:self.used + n] = new
        self.pair_owner[self.used:self.used + n] = b
        self.span[b] = (self.used, self.used + n)
        self.used += n

    def _swap(self, a: int, going: list[int], b: int, coming: list[int]) -> tuple[int, int]:
        """Documents ``going`` of bin a and ``coming`` of bin b change places."""
        gain = int(self.sizes[going].sum() - self.sizes[coming].sum())
        self.bins[a] = np.r_[self.bins[a][~np.isin(self.bins[a], going)], coming].astype(np.int64)
        self.bins[b] = np.r_[self.bins[b][~np.isin(self.bins[b], coming)], going].astype(np.int64)
        self.owner[going], self.owner[coming] = b, a
        self.room[a] += gain
        self.room[b] -= gain
        self._renew(a)
        self._renew(b)
        return a, b

    @staticmethod
    def _best(sums: np.ndarray, have: np.ndarray, spare) -> tuple[int, int] | None:
        """(place in ``sums``, place in ``have``) of the exchange with the
        largest gain, sums - have, within ``spare``, one for each of ``have``."""
        if not len(sums) or not len(have):
            return None
        order = np.argsort(sums, kind="stable")
        k = np.searchsorted(sums[order], have + spare, "right") - 1
        gain = np.where(k >= 0, sums[order[k]] - have, 0)
        at = int(gain.argmax())
        return (int(order[k[at]]), at) if gain[at] > 0 else None

    @staticmethod
    def _best_into(sums: np.ndarray, have: np.ndarray, spare: int) -> tuple[int, int] | None:
        """The same with few ``have``, all of one bin with room ``spare``."""
        if not len(sums) or not len(have):
            return None
        order = np.argsort(have, kind="stable")
        k = np.minimum(np.searchsorted(have[order], sums - spare, "left"), len(have) - 1)
        gain = sums - have[order[k]]
        gain = np.where(gain <= spare, gain, 0)
        at = int(gain.argmax())
        return (at, int(order[k[at]])) if gain[at] > 0 else None

    def _others(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and pair rows of the bins in ``mask``."""
        mask = np.r_[mask, False]                               # dead pairs look at the last
        return np.flatnonzero(mask[self.owner]), np.flatnonzero(mask[self.pair_owner[:self.used]])

    def give(self, a: int) -> tuple[int, int] | None:
        """A move out of bin a into one at least as full, else a one-for-one,
        two-for-one or one-for-two exchange; the two bins that changed."""
        mask = (self.room > 0) & (self.room <= self.room[a])
        mask[a] = False
        own, into = self.bins[a], np.flatnonzero(mask)
        if not len(into) or not len(own):
            return None
        for i in own[np.argsort(-self.sizes[own], kind="stable")]:
            fits = into[self.room[into] >= self.sizes[i]]
            if len(fits):                                       # the tightest bin that holds it
                return self._swap(a, [int(i)], int(fits[self.room[fits].argmin()]), [])
        items, rows = self._others(mask)
        begin, end = self.span[a]
        mine, pairs, spare = self.pairs[:, begin:end], self.pairs[:, rows], self.room[self.owner[items]]
        if hit := self._best(self.sizes[own], self.sizes[items], spare):
            j = int(items[hit[1]])
            return self._swap(a, [int(own[hit[0]])], int(self.owner[j]), [j])
        if hit := self._best(mine[0], self.sizes[items], spare):
            j = int(items[hit[1]])
            return self._swap(a, mine[1:, hit[0]].tolist(), int(self.owner[j]), [j])
        if hit := self._best(self.sizes[own], pairs[0], self.room[self.pair_owner[rows]]):
            return self._swap(a, [int(own[hit[0]])], int(self.pair_owner[rows[hit[1]]]),
                              pairs[1:, hit[1]].tolist())
        return None

    def take(self, b: int) -> tuple[int, int] | None:
        """The same steps with bin b as the fuller one."""
        mask = self.room >= self.room[b]
        mask[b] = False
        spare = int(self.room[b])
        items, rows = self._others(mask)
        if not spare or not len(items):
            return None
        sums = self.sizes[items]
        fits = np.flatnonzero(sums <= spare)
        if len(fits):
            i = int(items[fits[sums[fits].argmax()]])
            return self._swap(int(self.owner[i]), [i], b, [])
        own = self.bins[b]
        begin, end = self.span[b]
        mine, pairs = self.pairs[:, begin:end], self.pairs[:, rows]
        if hit := self._best_into(sums, self.sizes[own], spare):
            i = int(items[hit[0]])
            return self._swap(int(self.owner[i]), [i], b, [int(own[hit[1]])])
        if hit := self._best_into(pairs[0], self.sizes[own], spare):
            return self._swap(int(self.pair_owner[rows[hit[0]]]), pairs[1:, hit[0]].tolist(), b,
                              [int(own[hit[1]])])
        if hit := self._best_into(sums, mine[0], spare):
            i = int(items[hit[0]])
            return self._swap(int(self.owner[i]), [i], b, mine[1:, hit[1]].tolist())
        return None

    def run(self, bound: int) -> None:
        """Steps until ``bound`` bins are left or no exchange improves; the
        emptiest bin of the work list comes first."""
        count = sum(len(b) > 0 for b in self.bins)
        listed, changed = set(range(len(self.bins))), set()
        heap = [(-int(r), k) for k, r in enumerate(self.room)]
        heapq.heapify(heap)
        while heap and count > bound:
            room, k = heapq.heappop(heap)
            if k not in listed or -room != self.room[k]:
                continue
            step = None
            if len(self.bins[k]) and self.room[k]:
                step = self.give(k) or (self.take(k) if k in changed else None)
            if step is None:
                listed.discard(k)
                continue
            for x in step:
                listed.add(x)
                changed.add(x)
                heapq.heappush(heap, (-int(self.room[x]), x))
            count -= not len(self.bins[step[0]])


def local_search(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins: the least-filled one that admits an improving
    exchange gives first.  Ends at the lower bound on the number of bins or when
    no exchange improves."""
    bound = lower_bound(sizes, capacity)
    if len(bins) <= bound:
        return bins
    search = LocalSearch(bins, sizes, capacity)
    search.run(bound)
    return [b.tolist() for b in search.bins if len(b)]


def places(bins: list[list[int]], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin number, offset in the bin, tokens in the bin) of every item."""
    number, offset, fill = (np.zeros(len(sizes), np.int64) for _ in range(3))
    for k, b in enumerate(bins):
        number[b] = k
        offset[b] = np.r_[0, sizes[b].cumsum()[:-1]]
        fill[b] = sizes[b].sum()
    return number, offset, fill


def pack_group(sizes: np.ndarray, capacity: int = CAPACITY,
               now: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin number, offset in the bin, tokens in the bin) of every item; with
    ``now``, the bin of each item so far, never in more bins than those."""
    sizes = np.asarray(sizes, dtype=np.int64)
    bins = local_search(best_fit_decreasing(sizes, capacity), sizes, capacity)
    if now is not None and len(bins) > lower_bound(sizes, capacity):
        order = np.argsort(now, kind="stable")
        cuts = np.flatnonzero(np.diff(now[order])) + 1
        other = local_search([b.tolist() for b in np.split(order, cuts)], sizes, capacity)
        bins = min(bins, other, key=len)
    return places(bins, sizes)


# -- all groups -------------------------------------------------------------

def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to rows that have a ``length``.  The bins that
    the groups leave underfull are dealt into groups and packed once more."""
    fixed = saved(pieces.withColumn("__slot", F.rand()), "pieces")
    n = fixed.count()
    groups = max(1, -(-n // group))
    given = [f for f in fixed.schema.fields if f.name != "__slot"]
    schema = T.StructType(given + [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset", "__fill")])
    names = [f.name for f in given]

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number, offset, fill = pack_group(rows["length"].to_numpy(), capacity)
        return rows[names].assign(sequence_id=(int(key[0]) << 32) + number, offset=offset, __fill=fill)

    def again(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number, offset, fill = pack_group(rows["length"].to_numpy(), capacity, rows["sequence_id"].to_numpy())
        return rows[names].assign(sequence_id=(groups + int(key[0]) << 32) + number, offset=offset, __fill=fill)

    placed = (fixed.withColumn("__group", F.floor(F.col("__slot") * groups))
              .groupBy("__group").applyInPandas(place, schema))
    if groups == 1:
        return placed.drop("__fill")
    placed = saved(placed, "placed")
    underfull = placed.filter(F.col("__fill") < capacity)
    second = max(1, -(-underfull.count() // group))
    repacked = (underfull.withColumn("__group", F.pmod(F.xxhash64("sequence_id"), F.lit(second)))
                .groupBy("__group").applyInPandas(again, schema))
    return placed.filter(F.col("__fill") == capacity).unionByName(repacked).drop("__fill")


def pack_documents(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place; ``with_ids``
    adds the piece's token ids."""
    return pack(cut(docs, vocabulary, capacity, with_ids), capacity)
