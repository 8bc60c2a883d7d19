"""Log-bilinear language model scores, in two levels: class, then word in class.

The first level predicts each token's class from the two classes before it,

    s(k | u, v) = C1[u] . Q[k] + C2[v] . Q[k] + b[k],

with classes for the ``WORDS`` most frequent words, for the end of the text,
``BANDS`` bands of less frequent words by their counts, and ``RARE`` classes, by
hash, of all words seen once, beyond ``HEAD`` or never.  The second level gives
every word of such a class, however many there are, a vector of its own,

    P(w | k, h) = (c[w] + SMOOTH) exp(D[h] . q[w] + a[w]) / Z[k, h],

where h is the last word before it with a class of its own and D[h] its vector
of the first level, centred.  Every rare class holds one word never seen, of
count 0 and without a vector.

Both levels learn by noise-contrastive estimation in numpy.  First level: every
task makes one pass of minibatches over its share of the training documents,
and the tasks' parameters are averaged by weight, ``ROUNDS`` times, each round
on its own share of all training documents.  Second level: the objective is a
sum over words, so each word learns from its own (word, h) counts against
shared noise contexts, wherever its row is.  A factor that all words of a class
share, such as the noise contexts' frequency, drops out with Z.  Scores are
normalised exactly:

    Z1[u, v] = sum_k exp(C1[u].Q[k] + b[k]) exp(C2[v].Q[k]),

one product of exponentiated score matrices, and Z[k, h] is an aggregate over
the table of all words.

Counts cover all training documents.  Only the ``HEAD`` most frequent words
travel to the workers; the others' rows follow their counts and vectors in a
stream sorted by word.

Defined cases: a null or empty text is the end token alone; repeated rows are
each scored; without training documents the scores are those of a uniform
class model and ``train_tokens`` is 0; a null ``doc_id`` is training text; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, raw, saved, slices

WORDS = 2048             # words with a class of their own
BANDS = 6                # classes of less frequent words, by count
RARE = 1                 # classes of words seen once, beyond HEAD or never, by hash
REPEATED = 2             # a word of a band was seen as often
HEAD = 131_072           # words whose counts and vectors the workers hold
SIZE = 32                # dimensions of the vectors
ROUNDS = 3               # averaging rounds; a document trains in one of them
NOISE = 64               # noise samples shared by a minibatch
BATCH = 1024
RATE = 0.15
SALTS = 512              # first-level groups of tasks when averaging
SMOOTH = 0.1
SEED = 11
END = b"\n"              # never a word
FLUSH = 1_000_000        # distinct words of its pieces a task holds while counting
PIECE = 8 << 20          # bytes of text split at a time, unless one text is longer

FIRST_RARE = WORDS + BANDS
END_CLASS = FIRST_RARE + RARE
CLASSES = END_CLASS + 1              # words, bands, rare, end
CONTEXTS = CLASSES                   # the end class doubles as "before the text"
ANCHORS = WORDS + 1                  # contexts within a class; WORDS: no such word before

INNER_STEPS = 12         # steps of the second level
INNER_NOISE = 64         # noise contexts shared by a batch of words
INNER_RATIO = 4.0        # weight of noise against data
INNER_RATE = 0.3
RIDGE = 0.5
PAIRS = 1 << 18          # (word, anchor) pairs a task holds at a time


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch with a column ``raw`` in parts of about ``PIECE`` bytes of text."""
    ends = np.r_[0, np.cumsum(pc.binary_length(batch.column("raw")).to_numpy(zero_copy_only=False), dtype=np.int64)]
    k = 0
    while k < batch.num_rows:
        stop = max(k + 1, int(np.searchsorted(ends, ends[k] + PIECE, "right")) - 1)
        yield batch.slice(k, stop - k)
        k = stop


def split(raw_text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case (A-Z only) words of whole texts, one after the other, and how
    many each text has; the end tokens are left to the caller."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(raw_text.view(pa.string())))
    words = cut.flatten()
    full = pc.greater(pc.binary_length(words), 0)           # white space at an edge gives an empty one
    offsets = cut.offsets.to_numpy()
    before = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)][offsets - offsets[0]]
    return words.filter(full).view(pa.binary()), np.diff(before)


def rare_class(word: bytes) -> int:
    return FIRST_RARE + zlib.crc32(word) % RARE


# -- counts -----------------------------------------------------------------

def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c) over all given documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, texts = [], 0, 0

        def out() -> list[pa.RecordBatch]:
            end = pa.table({"token": pa.array([END], pa.binary()), "c": pa.array([texts], pa.int64())})
            found = pa.concat_tables([*waiting, end]).group_by("token", use_threads=False).aggregate([("c", "sum")])
            return found.select(["token", "c_sum"]).rename_columns(["token", "c"]).to_batches()
        for b in batches:
            for part in pieces(b):
                words, n = split(part.column("raw"))
                found = pc.value_counts(words)
                waiting.append(pa.table({"token": found.field(0), "c": found.field(1)}))
                size, texts = size + len(found), texts + len(n)
                if size > FLUSH:
                    yield from out()
                    waiting, size, texts = [], 0, 0
        if texts:
            yield from out()

    return docs.select(raw("text").alias("raw")).mapInArrow(run, "token BINARY, c BIGINT").groupBy(
        "token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What every worker needs of the counts; bounded by HEAD."""
    head: dict[bytes, int]               # word -> its place in the next two
    head_class: np.ndarray
    head_log: np.ndarray                 # log10(c + SMOOTH)
    total: int                           # N
    distinct: int                        # V
    class_count: np.ndarray              # tokens per class
    least: float = math.inf              # least bin of counts in the head

    def kinds(self) -> np.ndarray:
        """Class by id: a place of the head, or -1 - r for a word of rare class
        r beyond it, or -1 - RARE for an end token never seen."""
        return np.r_[self.head_class, END_CLASS, np.arange(FIRST_RARE + RARE - 1, FIRST_RARE - 1, -1)].astype(np.int64)


def count_bin(c: str):
    """Counts binned by logarithm."""
    return F.floor(F.log2(c) * 16)


def vocabulary(counts: DataFrame) -> Vocabulary:
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    class_count = np.zeros(CLASSES)
    if not total:
        empty = np.zeros(0)
        return Vocabulary({}, empty.astype(int), empty, 0, 0, class_count)
    # The least bin down to which at most HEAD words are held; few rows reach
    # the driver at any size.
    bins = sorted(((r["bin"], r["n"]) for r in counts.groupBy(count_bin("c").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    held, least = 0, math.inf
    for k, n in bins:
        if held + n > HEAD:
            break
        held, least = held + n, k
    end = F.col("token") == F.lit(bytearray(END))
    top = counts.filter(end if least == math.inf else (count_bin("c") >= int(least)) | end)
    rows = sorted(((bytes(r["token"]), r["c"]) for r in top.collect()), key=lambda x: (-x[1], x[0]))
    for r in counts.groupBy((F.crc32("token") % RARE).alias("g")).agg(F.sum("c").alias("c")).collect():
        class_count[FIRST_RARE + r["g"]] = r["c"]
    c = np.array([n for _, n in rows])
    kinds = np.array([rare_class(w) for w, _ in rows])
    by_hash, words = kinds.copy(), np.array([w != END for w, _ in rows])
    own = np.flatnonzero(words)[:WORDS]
    tail = np.flatnonzero(words)[WORDS:]
    tail = tail[c[tail] >= REPEATED]
    kinds[~words] = END_CLASS
    kinds[own] = np.arange(len(own))
    if len(tail):
        mass = np.cumsum(c[tail])
        kinds[tail] = WORDS + (mass - c[tail]) * BANDS // mass[-1]
    moved = kinds != by_hash
    np.subtract.at(class_count, by_hash[moved], c[moved])
    np.add.at(class_count, kinds[moved], c[moved])
    return Vocabulary({w: k for k, (w, _) in enumerate(rows)}, kinds, np.log10(c + SMOOTH), total, distinct,
                      class_count, least)


# -- documents as classes ---------------------------------------------------

def blobs(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values as binaries, which begin at ``first``."""
    offsets = (np.r_[first, len(values)] * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first),
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def values_of(binaries: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """What ``blobs`` held, one after the other, and how many each binary has."""
    offsets = np.frombuffer(binaries.buffers()[1], np.int32)[binaries.offset:binaries.offset + len(binaries) + 1]
    values = np.frombuffer(binaries.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)
    return values, np.diff(offsets) // kind.itemsize


def anchors(kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every token the last word of its text before it that has a class of
    its own (WORDS: none); ``first`` marks the texts' first tokens."""
    n = np.arange(len(kinds))
    last = np.r_[-1, np.maximum.accumulate(np.where(kinds < WORDS, n, -1))[:-1]]
    return np.where(last >= np.maximum.accumulate(np.where(first, n, 0)), kinds[last], WORDS)


def encode(docs: DataFrame, vocab, folds: int, held_out: int) -> DataFrame:
    """One row per document: its ids (see ``Vocabulary.kinds``), the sum that
    the held counts give, and its words beyond them by anchor, with numbers."""
    fold = F.coalesce(crc_remainder("doc_id", folds) == held_out, F.lit(False))
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out BOOLEAN, n_tokens BIGINT, "
              "known BIGINT, base_log DOUBLE, ids BINARY, rare ARRAY<BINARY>, rare_h ARRAY<INT>, rare_n ARRAY<INT>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        head, kind, end = pa.array(list(v.head), pa.binary()), v.kinds(), v.head.get(END, -1 - RARE)
        log = np.r_[v.head_log, math.log10(SMOOTH), np.zeros(RARE)]     # an end never seen has no count
        for b in (part for batch in batches for part in pieces(batch)):
            words, n = split(b.column("raw"))
            place = pc.index_in(words, value_set=head).fill_null(-1).to_numpy()
            beyond = np.flatnonzero(place < 0)
            rare = words.take(pa.array(beyond)).dictionary_encode()
            each, rare = rare.indices.to_numpy(), rare.dictionary
            # the words of all texts, each text followed by its end
            stop = np.cumsum(n + 1)
            first, is_word = np.zeros(len(place) + len(n), bool), np.ones(len(place) + len(n), bool)
            first[stop - n - 1], is_word[stop - 1] = True, False
            at = np.full(len(first), end, np.int32)
            at[is_word] = place
            where = np.flatnonzero(is_word)[beyond]
            at[where] = np.array([FIRST_RARE - 1 - rare_class(w) for w in rare.to_pylist()], np.int32)[each]
            text = np.searchsorted(stop, where, "right")
            missed = np.bincount(text, minlength=len(n)) + (end < 0)
            # a text's words beyond the head by anchor, each with its number
            h = anchors(kind[at], first)[where]
            key, times = np.unique((text * ANCHORS + h) * len(rare) + each, return_counts=True)
            text, h, each = key // max(len(rare), 1) // ANCHORS, key // max(len(rare), 1) % ANCHORS, key % max(len(rare), 1)
            offsets = pa.array(np.searchsorted(text, np.arange(len(n) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (
                rare.take(pa.array(each)), pa.array(h, pa.int32()), pa.array(times, pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(n + 1), pa.array(n + 1 - missed),
                 pa.array(np.add.reduceat(log[at], stop - n - 1)), blobs(at, stop - n - 1), *lists],
                ["doc_id", "held_out", "n_tokens", "known", "base_log", "ids", "rare", "rare_h", "rare_n"])

    return docs.select("doc_id", fold.alias("held_out"), raw("text").alias("raw")).mapInArrow(run, schema)


def rare_words(encoded: DataFrame) -> DataFrame:
    """(token, row, h, n): the words of each document beyond the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch, 1024)):
            lists = b.column("rare")
            rows = np.repeat(b.column("row").to_numpy(), pc.list_value_length(lists).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [lists.flatten(), pa.array(rows), b.column("rare_h").flatten(), b.column("rare_n").flatten().cast(pa.int64())],
                ["token", "row", "h", "n"])

    return encoded.select("row", "rare", "rare_h", "rare_n").mapInArrow(
        run, "token BINARY, row BIGINT, h INT, n BIGINT")


# -- the model --------------------------------------------------------------

@dataclass
class Parameters:
    key: str
    c1: np.ndarray       # contexts x size: the token before
    c2: np.ndarray       # contexts x size: the one before that
    q: np.ndarray        # classes x size
    b: np.ndarray        # classes

    def table(self) -> np.ndarray:
        return np.concatenate([self.c1, self.c2, self.q, self.b[:, None]], axis=1).astype(np.float32)

    @staticmethod
    def of(table: np.ndarray) -> Parameters:
        s = SIZE
        return Parameters(uuid.uuid4().hex, table[:, :s], table[:, s:2 * s], table[:, 2 * s:3 * s],
                          table[:, 3 * s])


def start(vocab: Vocabulary) -> Parameters:
    rng = np.random.default_rng(SEED)
    p = (vocab.class_count + 1) / (vocab.class_count + 1).sum()
    small = lambda: rng.normal(0, 0.1, (CLASSES, SIZE)).astype(np.float32)
    return Parameters(uuid.uuid4().hex, small(), small(), small(), np.log(p).astype(np.float32))


def starts(docs: list[np.ndarray]) -> np.ndarray:
    """Marks the first token of each text."""
    first = np.zeros(sum(len(d) for d in docs), bool)
    first[np.r_[0, np.cumsum([len(d) for d in docs])[:-1]]] = True
    return first


def contexts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, u, v): every token's class and the two before it, the end class
    standing before a text."""
    w = np.concatenate(docs).astype(np.int64)
    first = starts(docs)
    u = np.r_[END_CLASS, w[:-1]]
    u[first] = END_CLASS
    v = np.r_[END_CLASS, u[:-1]]
    v[first] = END_CLASS
    return w, u, v


def runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, at, hit): the order that sorts the rows, where equal ones begin
    in it, and the distinct rows."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")       # a radix sort
    rows = rows[order]
    at = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return order, at, rows[at]


def _add(target: np.ndarray, sums: np.ndarray, hit: np.ndarray, g: np.ndarray) -> None:
    """Adagrad step on distinct rows."""
    new = sums.take(hit, axis=0)
    new += g * g
    sums[hit] = new
    step = RATE * g
    step /= np.sqrt(new, out=new)
    step += target.take(hit, axis=0)
    target[hit] = step


class Trainer:
    """Noise-contrastive estimation on a worker's own copy of the parameters."""

    def __init__(self, p: Parameters, noise: np.ndarray, seed: int):
        self.c1, self.c2, self.q, self.b = (x.astype(np.float32).copy() for x in (p.c1, p.c2, p.q, p.b))
        self.sums = [np.full(x.shape, 1e-2, np.float32) for x in (self.c1, self.c2, self.q, self.b)]
        self.cdf, self.rng = np.cumsum(noise), np.random.default_rng(seed)
        self.log_kq = (np.log(noise) + np.log(NOISE)).astype(np.float32)
        self.seen = 0

    def step(self, w: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
        """Ascend the NCE objective of one minibatch; its noise words are shared."""
        s = np.searchsorted(self.cdf, self.rng.random(NOISE) * self.cdf[-1])
        s = np.minimum(s, len(self.cdf) - 1)
        r = self.c1.take(u, axis=0)
        r += self.c2.take(v, axis=0)
        qw, qs = self.q.take(w, axis=0), self.q.take(s, axis=0)
        real = np.einsum("ij,ij->i", r, qw) + self.b[w] - self.log_kq[w]
        fake = r @ qs.T
        fake += self.b[s]
        fake -= self.log_kq[s]
        gw = 1 / (1 + np.exp(np.clip(real, -30, 30)))          # 1 - sigmoid
        np.negative(np.clip(fake, -30, 30, out=fake), out=fake)
        np.exp(fake, out=fake)
        fake += 1
        gs = np.divide(-1, fake, out=fake)                     # - sigmoid
        gr = gs @ qs
        gr += gw[:, None] * qw
        order, at, hit = runs(np.concatenate([w, s]))
        gq = np.concatenate([gw[:, None] * r, gs.T @ r])
        _add(self.q, self.sums[2], hit, np.add.reduceat(gq.take(order, axis=0), at, axis=0))
        _add(self.b, self.sums[3], hit, np.add.reduceat(np.concatenate([gw, gs.sum(axis=0)])[order], at))
        for c, sums, rows in ((self.c1, self.sums[0], u), (self.c2, self.sums[1], v)):
            order, at, hit = runs(rows)
            _add(c, sums, hit, np.add.reduceat(gr.take(order, axis=0), at, axis=0))
        self.seen += len(w)

    def train(self, docs: list[np.ndarray]) -> None:
        w, u, v = contexts(docs)
        order = self.rng.permutation(len(w))
        for k in range(0, len(w), BATCH):
            o = order[k:k + BATCH]
            self.step(w[o], u[o], v[o])


def train_round(encoded: DataFrame, p: Parameters, vocab: Vocabulary, seed: int) -> Parameters:
    """One pass of every task over its documents, then the weighted mean of the
    tasks' parameters, chunks of classes averaged in two levels of groups."""
    noise = (vocab.class_count + 1) ** 0.75
    noise = noise / noise.sum()
    sent, kind = encoded.sparkSession.sparkContext.broadcast(p), vocab.kinds().astype(np.uint16)
    rows = 64                                   # classes per averaged chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        t = Trainer(sent.value, noise, seed * 1_000_003 + part)
        for b in batches:
            waiting, size = [], 0
            for x in b.column("ids").to_pylist():
                waiting.append(kind[np.frombuffer(x, np.int32)])
                size += len(waiting[-1])
                if size >= 64 * BATCH:
                    t.train(waiting)
                    waiting, size = [], 0
            if waiting:
                t.train(waiting)
        if t.seen:
            table = Parameters("", t.c1, t.c2, t.q, t.b).table()
            chunks = [table[k:k + rows] for k in range(0, CLASSES, rows)]
            n = len(chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([part % SALTS] * n, pa.int32()),
                 pa.array([t.seen] * n, pa.int64()), pa.array([c.tobytes() for c in chunks], pa.binary())],
                ["chunk", "salt", "seen", "cells"])

    def mean(got: pd.DataFrame) -> pd.DataFrame:
        weight = got["seen"].to_numpy(np.float64)
        total = sum(np.frombuffer(c, np.float32).astype(np.float64) * x for c, x in zip(got["cells"], weight))
        return pd.DataFrame({"chunk": got["chunk"].iloc[:1], "seen": [int(weight.sum())],
                             "cells": [(total / weight.sum()).astype(np.float32).tobytes()]})

    parts = encoded.select("ids").mapInArrow(run, "chunk INT, salt INT, seen BIGINT, cells BINARY")
    out = "chunk INT, seen BIGINT, cells BINARY"
    averaged = (parts.groupBy("chunk", "salt").applyInPandas(mean, out)
                .groupBy("chunk").applyInPandas(mean, out).collect())
    if not averaged:
        return p
    width = 3 * SIZE + 1
    return Parameters.of(np.concatenate([np.frombuffer(r["cells"], np.float32).reshape(-1, width)
                                         for r in sorted(averaged, key=lambda r: r["chunk"])]))


def train(encoded: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> Parameters:
    p = start(vocab)
    if not vocab.total:
        return p
    learning = encoded.filter(~F.col("held_out"))
    for k in range(rounds):
        share = learning.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(rounds)) == k)
        p = train_round(share, p, vocab, k + 1)
    return p


# -- words within their classes ----------------------------------------------

def anchor_vectors(p: Parameters, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(D, noise): the anchors' vectors, centred and of mean square length 4,
    and the distribution that noise contexts are drawn from."""
    at = np.r_[np.arange(WORDS), END_CLASS]
    noise = vocab.class_count[at] + 1
    noise = noise / noise.sum()
    d = p.c1[at].astype(np.float64)
    d -= noise @ d
    length = math.sqrt(float(noise @ (d * d).sum(axis=1)))
    return (2 * d / max(length, 1e-9)).astype(np.float32), noise


CELL = np.dtype([("h", "<u2"), ("n", "<u8")])       # a (word, anchor) count, by word


def packed(tokens, cells: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """One row per token with its cells, which begin at ``first``."""
    return pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), blobs(cells, first)], ["token", "cells"])


def cells_of(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    cells = np.empty(len(h), CELL)
    cells["h"], cells["n"] = h, n
    return cells


def pairs(learning: DataFrame, vocab) -> DataFrame:
    """(token, cells) of all tokens without a class of their own, those of the
    head added up within each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        words, kind = np.array(list(v.head) or [b""], object), v.kinds()

        def out(keys: list[np.ndarray]) -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            place = key // ANCHORS
            first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            return packed(words[place[first]], cells_of(key % ANCHORS, n), first)
        waiting, size = [], 0
        for b in (part for batch in batches for part in slices(batch)):
            rare = b.column("rare").flatten()
            if len(rare):
                h, n = (b.column(c).flatten().to_numpy() for c in ("rare_h", "rare_n"))
                yield packed(rare, cells_of(h, n), np.arange(len(h)))
            docs = [np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()]
            at = np.concatenate(docs)
            kinds = kind[at]
            hit = np.flatnonzero((at >= 0) & (kinds >= WORDS) & (kinds < END_CLASS))
            waiting.append(at[hit].astype(np.int64) * ANCHORS + anchors(kinds, starts(docs))[hit])
            size += len(hit)
            if size > 16 * PAIRS:
                yield out(waiting)
                waiting, size = [], 0
        if size:
            yield out(waiting)

    return learning.select("ids", "rare", "rare_h", "rare_n").mapInArrow(run, "token BINARY, cells BINARY")


def fit_words(d: np.ndarray, noise: np.ndarray, h: np.ndarray, n: np.ndarray, first: np.ndarray,
              rng: np.random.Generator) -> np.ndarray:
    """Vectors q and offsets a (last column) of words whose (h, n) pairs begin
    at ``first``: ascends each word's noise-contrastive objective.  A noise word
    is drawn by count, so the logit of a pair is D[h].q + a - log(INNER_RATIO)."""
    size = np.diff(np.r_[first, len(h)])
    word = np.repeat(np.arange(len(first)), size)
    x = np.c_[d, np.ones(len(d), np.float32)].astype(np.float32)
    real_x, n = x[h], n.astype(np.float32)
    c = np.add.reduceat(n, first)
    q = np.zeros((len(first), x.shape[1]), np.float32)
    sums = np.full(q.shape, 1e-2, np.float32)
    cdf, shift = np.cumsum(noise), np.float32(math.log(INNER_RATIO))
    for _ in range(INNER_STEPS):
        s = np.minimum(np.searchsorted(cdf, rng.random(INNER_NOISE) * cdf[-1]), len(cdf) - 1)
        real = np.einsum("ij,ij->i", real_x, q.take(word, axis=0)) - shift
        fake = q @ x[s].T - shift
        pull = n / (1 + np.exp(np.clip(real, -30, 30)))
        push = (INNER_RATIO / INNER_NOISE * c)[:, None] / (1 + np.exp(-np.clip(fake, -30, 30)))
        g = np.add.reduceat(pull[:, None] * real_x, first, axis=0) - push @ x[s] - RIDGE * q
        sums += g * g
        q += INNER_RATE * g / np.sqrt(sums)
    return q


def words_seen_once(d: np.ndarray, noise: np.ndarray) -> np.ndarray:
    """The vector of a word seen once, by the anchor it was seen after."""
    every = np.arange(ANCHORS)
    return fit_words(d, noise, every, np.ones(ANCHORS), every, np.random.default_rng(SEED))


def learn_words(learning: DataFrame, sent_vocab, d: np.ndarray, noise: np.ndarray) -> DataFrame:
    """(token, c, kind, vec, once): every training word without a class of its
    own, its count, class and vector (float32 bytes); for a word seen once its
    anchor in ``once`` tells the vector."""
    sent = learning.sparkSession.sparkContext.broadcast((d, noise))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (d, noise), v = sent.value, sent_vocab.value
        kind = v.kinds()

        def learnt(words: list[bytes], h, n, first) -> pa.RecordBatch:
            c, size = np.add.reduceat(n, first), np.diff(np.r_[first, len(h)])
            vecs: list = [None] * len(words)
            often = np.flatnonzero(c > 1)
            group = np.cumsum(size[often]) // PAIRS
            for g in np.unique(group):
                mine = often[group == g]
                begin = np.cumsum(size[mine]) - size[mine]
                at = np.arange(size[mine].sum()) + np.repeat(first[mine] - begin, size[mine])
                rng = np.random.default_rng([SEED, zlib.crc32(words[mine[0]])])
                for k, row in zip(mine, fit_words(d, noise, h[at], n[at], begin, rng)):
                    vecs[k] = row.tobytes()
            place = np.fromiter(map(v.head.get, words, repeat(-1)), np.int64, len(words))
            kinds = kind[place]
            kinds[place < 0] = [rare_class(words[k]) for k in np.flatnonzero(place < 0)]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c.astype(np.int64)), pa.array(kinds, pa.int32()),
                 pa.array(vecs, pa.binary()), pa.array(h[first].astype(np.int32), mask=c > 1)],
                ["token", "c", "kind", "vec", "once"])

        # Rows are sorted by word: the last word of a part waits for the next.
        last: tuple | None = None
        for b in (part for batch in batches for part in slices(batch, 8192)):
            word, (cells, size) = b.column("token"), values_of(b.column("cells"), CELL)
            new = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            new = np.concatenate([[True], new])
            key = np.repeat(np.cumsum(new), size) * ANCHORS + cells["h"]
            n, words = cells["n"].astype(np.int64), word.filter(pa.array(new)).to_pylist()
            if last:
                if last[0] == words[0]:                     # word numbers begin at 1
                    key, n = np.r_[last[1] + ANCHORS, key], np.r_[last[2], n]
                else:
                    key, n, words = np.r_[last[1], key], np.r_[last[2], n], [last[0], *words]
            key, inverse = np.unique(key, return_inverse=True)
            n = np.bincount(inverse, n).astype(np.int64)
            word = key // ANCHORS
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            stop = first[-1]
            last = words[-1], key[stop:] % ANCHORS, n[stop:]
            if stop:
                yield learnt(words[:-1], key[:stop] % ANCHORS, n[:stop], first[:-1])
        if last:
            yield learnt([last[0]], last[1], last[2], np.zeros(1, int))

    # A word here has less than a WORDS-th of all tokens, and its rows pass
    # through a task in bounded memory.
    return pairs(learning, sent_vocab).repartition("token").sortWithinPartitions("token").mapInArrow(
        run, "token BINARY, c BIGINT, kind INT, vec BINARY, once INT")


def normaliser(words: DataFrame, d: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Z[k - WORDS, h] over all words; rare classes hold one unseen word."""
    sent = words.sparkSession.sparkContext.broadcast((d, ones))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        d, ones = sent.value
        x = np.c_[d, np.ones(len(d), np.float32)].astype(np.float32)
        z = np.zeros((END_CLASS - WORDS, ANCHORS))
        singles = np.zeros_like(z)                          # words seen once by class and anchor
        for b in (part for batch in batches for part in slices(batch, 512)):
            kind = b.column("kind").to_numpy() - WORDS
            once = b.column("once")
            single = once.is_valid().to_numpy(zero_copy_only=False)
            np.add.at(singles, (kind[single], once.drop_null().to_numpy()), 1)
            often = b.filter(pa.array(~single))
            if often.num_rows:
                weight = (often.column("c").to_numpy() + SMOOTH).astype(np.float32)
                vec = np.frombuffer(b"".join(often.column("vec").to_pylist()), np.float32).reshape(-1, SIZE + 1)
                order = np.argsort(kind[~single], kind="stable")
                kinds = kind[~single][order]
                for k in np.unique(kinds):
                    mine = order[kinds == k]
                    e = vec[mine] @ x.T
                    np.exp(np.clip(e, -60, 60, out=e), out=e)
                    e *= weight[mine, None]
                    z[k] += e.sum(axis=0, dtype=np.float64)
        if singles.any():
            z += singles @ (np.exp(np.clip(ones @ x.T, -60, 60)) * (1 + SMOOTH))
        hit = np.flatnonzero(z.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit.astype(np.int32)), pa.array([TaskContext.get().partitionId() % SALTS] * len(hit), pa.int32()),
             pa.array([z[k].tobytes() for k in hit], pa.binary())], ["kind", "salt", "cells"])

    def add(got: pd.DataFrame) -> pd.DataFrame:
        cells = sum(np.frombuffer(c) for c in got["cells"])
        return pd.DataFrame({"kind": got["kind"].iloc[:1], "cells": [cells.tobytes()]})

    out = "kind INT, cells BINARY"
    parts = words.select("kind", "c", "vec", "once").mapInArrow(run, "kind INT, salt INT, cells BINARY")
    z = np.zeros((END_CLASS - WORDS, ANCHORS))
    z[BANDS:] = SMOOTH
    for r in parts.groupBy("kind", "salt").applyInPandas(add, out).groupBy("kind").applyInPandas(add, out).collect():
        z[r["kind"]] += np.frombuffer(r["cells"])
    return z


@dataclass
class Inner:
    """The second level as the workers hold it; bounded by HEAD."""
    d: np.ndarray            # ANCHORS x SIZE
    log_z: np.ndarray        # log10 Z
    head: np.ndarray         # (q, a) by place in the head
    ones: np.ndarray         # (q, a) of a word seen once, by its anchor

    def lift(self, vec: np.ndarray, h: np.ndarray) -> np.ndarray:
        """log10 of exp(D[h].q + a)"""
        s = np.einsum("ij,ij->i", self.d.take(h, axis=0), vec[:, :SIZE]) + vec[:, SIZE]
        return np.clip(s, -60, 60).astype(np.float64) / math.log(10)


def inner_model(words: DataFrame, vocab: Vocabulary, d: np.ndarray, noise: np.ndarray) -> Inner:
    head, ones = np.zeros((len(vocab.head), SIZE + 1), np.float32), words_seen_once(d, noise)
    if vocab.least < math.inf:
        for r in words.filter(count_bin("c") >= int(vocab.least)).select("token", "vec", "once").toLocalIterator():
            head[vocab.head[bytes(r["token"])]] = (ones[r["once"]] if r["vec"] is None
                                                   else np.frombuffer(r["vec"], np.float32))
    z = normaliser(words, d, ones)
    return Inner(d, np.log10(np.where(z > 0, z, 1.0)), head, ones)


class Scorer:
    """Exact class log-probabilities: per context pair one normaliser."""

    def __init__(self, p: Parameters):
        self.a = p.c1 @ p.q.T + p.b
        self.c = p.c2 @ p.q.T
        top_a, top_c = self.a.max(axis=1), self.c.max(axis=1)
        z = np.exp(self.a - top_a[:, None]) @ np.exp(self.c - top_c[:, None]).T
        self.log_z = np.log(np.maximum(z, 1e-37)) + top_a[:, None] + top_c[None, :]

    def __call__(self, w: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """log10 P(w | u, v)"""
        return (self.a[u, w] + self.c[v, w] - self.log_z[u, v]).astype(np.float64) / math.log(10)


_SCORERS: dict[str, Scorer] = {}


def _scorer(p: Parameters) -> Scorer:
    if p.key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[p.key] = Scorer(p)
    return _SCORERS[p.key]


def score(encoded: DataFrame, p: Parameters, inner, vocab) -> DataFrame:
    """Add text_log: the text's log10 probability, but for what the counts and
    vectors of its words beyond the head add."""
    sent = encoded.sparkSession.sparkContext.broadcast(p)
    columns = ["row", "doc_id", "held_out", "n_tokens", "known", "base_log"]
    types = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, within, v = _scorer(sent.value), inner.value, vocab.value
        kind = v.kinds()
        for b in batches:
            logs: list[np.ndarray] = []
            docs = [np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()]
            k = 0
            while k < len(docs):
                size, j = 0, k
                while j < len(docs) and (j == k or size + len(docs[j]) <= 1 << 18):
                    size += len(docs[j])
                    j += 1
                at = np.concatenate(docs[k:j])
                w, u, before = contexts([kind[x] for x in docs[k:j]])
                each = model(w, u, before)
                tail = np.flatnonzero((w >= WORDS) & (w < END_CLASS))
                h = anchors(w, starts(docs[k:j]))[tail]
                each[tail] -= within.log_z[w[tail] - WORDS, h]
                held = at[tail] >= 0
                places = at[tail][held]
                each[tail[held]] += v.head_log[places] + within.lift(within.head[places], h[held])
                logs.append(np.add.reduceat(each, np.r_[0, np.cumsum([len(x) for x in docs[k:j]])[:-1]]))
                k = j
            total = np.concatenate(logs) if logs else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in columns] + [pa.array(total, pa.float64())], columns + ["text_log"])

    return encoded.select(*columns, "ids").mapInArrow(run, f"{types}, text_log DOUBLE")


def score_rare(rare: DataFrame, beyond: DataFrame, inner) -> DataFrame:
    """(row, rare_base, rare_log, rare_known) of the documents' words beyond the
    head (token, row, h, n), which follow their word's row (token, c, vec, once)
    in one sorted stream: a task holds one word's vector, whatever its rows."""
    none = np.zeros(SIZE + 1, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        within = inner.value
        last: tuple = None, 0, none                     # word, count, vector
        for b in (part for batch in batches for part in slices(batch, 8192)):
            word, h = b.column("token"), b.column("h").fill_null(-1).to_numpy()
            n = b.column("n").to_numpy()
            head = b.column("row").is_null().to_numpy(zero_copy_only=False)
            new = np.concatenate([[word[0].as_py() != last[0]],
                                  pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)])
            # entry 0: the last part's word; the others: a word each, of count 0 unless its own row is here
            entry, first = np.cumsum(new), np.flatnonzero(new)
            c, vec = np.zeros(len(first) + 1, np.int64), np.zeros((len(first) + 1, SIZE + 1), np.float32)
            c[0], vec[0] = last[1:]
            at = np.flatnonzero(head)
            c[entry[at]] = n[at]
            single = h[at] >= 0
            vec[entry[at[single]]] = within.ones[h[at[single]]]
            learnt = b.column("vec").drop_null()
            if len(learnt):
                vec[entry[at[~single]]] = values_of(learnt, np.dtype(np.float32))[0].reshape(-1, SIZE + 1)
            last = word[-1].as_py(), c[entry[-1]], vec[entry[-1]].copy()
            at = np.flatnonzero(~head)
            n, entry = n[at], entry[at]
            base = n * np.log10(c[entry] + SMOOTH)
            lift = n * within.lift(vec.take(entry, axis=0), h[at])
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(pa.array(at)), pa.array(base), pa.array(base + lift),
                 pa.array(np.where(c[entry] > 0, n, 0))],
                ["row", "rare_base", "rare_log", "rare_known"])

    met = rare.select("token", "row", "h", "n", F.lit(None).cast("binary").alias("vec")).unionByName(
        beyond.select("token", F.lit(None).cast("long").alias("row"), F.col("once").alias("h"), F.col("c").alias("n"),
                      "vec"))
    each = met.repartition("token").sortWithinPartitions("token", "row").mapInArrow(
        run, "row BIGINT, rare_base DOUBLE, rare_log DOUBLE, rare_known BIGINT")
    return each.groupBy("row").agg(*[F.sum(x).alias(x) for x in ("rare_base", "rare_log", "rare_known")])


# -- the operator -----------------------------------------------------------

def lm_scores(docs: DataFrame, folds: int = 10, held_out: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    fold = F.coalesce(crc_remainder("doc_id", folds) == held_out, F.lit(False))
    counts = saved(count_tokens(docs.select("doc_id", "text").filter(~fold)), "token-counts")
    vocab = vocabulary(counts)
    sent = spark.sparkContext.broadcast(vocab)
    encoded = saved(encode(docs, sent, folds, held_out)
                    .withColumn("row", F.monotonically_increasing_id()), "encoded")
    model = train(encoded, vocab, rounds)
    d, noise = anchor_vectors(model, vocab)
    words = saved(learn_words(encoded.filter(~F.col("held_out")), sent, d, noise), "words")
    inner = spark.sparkContext.broadcast(inner_model(words, vocab, d, noise))
    scored = score(encoded, model, inner, sent)
    # Words beyond the head: each (document, word, anchor) follows the word's
    # count and vector; none of them is frequent in the training text.
    beyond = words if vocab.least == math.inf else words.filter(count_bin("c") < int(vocab.least))
    met = score_rare(rare_words(encoded), beyond, inner)
    both = scored.join(met, "row", "left")
    added = {x: F.coalesce(x, F.lit(0)) for x in ("rare_base", "rare_log", "rare_known")}
    norm = math.log10(vocab.total + SMOOTH * (vocab.distinct + 1))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + added["rare_known"]).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_log") + added["rare_base"] - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("text_log") + added["rare_log"]).alias("score"))
