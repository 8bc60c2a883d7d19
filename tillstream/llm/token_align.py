"""Alignment of two tokenizers' tokens over the bytes of each text.

Side A encodes a space and the text, side B the text with the space its library
adds; both sides' tokens then cover the same bytes.  In a batch of documents
every token has the byte offset where it starts; ``pandas.merge_asof``, keyed by
document, gives each token the other side's token that covers its start.  The
union of both directions is the set of overlapping pairs (of two overlapping
tokens the later start lies in the other token), and where both sides start
together a group begins.

Corpus-wide counts of linked id pairs are one aggregate over the pairs of each
document; they come back to the documents by a join: broadcast when the written
counts are few enough (their number is taken first), otherwise by a shuffle in
which every pair is dealt over ``SALTS`` keys, since common pairs occur in
nearly every document.

Defined cases: a text that is null, empty or that either side does not give
back byte by byte has no tokens: zeros and an empty ``groups``; repeated rows
each count; a null ``doc_id`` is kept; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blank, saved, slices

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHARS = 1_000_000            # code points aligned at a time (one longer text alone)
B_IDS = 1 << 32              # a pair is one integer: a * B_IDS + b
FEW = 1_000_000              # counts that are broadcast: 17 bytes each before overhead
SALTS = 32


# -- the two sides ----------------------------------------------------------

def _path(name: str) -> str:
    return name if "/" in name else str(public_tokenizers.path(name))


def _letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable Latin-1 stands
    for itself, the other bytes in order for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(0x100 + k): b for k, b in enumerate(hidden)}}


class ByteSide:
    """Byte-level BPE vocabulary of a ``tokenizers`` file over space and text.

    Where the merges are in id order, as in this family's files, ids serve as
    ranks and ``tiktoken`` encodes: the ids are those of the ``tokenizers``
    library (tests hold every code point and whole texts against it) in a fifth
    of its time.  Any other file is encoded by that library itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark deals out the cores
        letters = _letters()
        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        entries = parsed["model"]["vocab"]
        added = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        own = {k: bytes(letters[c] for c in token) for token, k in entries.items() if token not in added}
        self.bytes = [b""] * (1 + max([*entries.values(), *added.values()]))
        for k, token in [*own.items(), *((k, token.encode()) for token, k in added.items())]:
            self.bytes[k] = token
        merged = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in parsed["model"]["merges"]]
        step = parsed["pre_tokenizer"]
        plain = (step["type"] == "ByteLevel" and step.get("use_regex", True)
                 and not step["add_prefix_space"] and not parsed.get("normalizer"))
        if plain and merged == sorted(merged) and sorted(own) == [*range(256), *merged]:
            import tiktoken
            ranks = {token: k for k, token in own.items()}
            model = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
            self.encode = lambda texts: [model.encode_ordinary(" " + t) for t in texts]
        else:
            self.encode = self.library(path)

    @staticmethod
    def library(path: str):
        """Encoding by the ``tokenizers`` library; special strings are plain text."""
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        model.no_truncation()
        model.no_padding()
        return lambda texts: [e.ids for e in model.encode_batch_fast([" " + t for t in texts],
                                                                     add_special_tokens=False)]


class PieceSide:
    """Sentencepiece model; it adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for k in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(k)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(k)
                              else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Sides:
    """Both encoders with what the alignment looks up per id: byte lengths, and
    the decimal id followed by the sign that may follow it."""

    def __init__(self, a_file: str, b_file: str):
        self.a, self.b = ByteSide(_path(a_file)), PieceSide(_path(b_file))
        self.a_len, self.b_len = (np.array([len(x) for x in s.bytes], np.int64) for s in (self.a, self.b))
        na, nb = len(self.a.bytes), len(self.b.bytes)
        self.written = np.array([f"{k}{sign}" for n, signs in ((na, ",|"), (nb, (",", ";", "")))
                                 for sign in signs for k in range(n)], dtype=object)
        self.sign_at = {"a,": 0, "a|": na, "b,": 2 * na, "b;": 2 * na + nb, "b": 2 * na + 2 * nb}


@lru_cache(maxsize=2)
def sides(a_file: str, b_file: str) -> Sides:
    return Sides(a_file, b_file)


# -- one batch --------------------------------------------------------------

def _tokens(ids: list[list[int]], lengths: np.ndarray) -> pd.DataFrame:
    """(doc, id, start): start is counted through the whole batch, so it grows."""
    many = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum()))
    length = lengths[flat]
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), many), "id": flat,
                         "start": length.cumsum() - length})


def _covering(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """For each token of ``a`` the row of ``b`` that covers its start, and
    whether both start there."""
    right = pd.DataFrame({"doc": b["doc"], "start": b["start"], "row": np.arange(len(b)), "from": b["start"]})
    got = pd.merge_asof(a[["doc", "start"]], right, on="start", by="doc")
    return got["row"].to_numpy(np.int64), (got["from"] == got["start"]).to_numpy()


def align_batch(texts: list[str | None], s: Sides) -> dict[str, list]:
    """Counts, groups, and distinct linked pairs with their numbers, per text."""
    full = [t or "" for t in texts]
    ids_a, ids_b = s.a.encode(full), s.b.encode(full)
    for k, t in enumerate(full):
        want = b" " + t.encode("utf-8", "replace")
        if not t or b"".join(map(s.a.bytes.__getitem__, ids_a[k])) != want \
                or b"".join(map(s.b.bytes.__getitem__, ids_b[k])) != want:
            ids_a[k], ids_b[k] = [], []
    a, b = _tokens(ids_a, s.a_len), _tokens(ids_b, s.b_len)
    n, docs = len(full), np.arange(len(full) + 1)
    in_b, a_opens = _covering(a, b)
    in_a, b_opens = _covering(b, a)
    a_doc, b_doc, a_id, b_id = (x.to_numpy() for x in (a["doc"], b["doc"], a["id"], b["id"]))
    # Both directions; pairs of equal starts are in the first already.
    doc = np.concatenate([a_doc, b_doc[~b_opens]])
    pair = np.concatenate([a_id * B_IDS + b_id[in_b], a_id[in_a[~b_opens]] * B_IDS + b_id[~b_opens]])
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])][:len(doc)])
    times = np.diff(np.r_[new, len(doc)])
    # The groups, written out: A ids, a bar, B ids, a semicolon.
    a_group, b_group = a_opens.cumsum(), b_opens.cumsum()
    a_shuts, b_shuts = (np.r_[g[1:] != g[:-1], True][:len(g)] for g in (a_group, b_group))
    b_ends = np.r_[b_doc[1:] != b_doc[:-1], True][:len(b_doc)]
    signs = s.sign_at
    code = np.concatenate([
        a_id + np.where(a_shuts, signs["a|"], signs["a,"]),
        b_id + np.where(b_ends, signs["b"], np.where(b_shuts, signs["b;"], signs["b,"]))])
    place = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    written = s.written[code[place]].tolist()
    at_a, at_b, at_link, at_pair = (np.searchsorted(x, docs) for x in (a_doc, b_doc, doc, doc[new]))
    at = (at_a + at_b).tolist()
    opened = np.r_[0, a_group][at_a] if len(a_group) else np.zeros(n + 1, np.int64)
    return {"n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": np.diff(opened),
            "n_links": np.diff(at_link),
            "groups": ["".join(written[x:y]) for x, y in zip(at, at[1:])],
            "pairs": pa.ListArray.from_arrays(pa.array(at_pair, pa.int32()), pa.array(pair[new], pa.int64())),
            "times": pa.ListArray.from_arrays(pa.array(at_pair, pa.int32()), pa.array(times, pa.int64()))}


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``CHARS`` code points, or one text."""
    start, held = 0, 0
    for k, n in enumerate(batch.column("chars").to_pylist()):
        if k > start and held + n > CHARS:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    yield batch.slice(start)


# -- the operator -----------------------------------------------------------

def aligned(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) per row:
    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in order, ``pairs`` the distinct linked
    id pairs (a * 2**32 + b) and ``times`` the links of each."""
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *[T.StructField(c, T.LongType()) for c in counts], T.StructField("groups", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sides(a_file, b_file)
        for b in (p for batch in batches for part in slices(batch) for p in _portions(part)):
            got = align_batch(b.column("text").to_pylist(), s)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), *[pa.array(got[c], pa.int64()) for c in counts],
                pa.array(got["groups"], pa.string()), got["pairs"], got["times"]], schema.fieldNames())

    return docs.select("doc_id", "text", F.length(blank("text")).alias("chars")).mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, links, best) over all documents: how many links hold the pair, and
    whether no pair with the same B id has more."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("z"))
    counts = saved(each.groupBy(F.col("z.pairs").alias("pair")).agg(F.sum("z.times").alias("links"))
                   .withColumn("b", F.col("pair") % B_IDS), "pair-counts")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return saved(counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best")),
                 "best-pairs")


def link_scores(rows: DataFrame, few: int = FEW) -> DataFrame:
    """``rows`` of :func:`aligned` (written, with a number ``row`` each) + n_best
    and count_sum.  At most ``few`` pairs are broadcast."""
    counts = pair_counts(rows)
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select(
        "row", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times"))
    if counts.count() <= few:
        met = each.join(F.broadcast(counts), "pair")
    else:
        salted = counts.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
        met = each.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")) \
            .join(salted, ["pair", "salt"])
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").select(
        *[c for c in rows.columns if c not in ("row", "pairs", "times")],
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` written once, each with a fixed number ``row``."""
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
