"""Quality classifier by positive-unlabelled learning.

Trusted positives (quality 1) and unlabelled web text train a small network
that minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; the class prior is estimated as the share of positives
among the labelled training rows.  The network sees surface statistics of the
whole text: letter classes, word and line repetition, punctuation per word.

Fitting uses bounded samples (``POSITIVES`` and ``UNLABELLED`` rows, chosen by
a hash of the id); only the sampled ids are broadcast and only their features
reach the driver.  Scoring covers every row in one scan without a shuffle.

Defined cases: a null text is empty and gets the score of the empty text; a
label that is null is no label, and an id with several labels is positive when
all of them are 1; without any positive every score is 0.5; repeated rows are
each scored; empty tables give no rows; other columns are passed through by
``keep_good`` and otherwise ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_remainder, raw

POSITIVES, UNLABELLED = 20_000, 40_000   # bounds of the fitting samples
THRESHOLD = 0.3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 512, 0.01, 1e-4
SEED = 7


# -- features ---------------------------------------------------------------

_CLASS = np.zeros(256, np.int8)            # 0 other ASCII marks
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,"]] = 5
_CLASS[[ord(c) for c in ";:?'\"()-"]] = 6
_CLASS[128:] = 7
CLASSES = 8


def features(text: bytes) -> np.ndarray:
    """Surface statistics of one whole text; the empty text has zeros."""
    words = text.split()
    if not words:
        return np.zeros(FEATURES)
    n, size = len(words), len(text)
    share = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=CLASSES) / size
    counts = Counter(words)
    top = [c for _, c in counts.most_common(3)]
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = share[1] + share[2] + share[7]
    lengths = np.fromiter(map(len, words), np.int64, n)
    marks = share[0] + share[6]
    pairs = len(set(zip(words, words[1:])))
    return np.array([
        *share, share[2] / max(letters, 1e-9), marks * size / n, np.log1p(n), np.log1p(size / n),
        len(counts) / n, np.log1p(n) * len(counts) / n, top[0] / n, sum(top) / n,
        len(set(lines)) / max(len(lines), 1), np.log1p(len(lines)),
        pairs / max(n - 1, 1), (lengths <= 1).mean(), (lengths >= 12).mean(),
        np.log1p(n / max(len(lines), 1)), lengths.std() / lengths.mean(), float(n < 5)])


FEATURES = CLASSES + 16


# -- learning ---------------------------------------------------------------

@dataclass
class Model:
    """One hidden layer over standardised features; ``w1`` None: no positives."""
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray | None = None
    b1: np.ndarray | None = None
    w2: np.ndarray | None = None
    b2: float = 0.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.w1 is None:
            return np.full(len(x), 0.5)
        h = np.tanh(self.inputs(x) @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = SEED) -> Model:
    """Adam on minibatches of both samples.  Where the estimated negative risk
    of a batch falls below zero, the step goes up that part instead."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(FEATURES), np.ones(FEATURES))
    rng = np.random.default_rng(seed)
    m = Model(unlabelled.mean(axis=0), np.maximum(unlabelled.std(axis=0), 1e-3))
    p, u = m.inputs(positive), m.inputs(unlabelled)
    params = [rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(np.log(prior / (1 - prior)))]
    first, second, step = [np.zeros_like(q) for q in params], [np.zeros_like(q) for q in params], 0

    def forward(x):
        h = np.tanh(x @ params[0] + params[1])
        return h, h @ params[2] + params[3]

    def back(x, h, g):
        gh = np.outer(g, params[2]) * (1 - h * h)
        return [x.T @ gh, gh.sum(axis=0), h.T @ g, np.array(g.sum())]

    sigmoid = lambda f: 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    batches = max(1, len(u) // BATCH)
    for _ in range(EPOCHS):
        pi, ui = rng.permutation(len(p)), rng.permutation(len(u))
        for k in range(batches):
            xu = u[ui[k::batches]]
            xp = p[np.take(pi, np.arange(k * BATCH, (k + 1) * BATCH), mode="wrap")]
            hp, fp = forward(xp)
            hu, fu = forward(xu)
            sp, su = sigmoid(fp), sigmoid(fu)
            # d/df log(1+e^-f) = s - 1 (as positive), d/df log(1+e^f) = s (as negative)
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            as_negative_u, as_negative_p = su / len(su), -prior * sp / len(sp)
            if negative >= 0:
                gp, gu = prior * (sp - 1) / len(sp) + as_negative_p, as_negative_u
            else:
                gp, gu = -as_negative_p, -as_negative_u
            grads = [a + b for a, b in zip(back(xp, hp, gp), back(xu, hu, gu))]
            step += 1
            for q, g, a, b in zip(params, grads, first, second):
                g = g + DECAY * q
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                q -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    m.w1, m.b1, m.w2, m.b2 = params[0], params[1], params[2], float(params[3])
    return m


def _sampled(key: Column, share: float) -> Column:
    """Rows whose hashed key falls in ``share`` of the hash range."""
    return F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))


def _vectors(texts: DataFrame) -> np.ndarray:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def vector(t: pd.Series) -> pd.Series:
        return t.map(lambda x: features(x).tolist())
    got = texts.select(vector(raw("text")).alias("x")).toPandas()["x"]
    return np.array(got.tolist(), dtype=float).reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> Model:
    """Fit on at most about ``positives`` labelled-good and ``unlabelled`` other
    rows.  ``labels`` is (doc_id, quality)."""
    judged = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("q")))
    seen = judged.agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("good")).first()
    if not seen["n"] or not seen["good"]:
        return fit(np.zeros((0, FEATURES)), np.zeros((0, FEATURES)), 0.5)
    prior = min(max(seen["good"] / seen["n"], 0.02), 0.98)
    chosen = judged.filter((F.col("q") == 1) & _sampled(F.col("__id"), min(1.0, positives / seen["good"])))
    total = docs.count()
    web = docs.filter(_sampled(F.col("doc_id"), min(1.0, unlabelled / max(total, 1))))
    # The chosen ids number about ``positives`` at any size of the corpus.
    trusted = docs.join(F.broadcast(chosen.select("__id")), docs["doc_id"] == F.col("__id"))
    return fit(_vectors(trusted.select("text")), _vectors(web.select("text")), prior)


def scorer(model: Model):
    """Column function: UTF-8 bytes of a text -> score between 0 and 1."""
    @F.pandas_udf(T.DoubleType())
    def score(t: pd.Series) -> pd.Series:
        x = np.array([features(v) for v in t], dtype=float).reshape(-1, FEATURES)
        return pd.Series(model.score(x))
    return score


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0,
             threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row, learning only from
    labels outside the held-out fold."""
    fold = F.coalesce(crc_remainder("doc_id", folds) == held_out, F.lit(False))
    model = train(docs, labels.select("doc_id", "quality").filter(~fold))
    scored = docs.select("doc_id", fold.alias("held_out"), scorer(model)(raw("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept."""
    fold = F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False))
    model = train(docs, labels.select("doc_id", "quality").filter(~fold))
    return docs.filter(scorer(model)(raw(docs["text"])) >= threshold)
