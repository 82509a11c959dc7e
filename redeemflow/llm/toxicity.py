"""Toxicity by a classifier chain.

The categories are predicted one after the other, each by a linear model that
sees a text's word and character n-gram features and the probabilities of the
categories before it.  In training those probabilities come from out-of-fold
models, so a later model learns from predictions as uncertain as those it will
get.  Training is numpy in one task on a bounded sample of labelled rows
(``max_rows``); scoring runs over every row.

Features are presence bits of hashed n-grams that the training rows show to be
telling (a bounded number, ``MAX_FEATURES``), so a long text is not judged by the mass of its
ordinary words.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import cut

BUCKETS = 1 << 20
NGRAMS = (4, 5, 6)
MAX_FEATURES, MIN_ROWS, MIN_SCORE, MIN_RATIO, FOLDS = 3000, 3, 2.0, 4, 5
MEMO_WORDS = 300_000
#: label columns
LABELS = ("quality", "toxic")
_WORD = re.compile(r"[^\W\d_]+")


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a lower-cased word: itself and its character n-grams."""
    text = f"<{word}>"
    parts = {text, *(text[i:i + n] for n in NGRAMS for i in range(len(text) - n + 1))}
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts)


def text_buckets(text: str | None) -> set[int]:
    return {b for w in set(_WORD.findall((text or "").lower())) for b in word_buckets(w)}


# ----------------------------------------------------------------- training
def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Rows:
    """Presence bits of a set of rows over chosen features, by row."""

    def __init__(self, sets: list[np.ndarray], index: dict[int, int]):
        cols = [np.array([index[b] for b in s if b in index], np.int64) for s in sets]
        self.n = len(sets)
        self.col = np.concatenate([*cols, np.zeros(0, np.int64)])
        self.row = np.repeat(np.arange(self.n), [len(c) for c in cols])

    def dot(self, w):
        return np.bincount(self.row, w[self.col], self.n)

    def t_dot(self, r, width):
        return np.bincount(self.col, r[self.row], width)


def choose_features(sets: list[np.ndarray], y: np.ndarray) -> dict[int, int]:
    """Buckets whose share among positives stands out above that among negatives."""
    pos, neg = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for s, v in zip(sets, y):
        (pos if v else neg)[s] += 1
    n1, n0 = max(y.sum(), 1), max(len(y) - y.sum(), 1)
    p1, p0 = (pos + 0.5) / (n1 + 1), (neg + 0.5) / (n0 + 1)
    z = np.log(p1 / p0) / np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    z[((pos + neg) < MIN_ROWS) | (p1 < MIN_RATIO * p0)] = 0
    top = np.argsort(-z, kind="stable")[:MAX_FEATURES]
    return {int(b): i for i, b in enumerate(top[z[top] > MIN_SCORE])}


def fit_linear(rows: Rows, extra: np.ndarray, y: np.ndarray, width: int, l2: float = 0.1,
               steps: int = 150, rate: float = 0.5) -> np.ndarray:
    """Logistic regression by full-batch Adam: ``width`` bit weights, one weight per
    column of ``extra``, a bias."""
    k = extra.shape[1]
    w, m, v = (np.zeros(width + k + 1) for _ in range(3))
    for t in range(1, steps + 1):
        r = _sigmoid(rows.dot(w[:width]) + extra @ w[width:width + k] + w[-1]) - y
        g = np.concatenate([rows.t_dot(r, width) + l2 * w[:width], extra.T @ r + l2 * w[width:-1], [r.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
    return w


def train_chain(sets: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Feature buckets and, per category, the weights of its linear model.

    ``labels`` has one 0/1 column per category, in chain order; -1 where a row's
    label is not known: such a row is judged, not learned from.
    """
    index: dict[int, int] = {}
    for c in range(labels.shape[1]):
        known = labels[:, c] >= 0
        for b in choose_features([s for s, k in zip(sets, known) if k], labels[known, c]):
            index.setdefault(b, len(index))
    width, n = len(index), len(sets)
    fold = np.arange(n) % FOLDS
    def some(mine):
        return Rows([s for s, x in zip(sets, mine) if x], index)
    judged = [some(fold == k) for k in range(FOLDS)]
    earlier, models = np.zeros((n, 0)), []
    for c in range(labels.shape[1]):
        y, known = labels[:, c].astype(float), labels[:, c] >= 0
        models.append(fit_linear(some(known), earlier[known], y[known], width))
        out_of_fold = np.zeros(n)
        for k, judge in enumerate(judged):
            learn = known & (fold != k)
            w = fit_linear(some(learn), earlier[learn], y[learn], width)
            out_of_fold[fold == k] = _sigmoid(judge.dot(w[:width]) + earlier[fold == k] @ w[width:-1] + w[-1])
        earlier = np.column_stack([earlier, out_of_fold])
    return np.array(list(index), np.int64), models


def _sets(batches):
    for b in batches:
        ids = [sorted(text_buckets(t.as_py())) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("y"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "y", "ids"])


def _train_batches(batches):
    rows = sorted(((d, y, np.asarray(s.values, np.int64)) for b in batches for d, y, s in zip(
        b.column("doc_id").to_pylist(), b.column("y").to_pylist(), b.column("ids"))), key=lambda r: r[0])
    if rows:
        buckets, models = train_chain([r[2] for r in rows], np.array([r[1] for r in rows]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([buckets.tolist()], pa.list_(pa.int64())),
             pa.array([[m.tolist() for m in models]], pa.list_(pa.list_(pa.float64())))], ["buckets", "models"])


class Model(NamedTuple):
    buckets: np.ndarray
    models: list[np.ndarray]
    trained: bool = True


def _sample(known: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows: the smallest hashes of doc_id, of each combination of labels
    first (a twelfth of the bound each, there are six), then of all.  Top-k by hash, so no
    combination is gathered, however common it is."""
    order = [F.xxhash64("l_id"), F.col("l_id")]
    parts = [known.orderBy(*order).limit(max_rows).withColumn("first", F.lit(1))]
    for toxic in (0, 1):
        for quality in ("quality = 0", "quality = 1", "quality is null"):
            parts.append(known.where(f"toxic = {toxic} and {quality}").orderBy(*order).limit(max_rows // 12)
                         .withColumn("first", F.lit(0)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.groupBy("l_id", *LABELS).agg(F.min("first").alias("first"))
    return rows.orderBy("first", *order).limit(max_rows).drop("first")


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], max_rows: int = 6000) -> Model:
    """Chain over ``categories`` (name -> 0/1 column over the label columns, null where
    not known; the last is of ``toxic``).

    Uses at most ``max_rows`` labelled documents among those in ``docs``, the smallest
    hashes of doc_id, with every combination of labels among them (``_sample``); repeated
    rows count once, contradicting and null labels not at all.
    """
    def agreed(c):  # the label of a document's rows, null where they differ or have none
        x = F.when(F.col(c).isin(0, 1), F.col(c))
        return F.when(F.min(x) == F.max(x), F.min(x)).alias(c)
    sample = (labels.where("doc_id is not null and toxic in (0, 1)")
              .groupBy(F.col("doc_id").alias("l_id")).agg(*[agreed(c) for c in LABELS])
              .where("toxic is not null")
              .join(docs.select(F.col("doc_id").alias("l_id")).distinct(), "l_id", "left_semi").select("l_id", *LABELS))
    sample = _sample(cut(sample), max_rows)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
            .select(F.col("doc_id").cast("long"), "text",
                    F.array(*[F.coalesce(c.cast("int"), F.lit(-1)) for c in categories.values()]).alias("y")))
    sets = rows.mapInArrow(_sets, "doc_id long, y array<int>, ids array<int>").dropDuplicates(["doc_id"])
    got = sets.coalesce(1).mapInArrow(_train_batches, "buckets array<long>, models array<array<double>>").first()
    if got is None:
        return Model(np.zeros(0, np.int64), [np.zeros(i + 1) for i in range(len(categories))], False)
    return Model(np.array(got["buckets"], np.int64), [np.array(m) for m in got["models"]])


# ------------------------------------------------------------------ scoring
def score_set(found: np.ndarray, models: list[np.ndarray]) -> list[float]:
    """Chain probabilities of a row with the features ``found``."""
    p: list[float] = []
    for w in models:
        width = len(w) - 1 - len(p)
        p.append(float(_sigmoid(w[found].sum() + np.dot(w[width:-1], p) + w[-1])))
    return p


def predict(docs: DataFrame, model, categories: list[str], threshold: float = 0.3) -> DataFrame:
    """``doc_id``, one ``p_<category>`` each and ``toxic`` (the last category's
    probability reaches ``threshold``) for every row.

    Defined cases: a null or empty text has no features and gets the biases'
    probabilities; repeated rows score alike; a null doc_id is kept; a model without
    training rows gives 0.5 everywhere and calls nothing toxic; other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # at most MAX_FEATURES per category
    names = ["doc_id", *(f"p_{c}" for c in categories)]

    def run(batches):
        buckets, models, _ = shared.value
        index = {int(b): i for i, b in enumerate(buckets)}
        memo: dict[str, tuple] = {}
        for b in batches:
            out = []
            for t in b.column("text"):
                found: set[int] = set()
                for w in set(_WORD.findall((t.as_py() or "").lower())):
                    x = memo.get(w)
                    if x is None:
                        if len(memo) >= MEMO_WORDS:
                            memo.clear()
                        x = memo[w] = tuple(index[k] for k in word_buckets(w) if k in index)
                    found.update(x)
                out.append(score_set(np.array(sorted(found), np.int64), models))
            cols = list(zip(*out)) if out else [[]] * len(models)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, pa.float64()) for c in cols], names)

    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names[1:])
    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
            .withColumn("toxic", (F.col(names[-1]) >= threshold) & F.lit(model.trained)))


def labelled_categories() -> dict[str, Column]:
    """low_quality -> toxic: the two columns that the rows are labelled with, in every
    language alike."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}


def chain(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 6000) -> DataFrame:
    """Train the chain on the labelled rows of ``docs`` and judge every row."""
    categories = labelled_categories()
    return predict(docs, fit(docs, labels, categories, max_rows), list(categories), threshold)
