"""Quality classifier by supervised subword embeddings.

A text's words and their character n-grams are hashed into buckets; each bucket
has a learned vector, the vectors are averaged per document and a softmax layer
scores the mean.  Training is stochastic gradient descent in numpy, in one task,
on a bounded sample of labelled rows (``max_rows``).  Scoring is linear in the
mean, so a bucket's vector and the output layer fold into one number per bucket.

A word equal to the one before it is the token ``=``, so runs of one word look
alike whatever the word is.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
NGRAMS = (3, 4)
#: words whose buckets a worker remembers
MEMO_WORDS = 400_000

_SEED = 0x51ED


def word_buckets(word: bytes) -> list[int]:
    """Buckets of a word (UTF-8, as written): itself and its character n-grams."""
    text = "<" + word.decode("utf-8", "replace") + ">"
    parts = [text] + [text[i:i + n] for n in NGRAMS for i in range(len(text) - n + 1)]
    return [zlib.crc32(p.encode("utf-8", "replace"), _SEED) % BUCKETS for p in parts]


def words_of(data: bytes | None) -> list[bytes]:
    words = (data or b"").split()
    return [b"=" if w == before else w for before, w in zip([None, *words], words)]


# ----------------------------------------------------------------- training
def _features(batches):
    for b in batches:
        ids, counts = [], []
        for t in b.column("data"):
            total: Counter = Counter()
            for w, n in Counter(words_of(t.as_py())).items():
                for i in word_buckets(w):
                    total[i] += n
            ids.append(list(total))
            counts.append(list(total.values()))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("y"), pa.array(ids, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.float32()))], ["doc_id", "y", "ids", "counts"])


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 12,
          rate: float = 4.0, seed: int = 7) -> tuple[np.ndarray, float]:
    """One weight per bucket and a bias: the logit of class 1 is the weights'
    mean over a document plus the bias."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(examples)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            ids, share, y = examples[k]
            lr = rate * (1 - step / steps)
            step += 1
            mean = share @ emb[ids] if len(ids) else np.zeros(dim, np.float32)
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            if len(ids):
                emb[ids] -= (lr * share)[:, None] * (p @ out)
            out -= lr * 0.1 * np.outer(p, mean)
            bias -= lr * 0.01 * p
    return emb @ (out[1] - out[0]), float(bias[1] - bias[0])


def _train_batches(batches):
    rows = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), b.column("y").to_pylist(),
                                            b.column("ids"), b.column("counts"))]
    examples = []
    for _, y, ids, counts in sorted(rows, key=lambda r: r[0]):
        c = np.asarray(counts.values, np.float32)
        examples.append((np.asarray(ids.values, np.int64), c / max(c.sum(), 1), y))
    weights, bias = train(examples)
    yield pa.RecordBatch.from_arrays(
        [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias], pa.float64())],
        ["weights", "bias"])


def fit(docs: DataFrame, labelled: DataFrame, max_rows: int = 3000) -> tuple[np.ndarray, float]:
    """Learn from ``labelled`` (``doc_id, y`` with y 0 or 1).

    At most ``max_rows`` labelled documents are used, those with the smallest hash
    of doc_id among those in ``docs``.  Contradicting labels of a document are left out, and repeated
    rows count once.  Without labelled documents every score is 0.5.
    """
    sample = (labelled.where("doc_id is not null and y in (0, 1)")
              .groupBy(F.col("doc_id").alias("l_id")).agg(F.min("y").alias("y"), F.max("y").alias("y2"))
              .where("y = y2")
              .join(docs.select(F.col("doc_id").alias("l_id")).distinct(), "l_id", "left_semi")
              .orderBy(F.xxhash64("l_id"), "l_id").limit(max_rows)
              .select("l_id", F.col("y").cast("int").alias("y")))
    rows = (docs.select("doc_id", F.col("text").cast("binary").alias("data"))
            .join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
            .select(F.col("doc_id").cast("long"), "y", "data"))
    feats = (rows.mapInArrow(_features, "doc_id long, y int, ids array<int>, counts array<float>")
             .dropDuplicates(["doc_id"]))
    got = feats.coalesce(1).mapInArrow(_train_batches, "weights binary, bias double").first()
    return np.frombuffer(bytes(got["weights"]), "<f4").copy(), got["bias"]


# ------------------------------------------------------------------ scoring
def score_text(data: bytes | None, weights: np.ndarray, bias: float, memo: dict) -> float:
    total, n = 0.0, 0
    for w in words_of(data):
        x = memo.get(w)
        if x is None:
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            ids = word_buckets(w)
            x = memo[w] = (float(weights[ids].sum(dtype=np.float64)), len(ids))
        total += x[0]
        n += x[1]
    z = total / max(n, 1) + bias
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``doc_id, score`` of class 1 for every row; a null or empty text scores the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches):
        weights, bias = shared.value
        memo: dict = {}
        for b in batches:
            s = [score_text(t.as_py(), weights, bias, memo) for t in b.column("data")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
            .mapInArrow(run, "doc_id long, score double"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 3000) -> DataFrame:
    """Rows of ``docs``, all columns, that score at least ``threshold``; rows are
    filtered where they are read, so no text is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, _learnable(labels), max_rows))

    def run(batches):
        weights, bias = shared.value
        memo: dict = {}
        for b in batches:
            keep = [score_text(t.encode("utf-8", "replace") if t is not None else None, weights, bias, memo)
                    >= threshold for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("y"))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 3000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learns ``labels.quality`` from rows that are not held out.  Null qualities
    and labels of unknown documents are ignored; repeated rows score alike; a
    null doc_id is never learned from; other columns are ignored.
    """
    return (score(docs, fit(docs, _learnable(labels), max_rows))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
