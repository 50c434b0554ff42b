"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

Words, pairs of words and character trigrams are hashed to buckets, each with a learned
vector; a word that follows itself has a bucket of its own, whichever it is. A document
is the mean of its vectors, shrunk for the shortest (a few n-grams say little), and a
softmax layer over that mean gives the score. Training takes a bounded sample: of each
label at most ``SAMPLE`` documents, those with the least hash of their id, whole texts. Their bucket counts are made by
Spark tasks; only those reach the driver, which runs the descent in a fixed order.

The mean and the output layer are linear, so scoring needs one number a bucket: the
bucket's vector times the difference of the two output rows. That table (bounded by
the number of buckets) is sent to the tasks.

Defined cases: a null text is empty; an empty text has the bias alone; labels that
are null count as none, and of several labels of one id the largest holds; without
labels of both kinds every score is 0.5 (then nothing is rejected); repeated rows get
equal scores; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix, remainder, ship, text_bytes, texts, word_hashes

#: Labelled documents of each label that the training sees at most.
SAMPLE = 1500
BUCKET_BITS, DIM, EPOCHS, RATE, SEED = 16, 8, 8, 4.0, 11
#: So many features of no weight are added to each document.
PRIOR = 40
#: Scores from here on count as good.
THRESHOLD = 0.3
FOLDS = 5


def characters(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One number for each character of UTF-8 bytes, and the rows' offsets in characters."""
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    padded = np.r_[raw, np.zeros(4, np.uint8)].astype(np.uint32)
    size = np.diff(np.r_[first, len(raw)])
    code = padded[first]
    for k in range(1, 4):
        code = code + np.where(size > k, padded[first + k] << np.uint32(8 * k), np.uint32(0))
    return code.astype(np.uint32), np.searchsorted(first, at)


def grams(code: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n`` characters from each place on, and each row's offsets."""
    m = len(code) - n + 1
    if m < 1:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    h = code[:m].astype(np.uint64)
    for k in range(1, n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[k:k + m]
    inside = np.ones(m, bool)
    for k in range(1, n):
        ends = at[1:-1] - k
        inside[ends[(ends >= 0) & (ends < m)]] = False
    return mix(h[inside] + np.uint64(n)), np.r_[0, np.cumsum(inside)][np.minimum(at, m)]


def features(raw: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the words and of the trigrams of rows of bytes, each with the rows' offsets."""
    shift = np.uint64(64 - BUCKET_BITS)
    words, _, _, ends = word_hashes(raw, at)
    pairs, after = (words[1:] + mix(words[:-1])) >> shift, np.repeat(np.arange(len(at) - 1), np.diff(ends))
    again, inside = words[1:] == words[:-1], after[1:] == after[:-1]
    pairs = np.where(again, 0, pairs.astype(np.int64) | 1)[inside] + (2 << BUCKET_BITS)
    seams = np.r_[0, np.cumsum(inside)][np.maximum(ends - 1, 0)] if len(words) else ends
    code, places = characters(raw, at)
    three, cut = grams(code, places, 3)
    return [((words >> shift).astype(np.int64), ends), (pairs, seams), ((three >> shift).astype(np.int64) + (1 << BUCKET_BITS), cut)]


def _row_blocks(column: pa.Array):
    raw, at = text_bytes(column)
    for first, last in blocks(at):
        yield first, last, raw[at[first]:at[last]], at[first:last + 1] - at[first]


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """doc_id, y and text of the training documents, at most ``most`` of a label."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .filter("y IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("y").alias("y"))
             .filter(remainder("doc_id", FOLDS) != 0).withColumn("order", F.xxhash64("doc_id")))
    chosen = known.filter("y = 0").orderBy("order", "doc_id").limit(most).unionByName(known.filter("y = 1").orderBy("order", "doc_id").limit(most))
    # the sample is bounded by its parameter, so every task may hold it
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "order", "text")


def _counted(sampled: DataFrame) -> DataFrame:
    def build(batches):
        for batch in batches:
            for first, last, raw, at in _row_blocks(batch.column(batch.schema.get_field_index("text"))):
                found = features(raw, at)
                ids, times = [], []
                for i in range(last - first):
                    bucket, n = np.unique(np.concatenate([b[c[i]:c[i + 1]] for b, c in found]), return_counts=True)
                    ids.append(bucket.astype("<i4").tobytes())
                    times.append(n.astype("<i4").tobytes())
                rest = [batch.column(batch.schema.get_field_index(x)).slice(first, last - first) for x in ("doc_id", "y", "order")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "y", "order", "ids", "times"])

    return sampled.mapInArrow(build, "doc_id long, y int, order long, ids binary, times binary")


class Model:
    """One weight a bucket and a bias; ``score`` is the softmax's share of label 1."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias = weight.astype(np.float32), float(bias)

    def score(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
        for bucket, cut in features(raw, at):
            rows = np.flatnonzero(np.diff(cut))
            if len(rows):
                total[rows] += np.add.reduceat(self.weight[bucket].astype(np.float64), cut[rows])
            count += np.diff(cut)
        return 1 / (1 + np.exp(-np.clip(total / (count + PRIOR) + self.bias, -60, 60)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """rows (label, buckets, counts), in the order of training."""
    buckets = 3 << BUCKET_BITS
    if len({y for y, _, _ in rows}) < 2:
        return Model(np.zeros(buckets), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    share = [t / (t.sum() + PRIOR) for _, _, t in rows]
    weigh = {y: len(rows) / 2 / sum(r[0] == y for r in rows) for y in (0, 1)}
    steps = epochs * len(rows)
    for step in range(steps):
        if step % len(rows) == 0:
            order = rng.permutation(len(rows))
        i = order[step % len(rows)]
        y, ids, _ = rows[i]
        f = share[i].astype(np.float32)
        mean = f @ vectors[ids]
        logit = out @ mean + bias
        p = np.exp(logit - logit.max())
        p /= p.sum()
        p[y] -= 1
        p *= np.float32(rate * weigh[y] * (1 - step / steps))
        back = out.T @ p
        out -= np.outer(p, mean)
        bias -= 0.1 * p
        # a bucket's share of a long text is tiny; the step is not
        vectors[ids] -= np.outer(f / max(f.max(initial=0), 1e-9), back) * np.float32(0.05)
    return Model(vectors @ (out[1] - out[0]), bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    ship(docs.sparkSession)
    rows = _counted(sample(docs, labels, most)).collect()  # at most two samples of bounded size
    rows.sort(key=lambda r: (r["order"], r["doc_id"], r["y"], bytes(r["ids"])))
    return train([(r["y"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["times"], "<i4")) for r in rows])


def scorer(docs: DataFrame, model: Model):
    """The score of a text column."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> pa.Array:
        out = [sent.value.score(raw, at) for _, _, raw, at in _row_blocks(column)]
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    call = F.arrow_udf(score, "double")
    return lambda text: call(F.coalesce(F.col(text).cast("string"), F.lit("")))


def rate(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""
    rows = texts(docs)
    scored = rows.select("doc_id", scorer(docs, model)("text").alias("score"))
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model doesn't reject, with all their columns."""
    good: Column = scorer(docs, model)("text") >= threshold
    return docs.filter(good)
