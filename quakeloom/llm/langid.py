"""Language identification by error-correcting output codes.

Each language has a codeword; each bit has a binary classifier over hashed character
n-grams (one to three characters), and a text's margins are the means of its
n-grams' weights. A language's loss is the sum of the bits' logistic losses against
its codeword, weighted by how well each bit held on the training sample; the
nearest codeword wins. A text whose two nearest are close is flagged ambiguous.

Training sees at most ``SAMPLE`` whole texts a language, those with the least hash
of their id. All bits are trained together by stochastic gradient descent in numpy;
up to five languages get all distinct bits, more get a seeded random code with the
widest least distance.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is
everything if no language could be learned; a single learned language has every
other text with score 1; equal losses go to the language first in order; repeated
rows get equal results; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, blocks, remainder, ship, text_bytes, texts
from .quality import characters, grams

SAMPLE = 300
BUCKET_BITS, EPOCHS, RATE, SEED = 14, 6, 2.0, 5
FOLDS, HELD_OUT = 4, 2
#: Two codewords whose losses differ by less share of the bits leave the text ambiguous.
MARGIN = 0.05
SCALE = 40.0


def codewords(languages: int, seed: int = SEED) -> np.ndarray:
    """A codeword of -1 and 1 for each language, one row each."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 5:  # every split of the languages in two
        bits = [b for b in itertools.product((-1, 1), repeat=languages) if b[0] == 1 and -1 in b]
        return np.array(bits, float).T
    rng, width = np.random.default_rng(seed), int(np.ceil(10 * np.log2(languages)))
    best, distance = None, -1
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), (languages, width))
        apart = (width - code @ code.T) / 2 + np.eye(languages) * width
        if apart.min() > distance and (abs(code.sum(0)) < languages).all():
            best, distance = code, apart.min()
    return best


def buckets(raw: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    code, places = characters(LOWER[raw], at)
    shift = np.uint64(64 - BUCKET_BITS)
    return [((h >> shift).astype(np.int64), cut) for h, cut in (grams(code, places, n) for n in (1, 2, 3))]


class Model:
    def __init__(self, languages: list[str], code: np.ndarray, weight: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weight, self.bias, self.trust = languages, code, weight.astype(np.float32), bias, trust

    def margins(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        total, count = np.zeros((len(at) - 1, self.code.shape[1])), np.zeros(len(at) - 1)
        for bucket, cut in buckets(raw, at):
            if not len(bucket):
                continue
            rows = np.flatnonzero(np.diff(cut))
            total[rows] += np.add.reduceat(self.weight[bucket], cut[rows], axis=0)
            count += np.diff(cut)
        return total * (SCALE / np.maximum(count, 1))[:, None] + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of the nearest codeword, its share of the softmax over the losses, and whether it is ambiguous."""
        loss = np.stack([(np.logaddexp(0, -c * margins) * self.trust).sum(1) for c in self.code], 1)
        best = loss.argmin(1)
        weight = np.exp(loss.min(1, keepdims=True) - loss)
        two = np.sort(loss, 1)
        close = (two[:, 1] - two[:, 0] < MARGIN * max(self.trust.sum(), 1e-9)) if loss.shape[1] > 1 else np.zeros(len(loss), bool)
        return best, 1 / weight.sum(1), close


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """rows (language, buckets, counts), in the order of training."""
    languages = sorted({r[0] for r in rows})
    code = codewords(len(languages))
    rng, bits = np.random.default_rng(SEED), code.shape[1]
    weight, bias = np.zeros((1 << BUCKET_BITS, bits), np.float32), np.zeros(bits)
    target = np.array([code[languages.index(r[0])] for r in rows]).reshape(len(rows), bits)
    share = [(SCALE * t / max(t.sum(), 1)).astype(np.float32) for _, _, t in rows]
    steps = EPOCHS * len(rows) if bits else 0
    for step in range(steps):
        if step % len(rows) == 0:
            order = rng.permutation(len(rows))
        i = order[step % len(rows)]
        ids = rows[i][1]
        margin = share[i] @ weight[ids] + bias
        pull = target[i] / (1 + np.exp(np.clip(target[i] * margin, -60, 60))) * RATE * (1 - step / steps)
        weight[ids] += np.outer(share[i], pull).astype(np.float32) / 10
        bias += pull / 100
    hits = np.array([np.sign(s @ weight[r[1]] + bias) == t for s, r, t in zip(share, rows, target)]).reshape(len(rows), bits)
    trust = np.clip(2 * hits.mean(0) - 1, 0.01, 1) if len(rows) and bits else np.ones(bits)
    return Model(languages, code, weight, bias, trust)


def fit(docs: DataFrame, most: int = SAMPLE) -> Model:
    ship(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("order"))
    known = known.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(remainder("doc_id", FOLDS) != HELD_OUT).distinct()
    first = F.row_number().over(W.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = known.withColumn("r", first).filter(F.col("r") <= most).select("doc_id", "lang", "order")

    def build(batches):
        for batch in batches:
            raw, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
            for a, b in blocks(at):
                found = buckets(raw[at[a]:at[b]], at[a:b + 1] - at[a])
                ids, times = [], []
                for i in range(b - a):
                    bucket, n = np.unique(np.concatenate([x[c[i]:c[i + 1]] for x, c in found]), return_counts=True)
                    ids.append(bucket.astype("<i4").tobytes())
                    times.append(n.astype("<i4").tobytes())
                rest = [batch.column(batch.schema.get_field_index(x)).slice(a, b - a) for x in ("doc_id", "lang", "order")]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(ids, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "lang", "order", "ids", "times"])

    # bounded by the sample a language, so every task may hold the chosen ids
    sampled = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "lang", "order", "text")
    rows = sampled.mapInArrow(build, "doc_id long, lang string, order long, ids binary, times binary").collect()
    rows.sort(key=lambda r: (r["order"], r["doc_id"], r["lang"], bytes(r["ids"])))
    return train([(r["lang"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["times"], "<i4")) for r in rows if len(r["ids"])])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of each row."""
    rows = texts(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def build(batches):
        own = sent.value
        names = np.array([*own.languages, "und"], object)
        for batch in batches:
            raw, at = text_bytes(batch.column(batch.schema.get_field_index("text")))
            spelt = batch.column(batch.schema.get_field_index("spelt")).to_numpy(zero_copy_only=False)
            for a, b in blocks(at):
                if own.languages:
                    best, score, close = own.decode(own.margins(raw[at[a]:at[b]], at[a:b + 1] - at[a]))
                else:
                    best, score, close = np.zeros(b - a, int), np.zeros(b - a), np.zeros(b - a, bool)
                none = ~spelt[a:b] | (not own.languages)
                best, score, close = np.where(none, len(own.languages), best), np.where(none, 0.0, score), close & ~none
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("doc_id")).slice(a, b - a), pa.array(names[best], pa.string()), pa.array(score), pa.array(close)],
                    ["doc_id", "lang_pred", "score", "ambiguous"])

    marked = rows.withColumn("spelt", F.col("text").rlike(r"\p{L}"))
    found = marked.mapInArrow(build, "doc_id long, lang_pred string, score double, ambiguous boolean")
    return found.select("doc_id", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "ambiguous")
