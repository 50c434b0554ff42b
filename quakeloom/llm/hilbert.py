"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors are projected to a few dimensions, shifted, and ordered along a Hilbert
curve; several projections give several orders. Each order is range-partitioned in
Spark and its rows numbered, partition by partition. A query's candidates are the rows
within a window of places around its own on every curve; rows are dealt to blocks of
places, a query visits the blocks its window touches, blocks keep each query's best
by exact distance, and the curves' bests are merged and ranked again.

Projections and shifts are fitted on a bounded sample (principal directions, turned at
random). So is the window: the true neighbours of a bounded sample of queries, found
in blocks over all rows, tell how far along the nearest curve they lie, and the window
takes the share ``AIM`` of them in. Every row is indexed.

Equal vectors are one point with its smallest ids, so a vector that a third of the
rows share is one row of each curve.

Defined cases: vectors that are null, zero, hold null or non-finite components, or have
another length than most take no part, neither as query nor as candidate; ties go to
the smaller id; repeated ids with one vector count once; with fewer candidates than
wanted all are given; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, ship

CURVES, DIMS, BITS = 6, 9, 6
FIT_SAMPLE, TUNE_QUERIES = 4096, 48
#: Share of the sampled queries' true neighbours that the window takes in.
AIM = 0.98
BLOCK = 1024


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of integer points (rows) with ``bits`` bits a dimension."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the finer levels
        low = q - 1
        for i in range(dims):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where(x[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Curves:
    """Projection, shift and scale of each curve."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = BITS, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.bits, self.centre = bits, sample.mean(0)
        dims = min(dims, sample.shape[1], 62 // bits)
        _, _, axes = np.linalg.svd(sample - self.centre, full_matrices=False)
        axes = axes if len(axes) >= dims else np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))[0]
        self.maps = []
        for c in range(curves):
            turn = np.eye(dims) if not c else np.linalg.qr(rng.normal(size=(dims, dims)))[0]
            project = axes[:dims].T @ turn
            at = (sample - self.centre) @ project
            low, high = at.min(0), at.max(0)
            self.maps.append((project, low - rng.uniform(0, 0.5, dims) * (high - low) * (c > 0), np.maximum(high - low, 1e-12).max() * (1.5 if c else 1.0)))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        cells = 1 << self.bits
        out = []
        for project, low, width in self.maps:
            at = ((vectors - self.centre) @ project - low) / width
            out.append(hilbert_keys(np.clip((at * cells).astype(np.int64), 0, cells - 1), self.bits))
        return out


def points(vectors: DataFrame, most: int) -> DataFrame:
    """Distinct vectors that take part: id (the smallest), ids (the ``most`` smallest), v (doubles)."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(~F.exists("v", bad) & F.exists("v", lambda x: x != 0)).distinct()
    length = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    good = good.filter(F.size("v") == (length["n"] if length else 0))
    rank = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    return good.withColumn("r", rank).filter(F.col("r") <= most).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("id"), "ids", "v")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def places(rows: DataFrame, curves: Curves) -> DataFrame:
    """curve, pos, id, v: every point's place on every curve."""
    sent = rows.sparkSession.sparkContext.broadcast(curves)

    def build(batches):
        for batch in batches:
            if len(batch):
                for c, key in enumerate(sent.value.keys(matrix(batch.column(batch.schema.get_field_index("v"))))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key), batch.column(batch.schema.get_field_index("id"))], ["curve", "key", "id"])

    keys = rows.select("id", "v").mapInArrow(build, "curve int, key long, id long")
    dealt = materialise(keys.repartitionByRange("curve", "key", "id").withColumn("part", F.spark_partition_id()), "curves")
    counts = dealt.groupBy("curve", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(W.partitionBy("curve").orderBy("part")) - F.col("n")).drop("n")
    own = F.row_number().over(W.partitionBy("curve", "part").orderBy("key", "id"))
    return materialise(dealt.withColumn("own", own).join(before, ["curve", "part"]).select("curve", "id", (F.col("before") + F.col("own") - 1).alias("pos")), "places")


def nearest(block: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of a block, ties to the smaller id: ids and distances."""
    distance = np.sqrt(((block - query) ** 2).sum(1))
    if allowed is not None:
        distance, ids = distance[allowed], ids[allowed]
    if len(distance) > k:
        edge = np.partition(distance, k - 1)[k - 1]
        near = distance <= edge
        distance, ids = distance[near], ids[near]
    order = np.lexsort((ids, distance))[:k]
    return ids[order], distance[order]


def tuned_window(rows: DataFrame, at: DataFrame, queries: DataFrame, k: int, aim: float = AIM, most: int = TUNE_QUERIES) -> int:
    """How many places to either side a window needs to hold the share ``aim`` of true neighbours."""
    chosen = queries.orderBy(F.xxhash64("id"), "id").limit(most).select("id", "v").collect()  # a bounded sample
    if not chosen:
        return 0
    sent = rows.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in chosen]), np.array([r["v"] for r in chosen])))

    def build(batches):
        own, vectors = sent.value
        for batch in batches:
            if len(batch):
                ids, block = batch.column(0).to_numpy(), matrix(batch.column(1))
                for q, v in zip(own, vectors):
                    near, distance = nearest(block, ids, v, k + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), q)), pa.array(near), pa.array(distance)], ["q", "id", "d"])

    best = F.row_number().over(W.partitionBy("q").orderBy("d", "id"))
    true = rows.select("id", "v").mapInArrow(build, "q long, id long, d double").filter("q <> id").withColumn("r", best).filter(F.col("r") <= k).select("q", "id")
    here = at.select("curve", "id", "pos")
    apart = (true.join(here, "id").join(here.select("curve", F.col("id").alias("q"), F.col("pos").alias("own")), ["curve", "q"])
             .groupBy("q", "id").agg(F.min(F.abs(F.col("pos") - F.col("own"))).alias("apart")).collect())  # k rows for each sampled query
    return int(np.ceil(np.quantile([r["apart"] for r in apart], aim))) if apart else 0


def search(vectors: DataFrame, every: int = 100, k: int = 10, window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(points(vectors, k + 1), "points")
    # each query id finds the point it belongs to, also where the point's list of ids leaves it out
    asked = vectors.select(F.col("vec_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("v")).filter(F.col("query_id") % every == 0).distinct()
    asked = materialise(asked.join(rows.select("id", "v"), "v").select("query_id", "id"), "queries")
    queries = materialise(rows.join(asked.select("id").distinct(), "id").select("id", "v"), "query-points")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_SAMPLE).select("v").collect()  # a bounded sample
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    at = places(rows, Curves(np.array([r["v"] for r in sample])))
    width = tuned_window(rows, at, queries, k) if window is None else window
    block = F.floor(F.col("pos") / BLOCK)
    stored = at.withColumn("block", block).join(rows.select("id", "v"), "id")
    looking = at.join(queries, "id").select(
        F.col("curve").alias("c2"), F.explode(F.sequence(F.floor(F.greatest(F.col("pos") - width, F.lit(0)) / BLOCK), F.floor((F.col("pos") + width) / BLOCK))).alias("b2"),
        F.col("id").alias("q"), F.col("pos").alias("own"), "v")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "d": pd.Series(dtype="float64")})
        data, ids, pos = np.stack(left["v"].to_numpy()), left["id"].to_numpy(), left["pos"].to_numpy()
        out = []
        for q, own, v in zip(right["q"], right["own"], right["v"]):
            near, distance = nearest(data, ids, np.asarray(v), k + 1, np.abs(pos - own) <= width)
            out.append((np.full(len(near), q), near, distance))
        return pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("q", "id", "d"))})

    found = stored.groupBy("curve", "block").cogroup(looking.groupBy("c2", "b2")).applyInPandas(meet, "q long, id long, d double")
    best = F.row_number().over(W.partitionBy("q").orderBy("d", "id"))
    merged = found.distinct().withColumn("r", best).filter(F.col("r") <= k + 1).select("q", "id", "d")
    told = (asked.withColumnRenamed("id", "q").join(merged, "q").join(rows.select("id", "ids"), "id")
            .select("query_id", F.explode("ids").alias("vec_id"), F.col("d").alias("score")).filter("vec_id <> query_id"))
    last = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return told.withColumn("rank", last).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
