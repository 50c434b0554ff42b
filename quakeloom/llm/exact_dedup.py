"""Exact dedup of an incoming batch against immutable snapshots, by static filters.

A snapshot is kept as its exact buckets: one row per text digest with the id that
stays and the number of copies. Its digests are dealt to shards and each shard
gets a static binary-fuse filter. The batch's own copies are grouped first, so a
digest that a third of the rows share reaches its shard once. Screened digests
are either surely new, or positives that join the exact buckets.

Bytes decide: every text whose digest has more than one row is grouped by
(digest, text) itself, partially aggregated before the shuffle. Only texts that
may have a copy travel; should two texts share a digest, their rows are told
apart by the text.

Defined cases: a null text is empty; a null id never stays when its group has
another; of repeated rows (same id, same text) one is kept; other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fuse_contains, fuse_filter, materialise, remainder, screen, texts

#: Digests of a snapshot that share one filter.
SHARD_KEYS = 500_000


def sha(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def short(digest: Column) -> Column:
    """The first 64 bits of a digest."""
    return F.conv(F.hex(F.substring(digest, 1, 8)), 16, -10).cast("long")


def buckets(rows: DataFrame) -> DataFrame:
    """The exact buckets of rows (digest, doc_id): digest, keep_id, copies."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("copies"))


def build_filters(snapshot: DataFrame, shards: int) -> DataFrame:
    """One static filter per shard of a snapshot's digests: shard, seed, length, segments, prints."""
    def build(batch: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, prints = fuse_filter(np.unique(batch["h"].to_numpy(np.int64)))
        return pd.DataFrame({"shard": [batch["shard"].iloc[0]], "seed": [seed], "length": [length], "segments": [segments], "prints": [prints.tobytes()]})

    keys = snapshot.select(short(F.col("digest")).alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return keys.groupBy("shard").applyInPandas(build, "shard int, seed int, length int, segments int, prints binary")


def positives(batch: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The batch's distinct digests that its shard's filter lets through."""
    def test(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(right) or not len(left):
            return left[["digest"]].iloc[:0]
        f = right.iloc[0]
        built = int(f["seed"]), int(f["length"]), int(f["segments"]), np.frombuffer(f["prints"], np.uint8)
        return left.loc[fuse_contains(built, left["h"].to_numpy(np.int64)), ["digest"]]

    keys = batch.select("digest", short(F.col("digest")).alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(test, "digest binary")


def repeated(rows: DataFrame, snapshot: Column) -> DataFrame:
    """Digests of more than one row, by snapshot and batch: (digest, keep_id, copies)."""
    dealt = materialise(rows.withColumn("stored", snapshot).groupBy("stored", "digest").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("copies")), "buckets")
    old, new = (dealt.filter(side).drop("stored") for side in ("stored", "NOT stored"))
    shards = 1 + old.count() // SHARD_KEYS
    passed = positives(new, materialise(build_filters(old, shards), "filters"), shards)
    both = (old.join(passed, "digest")  # a false positive finds no bucket here
            .withColumnsRenamed({"keep_id": "old_id", "copies": "old_copies"}).join(new, "digest")
            .select("digest", F.greatest("keep_id", "old_id").alias("keep_id"), (F.col("copies") + F.col("old_copies")).alias("copies")))
    both = materialise(both, "across")
    alone = old.unionByName(new).filter("copies > 1").join(both.select("digest"), "digest", "left_anti")
    return materialise(both.unionByName(alone), "repeated")


def groups(docs: DataFrame, digest: Column | None = None, snapshot: Column | None = None) -> DataFrame:
    """Groups of more than one row with equal texts: digest, text_no, keep_id, group_size, texts, text.

    ``texts`` is the number of different texts of the digest; text is null where it is 1.
    ``snapshot`` marks the rows that count as stored (half of the ids if not given).
    """
    digest = sha() if digest is None else digest
    stored = remainder("doc_id", 2) == 0 if snapshot is None else snapshot
    rows = texts(docs).withColumn("digest", digest)
    found = repeated(rows.select("doc_id", "digest"), stored)
    keys = found.select(short(F.col("digest")).alias("h")).distinct()
    suspects, _ = screen(rows, short(F.col("digest")), keys)
    checked = suspects.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    checked = materialise(checked.withColumn("text", F.when(F.count("*").over(W.partitionBy("digest")) > 1, F.col("text")))
                          .filter("group_size > 1 OR text IS NOT NULL"), "checked")
    return checked


def dedup(docs: DataFrame, digest: Column | None = None, snapshot: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept."""
    digest = sha() if digest is None else digest
    found = groups(docs, digest, snapshot)
    same = found.filter("text IS NULL").select(F.col("digest").alias("d"), F.col("keep_id").alias("k"), F.col("group_size").alias("n"))
    apart = found.filter("text IS NOT NULL").select(F.col("digest").alias("d2"), F.col("text").alias("t2"),
                                                    F.col("keep_id").alias("k2"), F.col("group_size").alias("n2"))
    rows = texts(docs).withColumn("digest", digest)
    # texts of digests that stand for several texts are told apart by the text; such digests hardly exist
    if not apart.isEmpty():
        hit = apart.select("d2").distinct()
        mixed = rows.join(hit, F.col("digest") == F.col("d2"), "left_semi").join(
            apart, (F.col("digest") == F.col("d2")) & (F.col("text") == F.col("t2"))).select("doc_id", "digest", F.col("k2").alias("k"), F.col("n2").alias("n"))
        rows = rows.join(hit, F.col("digest") == F.col("d2"), "left_anti")
    else:
        mixed = None
    slim = rows.select("doc_id", "digest").join(same, F.col("digest") == F.col("d"), "left").select("doc_id", "digest", "k", "n")
    every = slim if mixed is None else slim.unionByName(mixed)
    # copies of one row (same id, same text) count one by one; a group of such rows keeps the first
    told = every.select("doc_id", "digest", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("k")).alias("keep_id"),
                        F.coalesce("n", F.lit(1)).alias("group_size"))
    return _one_of_repeats(told)


def _one_of_repeats(told: DataFrame) -> DataFrame:
    """``kept``: true for the row whose id stays, once when whole rows repeat."""
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    lone = told.filter((F.col("group_size") == 1) | ~stays).withColumn("kept", stays)
    # at least one row per group; partial sums before the shuffle, then the repeats come back
    rows = told.filter((F.col("group_size") > 1) & stays).groupBy(*told.columns).agg(F.count("*").alias("n"))
    back = rows.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(*told.columns, (F.col("i") == 1).alias("kept"))
    return lone.unionByName(back)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows without a copy pass without a shuffle where the screen applies; the others
    are grouped by (digest, text) and of each group the row with the largest id stays.
    """
    columns = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = groups(docs)
    keys = found.select(short(F.col("digest")).alias("h")).distinct()
    whole = docs.select(F.struct(*columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), text.alias("text"))
    whole = whole.withColumn("digest", sha())
    suspects, clean = screen(whole, short(F.col("digest")), keys)
    # max_by keeps one whole row per task and text before the shuffle
    stays = suspects.groupBy("digest", "text").agg(F.max_by("doc", F.coalesce("id", F.lit(-2**63))).alias("doc")).select("doc.*")
    return stays if clean is None else stays.unionByName(clean.select("doc.*"))
