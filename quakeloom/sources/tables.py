"""Keyed collections: upserts whose outcome depends on keys and versions alone.

A collection is two Parquet datasets partitioned by a hash bucket of the key: the
``base``, one row per key, and the ``changes`` that micro-batches wrote since.
Whatever arrives is stored; which version of a document counts is decided when
rows meet, by (writer, batch, order). A replay writes the same versions again and
changes nothing. A writer is one stream checkpoint, so the batch numbers of a
new checkpoint and the offsets of a re-created topic cannot hide older ones.

``compact`` merges the changes into the buckets they touch and leaves the others
alone. It is a job of its own, outside of the streams.

Buckets grow by linear hashing: a bucket number is the hash modulo the number of
buckets at the last doubling, or modulo twice that where the bucket is already split.
One more bucket so takes its rows from one other, and growing by some rewrites
only those that they split. Changes are addressed when they are merged, so a
stream need not know how many buckets there are.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeloom.operators.rows import ranked_first
from quakeloom.session import delete, exists, prepare

ORDER, WRITER, BATCH, BUCKET = "_order", "_writer", "_batch", "_bucket"
VERSION = [WRITER, BATCH, ORDER]
LAYOUT = "first INT, buckets INT"
PLAN = f"{LAYOUT}, rewritten ARRAY<INT>"


def doubled(first: int, buckets: int) -> int:
    """The number of buckets at the last doubling of ``first``."""
    while 2 * first <= buckets:
        first *= 2
    return first


def mongo_collection(spark: SparkSession, uri: str, database: str, collection: str, schema: str) -> DataFrame:
    """An existing document collection with a declared schema (needs the MongoDB
    connector package); a starting point for moving it into a :class:`Collection`."""
    options = {"connection.uri": uri, "database": database, "collection": collection}
    return spark.read.format("mongodb").options(**options).schema(schema).load()


def writer_of(spark: SparkSession, checkpoint: str) -> int:
    """The number of a checkpoint's writer: the moment it was first used, kept inside of it."""
    path = f"{checkpoint.rstrip('/')}/writer"
    if not exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(time.time_ns() // 1000,)], "writer BIGINT").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).first()["writer"]


class Collection:
    """``keys`` identify a document; ``_order`` (such as the message offset) orders the
    versions of one batch. ``first`` keeps the oldest version instead of the newest.
    Within a bucket the base is sorted by ``cluster_by``, a time column, so that
    reads of a period skip row groups. A collection starts with ``buckets``; a
    compaction adds so many that a bucket holds ``fill`` documents on average. A
    bucket is what a compaction rewrites at least."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], cluster_by: str | None = None,
                 buckets: int = 8, first: bool = False, fill: int = 1_000_000):
        self.spark = prepare(spark)
        self.cluster_by = cluster_by
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets
        self.first = first
        self.fill = fill
        self.schema = f"{schema}, {ORDER} BIGINT, {WRITER} BIGINT, {BATCH} BIGINT, {BUCKET} INT"
        self.columns = self._none().columns

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _read(self, name: str, schema: str | None = None) -> DataFrame | None:
        path = f"{self.path}/{name}"
        if not exists(self.spark, path):
            return None
        found = self.spark.read.schema(schema or self.schema).parquet(path)
        return found.select(self.columns) if schema is None else found

    def layout(self) -> tuple[int, int]:
        """Buckets at the start and now."""
        if self._staged():
            found = self._plan()
            return found["first"], found["buckets"]
        if not exists(self.spark, f"{self.path}/layout/_SUCCESS"):
            return self.buckets, self.buckets
        found = self.spark.read.schema(LAYOUT).parquet(f"{self.path}/layout").first()
        return found["first"], found["buckets"]

    def _address(self, first: int, buckets: int) -> Column:
        level = doubled(first, buckets)
        wide = F.pmod(F.xxhash64(*self.keys), F.lit(2 * level))
        return F.when(wide < buckets, wide).otherwise(F.pmod(F.xxhash64(*self.keys), F.lit(level))).cast("int")

    def _staged(self) -> bool:
        return exists(self.spark, f"{self.path}/staging/_SUCCESS")

    def _plan(self):
        """What the staged buckets replace: the layout with them, and the numbers of all buckets rewritten."""
        return self.spark.read.schema(PLAN).parquet(f"{self.path}/staging-plan").first()

    def _base(self) -> DataFrame | None:
        """The base; while staged buckets wait to replace some of it, with them in the place of those."""
        base = self._read("base")
        if not self._staged():
            return base
        staged = self._read("staging")
        return staged if base is None else base.filter(~F.col(BUCKET).isin(self._plan()["rewritten"])).unionByName(staged)

    def _write(self, rows: DataFrame, name: str, *partitions: str) -> None:
        """Replace the partitions that ``rows`` have and leave the others."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(f"{self.path}/{name}")

    def _latest(self, rows: DataFrame) -> DataFrame:
        order = [F.col(c).asc_nulls_last() if self.first else F.col(c).desc_nulls_last() for c in VERSION]
        return ranked_first(rows, self.keys, *order)

    def upsert(self, rows: DataFrame, batch_id: int, writer: int = 0, unique: bool = False) -> None:
        """Store one batch; ``rows`` carry ``_order`` and need not be unique. Where the caller has
        made them so, ``unique`` spares the shuffle that looks for repeats.

        Columns the batch does not carry keep their stored values.
        """
        rows = rows.withColumns({
            WRITER: F.lit(writer).cast("long"), BATCH: F.lit(batch_id).cast("long"),
            BUCKET: F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")})
        newest = rows if unique else self._latest(rows)
        narrow = [c for c in self.columns if c not in newest.columns]
        if narrow:
            earlier = self._current(but=(writer, batch_id)).select(*self.keys, *narrow)
            newest = newest.join(earlier, self._same_key(newest, earlier), "left").select(
                *[newest[c] for c in newest.columns], *[earlier[c] for c in narrow])
        self._write(newest.select(self.columns), "changes", WRITER, BATCH, BUCKET)

    def _same_key(self, left: DataFrame, right: DataFrame) -> Column:
        match = F.lit(True)
        for k in self.keys:
            match = match & left[k].eqNullSafe(right[k])
        return match

    def current(self) -> DataFrame:
        """One row per key, as far as stored."""
        return self._current().drop(*VERSION, BUCKET)

    def _current(self, but: tuple[int, int] | None = None) -> DataFrame:
        """The changes are small next to the base: the planner can ship them to it
        by their file size, and the base is not shuffled then."""
        base, recent = self._base(), self._read("changes")
        if recent is not None:
            if but is not None:
                recent = recent.filter((F.col(WRITER) != but[0]) | (F.col(BATCH) != but[1]))
            recent = self._latest(recent)
        if base is None or recent is None:
            return self._none() if base is None and recent is None else recent if base is None else base
        return self._overlay(base, recent)

    def _overlay(self, base: DataFrame, recent: DataFrame) -> DataFrame:
        new = recent.select(F.struct(*self.columns).alias("_new"), *[F.col(k).alias(f"_k_{k}") for k in self.keys])
        match = F.lit(True)
        for k in self.keys:
            match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        mine, theirs = F.struct(*VERSION), F.struct(*[F.col(f"_new.{c}").alias(c) for c in VERSION])
        wins = F.col("_new").isNotNull() & ((theirs < mine) if self.first else (theirs >= mine))
        kept = base.join(new, match, "left").select(
            *[F.when(wins, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in self.columns])
        # keys of the changes that the base holds: few, found without moving the base
        known = base.select(*self.keys).join(recent.select(*self.keys), self._same_key(base, recent), "left_semi")
        inserted = recent.join(known, self._same_key(recent, known), "left_anti")
        return kept.unionByName(inserted.select(self.columns))

    def compact(self) -> int:
        """Merge the changes stored so far into the buckets they touch; returns how many buckets.

        The merged buckets are complete in ``staging`` before they replace those of the
        base. If the driver is lost in between, the next compaction replaces them
        again, and reads meanwhile take the staged ones; changes that were merged and not
        dropped are merged once more.
        """
        self._replace()
        changes = self._read("changes")
        if changes is None:
            return 0
        batches = [(r[0], r[1]) for r in changes.select(WRITER, BATCH).distinct().collect()]  # folders, not rows
        taken = changes.join(F.broadcast(self.spark.createDataFrame(batches, f"{WRITER} BIGINT, {BATCH} BIGINT")), [WRITER, BATCH])
        base, (first, before) = self._read("base"), self.layout()
        held = taken.count() + (0 if base is None else base.count())  # file footers alone; a key may count twice
        now = max(before, -(-held // self.fill))
        level = doubled(first, before)
        parents = {n if n < before else n % level for n in (b % (2 * level) for b in range(before, now))}
        touched = {r[0] for r in taken.select(self._address(first, before)).distinct().collect()}
        rows = taken.select(self.columns)
        if base is not None:
            rows = rows.unionByName(base.filter(F.col(BUCKET).isin(sorted(touched | parents))))
        rows = rows.withColumn(BUCKET, self._address(first, now))
        rewritten = sorted(touched | parents | set(range(before, now)))
        self.spark.createDataFrame([(first, now, rewritten)], PLAN).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/staging-plan")
        merged = self._latest(rows)
        # the keys split a moment that very many documents share
        order = [BUCKET, *[c for c in (self.cluster_by,) if c], *self.keys]
        merged = merged.repartitionByRange(*order).sortWithinPartitions(*order)
        merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/staging")
        self._replace()
        for writer, batch in batches:
            delete(self.spark, f"{self.path}/changes/{WRITER}={writer}/{BATCH}={batch}")
        return len(touched)

    def _replace(self) -> None:
        """Put staged buckets into the base. Cut off at any point, it is done again as a whole."""
        if self._staged():
            staged, plan = self._read("staging"), self._plan()
            self._write(staged.sortWithinPartitions(BUCKET, *[c for c in (self.cluster_by,) if c]), "base", BUCKET)
            filled = {r[0] for r in staged.select(BUCKET).distinct().collect()}
            for empty in set(plan["rewritten"]) - filled:  # all of its documents moved to a split's other half
                delete(self.spark, f"{self.path}/base/{BUCKET}={empty}")
            self.spark.createDataFrame([(plan["first"], plan["buckets"])], LAYOUT).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout")
            delete(self.spark, f"{self.path}/staging/_SUCCESS")  # first, so that a folder half deleted counts for nothing
        delete(self.spark, f"{self.path}/staging")

    def append_dead_letters(self, rows: DataFrame, batch_id: int, writer: int = 0) -> None:
        numbered = rows.withColumns({WRITER: F.lit(writer).cast("long"), BATCH: F.lit(batch_id).cast("long")})
        # what is broken is little, but finding it reads the whole batch: that stays spread, only the finds are gathered
        self._write(numbered.repartition(2, F.xxhash64("value")), "dead", WRITER, BATCH)

    def dead_letters(self) -> DataFrame:
        schema = "reason STRING, message_key STRING, value STRING"
        found = self._read("dead", schema)
        return self.spark.createDataFrame([], schema) if found is None else found.select("reason", "message_key", "value")
