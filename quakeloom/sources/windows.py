"""Ledger of loaded time windows: what a poll or a backfill still has to load.

Windows are half-open ``[start, end)``. They may be recorded in any order, overlap,
repeat or lie inside one another; empty and unknown ones count for nothing. The rows
of one feed are its recorded windows, one a load, and :meth:`WindowLedger.compact`
reduces them to their union.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeloom.session import exists

SCHEMA = "feed STRING, start TIMESTAMP, end TIMESTAMP"
BEFORE = Window.unboundedPreceding, -1


def _proper(loaded: DataFrame) -> DataFrame:
    return loaded.filter(F.col("start") < F.col("end")).select("feed", "start", "end")


def covered(loaded: DataFrame) -> DataFrame:
    """Union of the windows per feed, as disjoint windows that don't touch."""
    by_start = Window.partitionBy("feed").orderBy("start", "end")
    reached = F.max("end").over(by_start.rowsBetween(*BEFORE))
    fresh = _proper(loaded).withColumn("fresh", (reached.isNull() | (F.col("start") > reached)).cast("int"))
    islands = fresh.withColumn("island", F.sum("fresh").over(by_start))
    return islands.groupBy("feed", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def missing(loaded: DataFrame, wanted: DataFrame) -> DataFrame:
    """The parts of each wanted window (feed, since, until) that no loaded window covers.

    A feed that was never loaded misses all of its window; feeds nobody asked for are left out.
    """
    wanted = wanted.filter(F.col("since") < F.col("until")).select("feed", "since", "until").distinct()
    inside = covered(loaded).join(wanted, "feed").filter((F.col("end") > F.col("since")) & (F.col("start") < F.col("until")))
    edges = [wanted.withColumns({"start": F.col(x), "end": F.col(x)}) for x in ("since", "until")]
    every = inside.select("feed", "since", "until", "start", "end").unionByName(edges[0]).unionByName(edges[1])
    by_start = Window.partitionBy("feed", "since", "until").orderBy("start", "end")
    gaps = every.withColumn("reached", F.max("end").over(by_start.rowsBetween(*BEFORE))).filter(F.col("start") > F.col("reached"))
    return gaps.select("feed", F.greatest("reached", "since").alias("start"), F.least("start", "until").alias("end"))


def overlaps(loaded: DataFrame) -> DataFrame:
    """Windows that were loaded twice or more: a feed's stretches under several recorded windows, with the most at once."""
    both = _proper(loaded).select("feed", F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step")))).alias("x"))
    steps = both.groupBy("feed", "x.at").agg(F.sum("x.step").alias("step"))
    by_time = Window.partitionBy("feed").orderBy("at")
    depth = steps.withColumn("depth", F.sum("step").over(by_time)).withColumn("end", F.lead("at").over(by_time))
    twice = depth.filter("depth > 1").select("feed", F.col("at").alias("start"), "end", "depth")
    joined = covered(twice)
    held = twice.select("feed", F.col("start").alias("at"), "depth").join(joined, "feed").filter((F.col("at") >= F.col("start")) & (F.col("at") < F.col("end")))
    return held.groupBy("feed", "start", "end").agg(F.max("depth").alias("most"))


def in_steps(windows: DataFrame, step: str) -> DataFrame:
    """Windows cut into pieces of at most ``step`` (such as ``30 days``), as an API with a row limit asks for."""
    length = F.expr(f"INTERVAL {step}")
    pieces = windows.withColumn("from", F.explode(F.sequence("start", "end", length))).filter(F.col("from") < F.col("end"))
    return pieces.select("feed", F.col("from").alias("start"), F.least(F.col("from") + length, F.col("end")).alias("end"))


@dataclass(frozen=True)
class WindowLedger:
    """Recorded windows under ``path``; a window is recorded when its load is done, so a load cut off is done again."""

    spark: SparkSession
    path: str

    def loaded(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def record(self, windows: DataFrame) -> None:
        windows.select(F.col("feed"), F.col("start").cast("timestamp"), F.col("end").cast("timestamp")).write.mode("append").parquet(self.path)

    def missing(self, wanted: DataFrame) -> DataFrame:
        return missing(self.loaded(), wanted)

    def compacted(self, path: str) -> WindowLedger:
        """A ledger at ``path`` with the union of this one's windows."""
        covered(self.loaded()).write.mode("overwrite").parquet(path)
        return WindowLedger(self.spark, path)

    def load(self, feed: str, since: datetime, until: datetime, load: Callable[[datetime, datetime], None], step: str = "30 days") -> int:
        """Call ``load`` for each piece of ``[since, until)`` that is not loaded yet, oldest first; returns their number.

        A poll asks from the start of its history to now and so goes on from the end of the last one;
        a backfill fills the days that were skipped. ``load`` may see a piece again if it fails in it.
        """
        wanted = self.spark.createDataFrame([(feed, since, until)], "feed STRING, since TIMESTAMP, until TIMESTAMP")
        pieces = in_steps(self.missing(wanted), step).orderBy("start").collect()
        for piece in pieces:
            load(piece["start"], piece["end"])
            self.record(self.spark.createDataFrame([tuple(piece)], SCHEMA))
        return len(pieces)
