"""Live daily cells that follow corrections: each event counts once, with its newest version.

Two collections hold the state: what every event last contributed, and the figures of
each day and cell. A batch subtracts the earlier contributions of its keys and adds the
new ones. Counts follow by sums. A maximum follows too, unless the event that held
it moved away or shrank: only such cells are computed again from their contributions.

A batch reads the state as it was before that batch, so a batch that runs again after a
failure, whatever part of it was already written, gives the same state. Compact through :meth:`compact`,
between triggers, as that drops the state before the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakeloom.functions import grid
from quakeloom.functions.numeric import is_known
from quakeloom.operators.rows import ranked_first
from quakeloom.session import materialise
from quakeloom.sources.tables import ORDER, Collection, writer_of

PLACE = ["day", *grid.CELL]


class CorrectedCells:
    """Event count and largest magnitude per day and live cell over the newest versions of all events."""

    def __init__(self, spark: SparkSession, root: str, key: str = "event_id", size: float = 5.0, buckets: int = 8):
        self.spark, self.key, self.size, self.root = spark, key, size, root.rstrip("/")
        where = "day DATE, grid_lat DOUBLE, grid_lon DOUBLE"
        self.events = Collection(spark, f"{self.root}/contributions", f"{key} STRING, {where}, magnitude DOUBLE", [key], buckets=buckets)
        self.cells = Collection(spark, f"{self.root}/cells", f"{where}, event_count BIGINT, max_mag DOUBLE", PLACE, buckets=buckets)

    def contributions(self, rows: DataFrame) -> DataFrame:
        """The newest version of each key in a batch: its day, cell and magnitude, all null if it counts nowhere."""
        newest = ranked_first(rows, [self.key], F.col(ORDER).desc_nulls_last())
        counts = is_known("latitude", "longitude", "magnitude") & F.col("ts").isNotNull()
        placed = grid.with_cell(newest.withColumn("day", F.to_date("ts")), self.size, grid.LIVE)
        return placed.select(self.key, *[F.when(counts, F.col(c)).alias(c) for c in (*PLACE, "magnitude")], ORDER)

    def apply(self, rows: DataFrame, batch_id: int, writer: int = 0) -> None:
        """Take in one batch of versions; ``rows`` carry the key, latitude, longitude, magnitude, ts and ``_order``."""
        new = materialise(self.contributions(rows), "new-versions")
        before = (writer, batch_id)
        known = self.events._current(but=before).select(self.key, *PLACE, "magnitude")
        old = materialise(known.join(new.select(self.key), self.key, "left_semi"), "old-versions")
        signed = new.select(*PLACE, F.lit(1).alias("n"), "magnitude", F.lit(None).cast("double").alias("gone")).unionByName(
            old.select(*PLACE, F.lit(-1).alias("n"), F.lit(None).cast("double").alias("magnitude"), F.col("magnitude").alias("gone")))
        change = signed.filter(F.col("day").isNotNull()).groupBy(*PLACE).agg(
            F.sum("n").alias("n"), F.max("magnitude").alias("came"), F.max("gone").alias("gone"))
        stored = self.cells._current(but=before).select(*PLACE, "event_count", "max_mag")
        met = change.join(stored, PLACE, "left")
        # the maximum is open where its event left and nothing as large came
        lost = F.coalesce((F.col("gone") >= F.col("max_mag")) & (F.col("came").isNull() | (F.col("came") < F.col("max_mag"))), F.lit(False))
        met = materialise(met.select(
            *PLACE, (F.coalesce("event_count", F.lit(0)) + F.col("n")).alias("event_count"),
            F.greatest("max_mag", "came").alias("max_mag"), lost.alias("lost")), "cell-changes")
        settled = met.filter("NOT lost OR event_count = 0").select(
            *PLACE, "event_count", F.when(F.col("event_count") > 0, F.col("max_mag")).alias("max_mag"))
        open_ = met.filter("lost AND event_count > 0").select(*PLACE, "event_count")
        rest = known.join(new.select(self.key), self.key, "left_anti").unionByName(new.select(self.key, *PLACE, "magnitude"))
        again = rest.join(open_, PLACE).groupBy(*PLACE).agg(F.first("event_count").alias("event_count"), F.max("magnitude").alias("max_mag"))
        after = settled.unionByName(again).withColumn(ORDER, F.lit(batch_id).cast("long"))
        self.cells.upsert(after, batch_id, writer, True)
        self.events.upsert(new, batch_id, writer, True)

    def current(self) -> DataFrame:
        """day, grid_lat, grid_lon, event_count and max_mag of the cells that hold an event."""
        return self.cells.current().filter("event_count > 0")

    def compact(self) -> None:
        """Merge the changes of both collections; to be called when no batch is under way."""
        self.events.compact()
        self.cells.compact()

    def follow(self, versions: DataFrame, checkpoint: str, available_now: bool = True, compact_every: int = 0) -> StreamingQuery:
        """Keep the figures in step with a stream of versions; every ``compact_every`` batches the changes are merged first."""
        writer = writer_of(self.spark, checkpoint)

        def store(batch: DataFrame, batch_id: int) -> None:
            # a batch that is run again may meet state of its own: only what lies further back is merged
            if compact_every and batch_id and batch_id % compact_every == 0 and not self._holds(writer, batch_id):
                self.compact()
            self.apply(batch, batch_id, writer)

        out = versions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        out = out.trigger(availableNow=True) if available_now else out
        return out.start()

    def _holds(self, writer: int, batch_id: int) -> bool:
        """Whether a part of the batch is stored already."""
        found = [c._read("changes") for c in (self.events, self.cells)]
        return any(f is not None and not f.filter(f"_writer = {writer} AND _batch = {batch_id}").isEmpty() for f in found)
