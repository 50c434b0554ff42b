"""Unusual clusters: cells above the trained threshold, or flagged events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.numeric import known
from quakeloom.functions.text import one_decimal, shown
from quakeloom.operators import baseline
from quakeloom.operators.proximity import cells_with_nearby
from quakeloom.operators.rows import not_before
from quakeloom.session import materialise

CELL = grid.CELL
SIZE = 5.0
REPORT = ["severity", "description", "lat", "lon", "eq_count", "eonet_count", "multi_type", "max_mag"]


def live_cells(quakes: DataFrame, size: float = SIZE) -> DataFrame:
    """Per live cell: events with a magnitude, largest magnitude, newest moment.

    Only fixed-width buffers, so this stays a hash aggregate; place names are
    looked up afterwards, for the few cells a report shows.
    """
    rows = grid.with_cell(baseline.located(quakes), size, grid.LIVE)
    return rows.groupBy(*CELL).agg(
        F.count(known("magnitude")).alias("event_count"),
        F.max(known("magnitude")).alias("max_mag"),
        F.max("ts").alias("newest"),
    )


def newest_places(quakes: DataFrame, cells: DataFrame, size: float = SIZE) -> DataFrame:
    """Place of the newest event of each given cell (``event_id`` breaks ties).

    Give it cells that are written down: their file size lets the planner ship
    them to the events instead of shuffling the events.
    """
    recent = not_before(baseline.located(quakes), "ts", cells.agg(F.min("newest")))
    rows = grid.with_cell(recent, size, grid.LIVE).select(*CELL, "ts", "event_id", "place")
    wanted = cells.select(*[F.col(c).alias(f"_{c}") for c in CELL], "newest")
    same_cell = (F.col("grid_lat") == F.col("_grid_lat")) & (F.col("grid_lon") == F.col("_grid_lon"))
    at_newest = rows.join(wanted, same_cell & F.col("ts").eqNullSafe(F.col("newest")), "inner")
    return at_newest.groupBy(*CELL).agg(
        F.max_by(shown("place"), F.col("event_id")).alias("top_place"))


def count_rollup(quakes: DataFrame, size: float = SIZE, live: Column | None = None) -> DataFrame:
    """History counts and live cell figures of one scan.

    Keyed by the batch cell and the live cell together (they differ only on
    half-cell ties), so both layers are sums over this grid-sized table.
    """
    live = F.lit(True) if live is None else live
    magnitude = known("magnitude")
    rows = (
        baseline.located(quakes)
        .withColumn("base_lat", grid.cell_centre("latitude", size, grid.BATCH))
        .withColumn("base_lon", grid.cell_centre("longitude", size, grid.BATCH))
    )
    return grid.with_cell(rows, size, grid.LIVE).groupBy("base_lat", "base_lon", *CELL).agg(
        F.count(magnitude).alias("history_count"),
        F.min(F.when(magnitude.isNotNull(), F.col("ts"))).alias("first_ts"),
        F.max(F.when(magnitude.isNotNull(), F.col("ts"))).alias("last_ts"),
        F.count(F.when(live, magnitude)).alias("event_count"),
        F.max(F.when(live, magnitude)).alias("max_mag"),
        F.max(F.when(live, F.col("ts"))).alias("newest"),
    )


def rollup_thresholds(rollup: DataFrame) -> DataFrame:
    cells = rollup.groupBy("base_lat", "base_lon").agg(
        F.sum("history_count").alias("event_count"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )
    return baseline.thresholds(cells.filter("event_count > 0"))


def rollup_live_cells(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(*CELL).agg(
        F.sum("event_count").alias("event_count"),
        F.max("max_mag").alias("max_mag"),
        F.max("newest").alias("newest"),
    )


def over_threshold(cells: DataFrame, stats: DataFrame, default: float = 40.0) -> DataFrame:
    """Cells whose count is strictly above the moderate threshold."""
    limit = stats.agg(F.coalesce(F.max("threshold_moderate"), F.lit(default)))
    return cells.filter(F.col("event_count") > limit.scalar())


def threshold_anomalies(quakes: DataFrame, events: DataFrame, crowded: DataFrame, size: float = SIZE) -> DataFrame:
    """Crowded cells, with the natural events around them and a readable text."""
    found = cells_with_nearby(crowded, events, size).join(newest_places(quakes, crowded, size), CELL, "left")
    near = F.col("nearby") > 0
    quake_text = F.concat(
        F.col("event_count").cast("string"), F.lit(" earthquakes (max M"), one_decimal("max_mag"),
        F.lit(") near "), F.coalesce("top_place", F.lit("Unknown")))
    event_text = F.concat(
        F.lit(" + "), F.col("nearby").cast("string"), F.lit(" "), F.array_join("nearby_types", ", "),
        F.lit(" event(s) — MULTI-TYPE CLUSTER"))
    return found.select(
        F.when((F.col("max_mag") >= 6) | near, "HIGH").otherwise("MODERATE").alias("severity"),
        F.concat(quake_text, F.when(near, event_text).otherwise("")).alias("description"),
        F.col("grid_lat").alias("lat"), F.col("grid_lon").alias("lon"),
        F.col("event_count").alias("eq_count"), F.col("nearby").alias("eonet_count"),
        near.alias("multi_type"), "max_mag",
    ).orderBy(F.desc("max_mag"), "lat", "lon")


def anomalies_from_history(quakes: DataFrame, events: DataFrame, live: Column | None = None,
                           size: float = SIZE) -> DataFrame:
    """Train the threshold and apply it to the live rows, one scan for both."""
    rollup = materialise(count_rollup(quakes, size, live), "rollup")
    recent = quakes if live is None else quakes.filter(live)
    crowded = materialise(over_threshold(rollup_live_cells(rollup), rollup_thresholds(rollup)), "crowded")
    return threshold_anomalies(recent, events, crowded, size)


def flagged_rows(quakes: DataFrame) -> DataFrame:
    return baseline.located(quakes).filter(F.col("anomaly_flag"))


def flagged_anomalies(quakes: DataFrame, size: float = SIZE) -> DataFrame:
    """Cells of events that carry an anomaly flag."""
    flagged = flagged_rows(quakes)
    cells = grid.with_cell(flagged, size, grid.LIVE).groupBy(*CELL).agg(
        F.count("*").alias("event_count"), F.max(known("magnitude")).alias("max_mag"),
        F.max("ts").alias("newest"))
    cells = materialise(cells, "flagged")
    found = cells.join(newest_places(flagged, cells, size), CELL, "left")
    text = F.concat(
        F.col("event_count").cast("string"), F.lit(" flagged events (max M"), one_decimal("max_mag"),
        F.lit(") near "), F.coalesce("top_place", F.lit("Unknown")))
    return found.select(
        F.when(F.col("max_mag") >= 6, "HIGH").otherwise("MODERATE").alias("severity"),
        text.alias("description"),
        F.col("grid_lat").alias("lat"), F.col("grid_lon").alias("lon"),
        F.col("event_count").alias("eq_count"), F.lit(0).cast("long").alias("eonet_count"),
        F.lit(False).alias("multi_type"), "max_mag",
    ).orderBy(F.desc("max_mag"), "lat", "lon")


def detect(quakes: DataFrame, events: DataFrame, stats: DataFrame | None = None, size: float = SIZE) -> DataFrame:
    """Flagged events win over the threshold rule when there are any. ``stats``
    are saved thresholds; without them the frame is its own history.

    The probe reads one column and stops at the first hit, so only one of the
    two plans runs over the data.
    """
    if "anomaly_flag" in quakes.columns and not flagged_rows(quakes).isEmpty():
        return flagged_anomalies(quakes, size)
    if stats is None:
        return anomalies_from_history(quakes, events, size=size)
    crowded = materialise(over_threshold(live_cells(quakes, size), stats), "crowded")
    return threshold_anomalies(quakes, events, crowded, size)


def headline(anomalies: DataFrame) -> DataFrame:
    """The anomaly for the banner: the first multi-type one, else the first."""
    return anomalies.orderBy(F.desc("multi_type"), F.desc("max_mag"), "lat", "lon").limit(1)
