"""Spatial joins on the grid: box containment and shared cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.numeric import is_known, known

CELL = grid.CELL


def box_memberships(events: DataFrame, size: float = 5.0) -> DataFrame:
    """Each event once per cell centre whose box ``centre ± size`` holds it.

    The box join turns round: an event names the few centres (two or three per
    axis) it can belong to, so no event is ever paired with a cell it misses.
    """
    placed = (
        events.filter(is_known("latitude", "longitude"))
        .withColumn("grid_lat", F.explode(grid.centres_within_reach("latitude", size)))
        .withColumn("grid_lon", F.explode(grid.centres_within_reach("longitude", size)))
    )
    return placed.filter(
        F.col("latitude").between(F.col("grid_lat") - size, F.col("grid_lat") + size)
        & F.col("longitude").between(F.col("grid_lon") - size, F.col("grid_lon") + size)
    )


def nearby_counts(events: DataFrame, size: float = 5.0) -> DataFrame:
    """Per cell centre: events inside the box and their types, newest type first.

    Rows are combined per (cell, type) before the shuffle, so a crowded cell
    travels as a handful of partial counts.
    """
    per_type = box_memberships(events, size).groupBy(*CELL, "type").agg(
        F.count("*").alias("n"), F.max("last_ts").alias("newest"))
    ranked = F.sort_array(
        F.collect_list(F.when(F.col("type").isNotNull(), F.struct("newest", "type", "n"))), asc=False)
    return per_type.groupBy(*CELL).agg(
        F.sum("n").alias("nearby"),
        F.transform(ranked, lambda t: t["type"]).alias("nearby_types"),
    )


def cells_with_nearby(cells: DataFrame, events: DataFrame, size: float = 5.0) -> DataFrame:
    """Cells with the number and types of events in their boxes, 0 when none."""
    return (
        cells.join(nearby_counts(events, size), CELL, "left")
        .withColumn("nearby", F.coalesce("nearby", F.lit(0).cast("long")))
        .withColumn("nearby_types", F.coalesce("nearby_types", F.array().cast("array<string>")))
    )


def hazard_correlation(quakes: DataFrame, events: DataFrame, size: float = 5.0) -> DataFrame:
    """Cells that hold both earthquakes and natural events.

    Both sides shrink to one row per cell before they meet.
    """
    shaken = grid.with_cell(quakes.filter(is_known("latitude", "longitude")), size, grid.LIVE)
    quake_cells = shaken.groupBy(*CELL).agg(
        F.count(known("magnitude")).alias("eq_count"), F.max(known("magnitude")).alias("max_mag"))
    placed = grid.with_cell(events.filter(is_known("latitude", "longitude")), size, grid.LIVE)
    per_type = placed.groupBy(*CELL, "type").agg(F.count("type").alias("n"))
    event_cells = per_type.groupBy(*CELL).agg(
        F.sum("n").alias("eonet_count"),
        F.array_join(F.array_sort(F.collect_list("type")), ", ").alias("event_types"),
    )
    return quake_cells.join(event_cells, CELL, "inner")
