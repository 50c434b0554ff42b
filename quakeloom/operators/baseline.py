"""Per-cell magnitude baselines and the thresholds derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.numeric import exact_half_even, is_known, known, settled
from quakeloom.session import materialise

CELL = grid.CELL
SPIKE_MULTIPLIER = 3.0


def located(quakes: DataFrame) -> DataFrame:
    return quakes.filter(is_known("latitude", "longitude"))


def only(df: DataFrame, column: str) -> Column:
    """The value in a one-row frame, as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def cell_stats(quakes: DataFrame, size: float = 5.0, mode: str = grid.BATCH) -> DataFrame:
    """Count, mean, maximum and sample deviation of magnitude per cell, with the
    cell's time range so that the global span needs no second scan."""
    rows = quakes.filter(is_known("latitude", "longitude", "magnitude"))
    return grid.with_cell(rows, size, mode).groupBy(*CELL).agg(
        F.count("*").alias("event_count"),
        F.avg("magnitude").alias("avg_mag"),
        F.max("magnitude").alias("max_mag"),
        F.coalesce(F.stddev_samp("magnitude"), F.lit(0.0)).alias("std_mag"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def span_days(first: Column, last: Column) -> Column:
    """Calendar days between two moments, at least one."""
    return F.greatest(F.coalesce(F.datediff(last, first), F.lit(1)), F.lit(1))


def thresholds(cells: DataFrame) -> DataFrame:
    """One row: mean and deviation of the cells' counts and the alarm levels."""
    totals = cells.agg(
        F.avg("event_count").alias("mean"),
        F.stddev_samp("event_count").alias("std"),
        F.count("*").alias("total_cells"),
        span_days(F.min("first_ts"), F.max("last_ts")).alias("historical_span_days"),
    )
    return totals.select(
        exact_half_even(settled("mean"), 2).alias("global_mean_count"),
        exact_half_even(settled("std"), 2).alias("global_std_count"),
        exact_half_even(settled(F.col("mean") / F.col("historical_span_days")), 6).alias("global_daily_rate"),
        F.lit(SPIKE_MULTIPLIER).alias("spike_multiplier"),
        exact_half_even(settled(F.col("mean") + 2 * F.col("std")), 2).alias("threshold_moderate"),
        exact_half_even(settled(F.col("mean") + 3 * F.col("std")), 2).alias("threshold_high"),
        "total_cells",
        "historical_span_days",
    )


def cell_baselines(cells: DataFrame, stats: DataFrame) -> DataFrame:
    """Stored per-cell record: rate per day over the whole history and rounded statistics."""
    return cells.withColumn("historical_span_days", only(stats, "historical_span_days")).select(
        *CELL,
        F.col("event_count").alias("historical_count"),
        exact_half_even(F.col("event_count") / F.col("historical_span_days"), 6).alias("daily_rate"),
        exact_half_even(settled("avg_mag"), 3).alias("avg_mag"),
        exact_half_even("max_mag", 2).alias("max_mag"),
        exact_half_even(settled("std_mag"), 3).alias("std_mag"),
    )


def fit_baseline(quakes: DataFrame, size: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """(cell baselines, one-row thresholds) from one scan of the history."""
    cells = materialise(cell_stats(quakes, size), "cells")
    stats = thresholds(cells)
    return cell_baselines(cells, stats), stats


def rate_spikes(
    recent: DataFrame,
    baselines: DataFrame,
    stats: DataFrame,
    window_days: float,
    size: float = 5.0,
) -> DataFrame:
    """Cells whose daily rate in the window exceeds the multiple of their own
    baseline rate; a cell without history is held against the global rate."""
    rows = recent.filter(is_known("latitude", "longitude", "magnitude"))
    counts = grid.with_cell(rows, size, grid.BATCH).groupBy(*CELL).agg(
        F.count("*").alias("window_count"), F.max("magnitude").alias("window_max_mag"))
    base = baselines.select(*CELL, "daily_rate")
    rated = (
        counts.join(base, CELL, "left")
        .withColumn("window_rate", F.col("window_count") / F.lit(float(window_days)))
        .withColumn("baseline_rate", F.coalesce(F.col("daily_rate"), only(stats, "global_daily_rate")))
    )
    return rated.filter(F.col("window_rate") > only(stats, "spike_multiplier") * F.col("baseline_rate")).select(
        *CELL, "window_count", "window_max_mag",
        exact_half_even("window_rate", 6).alias("window_rate"),
        "baseline_rate",
    )


def region_features(quakes: DataFrame, size: float = 10.0, missing_depth: float = 33.0) -> DataFrame:
    """Per 10-degree cell features for clustering."""
    rows = quakes.filter(is_known("latitude", "longitude", "magnitude"))
    rows = rows.withColumn("depth_km", F.coalesce(known("depth_km"), F.lit(missing_depth)))
    return grid.with_cell(rows, size, grid.BATCH).groupBy(*CELL).agg(
        F.count("*").alias("eq_count"),
        F.avg("magnitude").alias("avg_mag"),
        F.max("magnitude").alias("max_mag"),
        F.avg("depth_km").alias("avg_depth"),
        F.coalesce(F.stddev_samp("magnitude"), F.lit(0.0)).alias("mag_variability"),
    )
