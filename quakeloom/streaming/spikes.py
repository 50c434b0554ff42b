"""Rate spikes on a stream: sliding windows held against the saved baseline rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.numeric import exact_half_even, is_known

DAY = 86400.0


def rate_alerts(quakes: DataFrame, baselines: DataFrame, stats: DataFrame, window: str, slide: str, delay: str,
                size: float = 5.0) -> DataFrame:
    """Cells whose daily rate in a sliding window exceeds the multiple of their own baseline rate.

    ``baselines`` has one row a cell and ``stats`` one row in all (see :func:`baseline.fit_baseline`); a
    cell without history is held against the global rate. A window is judged, and its alerts are
    emitted, once: when the watermark (the latest ``ts`` less ``delay``) passes its end. Events that
    come within the delay count; later ones are dropped. State is one row for each open window and
    cell, and the static side meets those rows, never the events.
    """
    limits = stats.select("global_daily_rate", "spike_multiplier").first()
    rows = quakes.filter(is_known("latitude", "longitude", "magnitude") & F.col("ts").isNotNull()).withWatermark("ts", delay)
    counts = grid.with_cell(rows, size, grid.BATCH).groupBy(F.window("ts", window, slide).alias("w"), *grid.CELL).agg(
        F.count("*").alias("window_count"), F.max("magnitude").alias("window_max_mag"))
    days = (F.unix_micros("w.end") - F.unix_micros("w.start")) / F.lit(1e6 * DAY)
    rated = counts.join(baselines.select(*grid.CELL, "daily_rate"), grid.CELL, "left").withColumns({
        "window_rate": F.col("window_count") / days,
        "baseline_rate": F.coalesce("daily_rate", F.lit(limits["global_daily_rate"])),
    })
    spikes = rated.filter(F.col("window_rate") > F.lit(limits["spike_multiplier"]) * F.col("baseline_rate"))
    return spikes.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *grid.CELL, "window_count", "window_max_mag",
        exact_half_even("window_rate", 6).alias("window_rate"), "baseline_rate")


def emit(alerts: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Write every alert once to Parquet files, restarts included."""
    out = alerts.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if available_now else out).start()
