"""The batch job: one training window, four results, all written to a folder."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from quakeloom.functions.numeric import exact_half_even, settled
from quakeloom.ml import regions, risk_forest
from quakeloom.operators import baseline, rows, seasonal
from quakeloom.sources import stats

# The columns any of the four results needs.
COLUMNS = ["event_id", "magnitude", "depth_km", "tsunami", "alert", "significance", "ts", "latitude", "longitude"]


def training_window(quakes: DataFrame, start: str) -> DataFrame:
    """Needed columns from ``start`` on; the date filter goes down to the scan."""
    return rows.existing(rows.since(quakes, "ts", start), COLUMNS)


def train_all(quakes: DataFrame, root: str, start: str, as_of: str) -> None:
    """Forest, anomaly baseline, regional clusters and seasonal patterns.

    Each result is computed from the stored window with its own columns;
    nothing but fitted models and k/cost pairs reaches the driver.
    """
    window = training_window(quakes, start)
    now = F.lit(datetime.now(timezone.utc).isoformat(timespec="seconds"))

    def save(rows_: DataFrame, path: str) -> None:
        """Every record says when it was trained, so that a stale one shows."""
        stats.write_json(rows_.withColumn("trained_at", now), path)

    model, predictions = risk_forest.train(window, f"{root}/risk_forest")
    save(risk_forest.metrics(predictions), f"{root}/risk_forest_metrics")
    save(risk_forest.importances(quakes.sparkSession, model), f"{root}/risk_forest_importances")

    cells, thresholds = baseline.fit_baseline(window)
    save(thresholds, f"{root}/anomaly_thresholds")
    save(cells.withColumn("cell", stats.cell_key()), f"{root}/anomaly_cells")

    fitted = regions.fit(window)
    regions.save(fitted, f"{root}/region_clusters")
    save(fitted.sweep.withColumn("chosen", F.col("k") == fitted.k), f"{root}/region_sweep")
    profiles = regions.cluster_profiles(fitted.assignments())
    means = ["avg_eq_count", "cluster_avg_mag", "cluster_avg_depth"]
    save(
        profiles.withColumns({c: exact_half_even(settled(c), 3) for c in means}), f"{root}/region_profiles")

    counts = seasonal.calendar_counts(window, as_of)
    counts.write.mode("overwrite").parquet(f"{root}/calendar_counts")
    counts = quakes.sparkSession.read.parquet(f"{root}/calendar_counts")
    save(seasonal.patterns(counts), f"{root}/seasonal_patterns")
    save(seasonal.rates(counts), f"{root}/seasonal_rates")


RATES = "daily_event_rate DOUBLE, recent_daily_rate DOUBLE, recent_avg_magnitude DOUBLE, total_events BIGINT, total_days INT"
THRESHOLDS = (
    "global_mean_count DOUBLE, global_std_count DOUBLE, global_daily_rate DOUBLE, spike_multiplier DOUBLE, "
    "threshold_moderate DOUBLE, threshold_high DOUBLE, total_cells BIGINT, historical_span_days INT")
CELLS = (
    "grid_lat DOUBLE, grid_lon DOUBLE, historical_count BIGINT, daily_rate DOUBLE, avg_mag DOUBLE, max_mag DOUBLE, "
    "std_mag DOUBLE, cell STRING")


def load_thresholds(spark: SparkSession, root: str) -> DataFrame:
    """Trained thresholds, or the defaults before the first training."""
    return stats.thresholds_or_default(spark, f"{root}/anomaly_thresholds", THRESHOLDS)


def load_cells(spark: SparkSession, root: str) -> DataFrame | None:
    return stats.read_json(spark, f"{root}/anomaly_cells", CELLS)


def load_calendar(spark: SparkSession, root: str) -> DataFrame | None:
    """Sums per year, month and weekday, from which every pattern follows."""
    try:
        return spark.read.parquet(f"{root}/calendar_counts")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def load_rates(spark: SparkSession, root: str) -> DataFrame | None:
    return stats.read_json(spark, f"{root}/seasonal_rates", RATES)
