"""All report tables for one choice of filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.operators import anomaly, proximity, regional, reports, rows, seasonal
from quakeloom.plans import training
from quakeloom.session import materialise


@dataclass(frozen=True)
class Filters:
    """What the viewer chose; the row numbers are limits of the two list tables
    and of nothing else. No types named means all."""

    min_magnitude: float = 2.5
    quakes: int = 300
    events: int = 200
    types: Sequence[str] | None = None
    trend_days: int = 30


def report_tables(quakes: DataFrame, events: DataFrame, declarations: DataFrame, trained: str, as_of: str,
                  filters: Filters = Filters()) -> dict[str, DataFrame]:
    """Report tables by name from the stored collections and the trained statistics.

    The filtered rows are picked once and written down, so the many small tables
    below never return to the collections; trend and states read them whole.
    """
    spark = quakes.sparkSession
    shown = materialise(rows.at_least(quakes, "magnitude", filters.min_magnitude), "shown-quakes")
    active = materialise(rows.of_types(events, filters.types), "shown-events")
    states = materialise(reports.declarations_by_state(declarations), "states")
    recent = rows.last_days(quakes, "ts", as_of, filters.trend_days)
    trend = materialise(seasonal.per_day(recent), "trend").orderBy("date")
    found = materialise(anomaly.detect(shown, active, training.load_thresholds(spark, trained)), "anomalies")
    tables = {
        "earthquakes": reports.recent_quakes(shown, filters.quakes, filters.min_magnitude),
        "natural_events": reports.recent_events(active, filters.events),
        "states": states.orderBy(F.desc("count"), F.asc_nulls_last("state")),
        "top_states": rows.top(states, 20, F.desc("count"), F.asc_nulls_last("state")),
        "trend": trend,
        "forecast": seasonal.trend_forecast(trend, training.load_rates(spark, trained)),
        "anomalies": found.orderBy(F.desc("max_mag"), "lat", "lon"),
        "headline": anomaly.headline(found),
        "key_figures": reports.key_figures(shown, active, states),
        "alerts": reports.alert_feed(shown, active),
        "map": reports.map_layer(shown, active, found),
        "regions": regional.regional_risk(shown),
        "leaderboard": regional.leaderboard(shown),
        "active_regions": regional.most_active(shown),
        "depth_scatter": reports.depth_scatter(shown),
        "depth_categories": reports.depth_categories(shown),
        "magnitude_histogram": reports.histogram(shown, "magnitude", 0.5),
        "event_types": reports.value_counts(active, "type"),
        "events_by_month": reports.events_by_month_type(active),
        "correlation": proximity.hazard_correlation(shown, active),
        "high_risk": reports.high_risk_table(shown),
    }
    if "risk_score" in shown.columns:
        tables["risk_histogram"] = reports.histogram(shown, "risk_score", 2.5, 100.0)
        tables["risk_scatter"] = reports.risk_scatter(shown)
        tables["risk_tiers"] = reports.value_counts(shown, "risk_tier", "tier")
    if "tsunami_prob" in shown.columns:
        tables["tsunami"] = reports.tsunami_probabilities(shown)
    counts = training.load_calendar(spark, trained)
    if counts is not None:
        tables["weekdays"] = seasonal.weekdays(counts)
    return tables
