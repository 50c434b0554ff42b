"""Rule-based risk score, tiers and severity ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.numeric import as_col, exact_half_even, known

# Fixed values of the scoring rule.
ALERT_BONUS = {"red": 20.0, "orange": 15.0, "yellow": 10.0, "green": 5.0}
TIERS = [(90, "Critical"), (70, "High"), (40, "Moderate")]


def ladder(value: Column, steps: list[tuple[float, str]], default: str) -> Column:
    """First step whose lower bound the value reaches; null and NaN take the default."""
    out = None
    present = known(value.cast("double"))
    for bound, label in steps:
        hit = present >= F.lit(float(bound))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def risk_points(magnitude="magnitude", tsunami="tsunami", alert="alert", depth_km="depth_km") -> Column:
    """Capped magnitude points plus bonuses, at most 100; null without a magnitude."""
    points = F.least(known(magnitude) * 10.0, F.lit(60.0))
    wave = F.when(as_col(tsunami) != 0, 20.0).otherwise(0.0)
    level = as_col(alert)
    bonus = F.lit(0.0)
    for name, extra in ALERT_BONUS.items():
        bonus = F.when(level == name, extra).otherwise(bonus)
    depth = known(depth_km)
    shallow = F.when((depth != 0) & (depth < 70), 5.0).otherwise(0.0)
    return F.when(known(magnitude).isNotNull(), F.least(points + wave + bonus + shallow, F.lit(100.0)))


def risk_tier(score: Column | str = "risk_score") -> Column:
    return ladder(as_col(score), TIERS, "Low")


def with_risk(df: DataFrame) -> DataFrame:
    """Add ``risk_score`` (two digits, 0 without a magnitude) and ``risk_tier``."""
    return (
        df.withColumn("_points", risk_points())
        .withColumn("risk_score", F.coalesce(exact_half_even("_points", 2), F.lit(0.0)))
        .withColumn("risk_tier", risk_tier())
        .drop("_points")
    )


def severity_band(magnitude: Column | str = "magnitude", orange_from: float = 4.0) -> Column:
    """red from 6, orange from ``orange_from`` (4 on maps, 5 in alerts), else yellow."""
    return ladder(as_col(magnitude), [(6.0, "red"), (orange_from, "orange")], "yellow")


def depth_category(depth_km: Column | str = "depth_km") -> Column:
    """Right-closed depth classes; null outside (0, 9999]."""
    d = known(depth_km)
    return (
        F.when((d > 0) & (d <= 70), "Shallow (<70 km)")
        .when((d > 70) & (d <= 300), "Intermediate (70-300 km)")
        .when((d > 300) & (d <= 9999), "Deep (>300 km)")
    )


def magnitude_band(magnitude: Column | str = "magnitude") -> Column:
    """Sampling stratum: low below 4, mid below 5, high from 5."""
    m = known(magnitude)
    return F.when(m < 4.0, "low").when(m < 5.0, "mid").when(m >= 5.0, "high")


def geo_point(longitude: Column | str = "longitude", latitude: Column | str = "latitude") -> Column:
    """GeoJSON point, null unless both coordinates are known."""
    lon, lat = known(longitude), known(latitude)
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return F.when(lon.isNotNull() & lat.isNotNull(), point)
