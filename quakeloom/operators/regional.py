"""Profiles of the regions named at the end of each place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.numeric import known, scaled_half_even, settled
from quakeloom.functions.text import region_of
from quakeloom.operators.baseline import located
from quakeloom.operators.rows import top


def regional_risk(quakes: DataFrame) -> DataFrame:
    """Count, magnitudes, mean score and profile per region, riskiest first.

    Rows without coordinates are left out; the profile sees the rounded mean.
    """
    magnitude = known("magnitude")
    measures = [
        F.count(magnitude).alias("eq_count"),
        scaled_half_even(settled(F.avg(magnitude)), 2).alias("avg_mag"),
        F.max(magnitude).alias("max_mag"),
    ]
    scored = "risk_score" in quakes.columns
    if scored:
        measures.append(scaled_half_even(settled(F.avg("risk_score")), 1).alias("avg_risk"))
    place = region_of() if "place" in quakes.columns else F.lit("Unknown")
    profile = (
        F.when(F.col("max_mag") >= 6.0, "Critical Seismic Zone")
        .when(F.col("avg_mag") >= 4.5, "High Seismic Activity")
        .when(F.col("eq_count") >= 10, "Frequent Activity")
        .otherwise("Low Activity")
    )
    grouped = located(quakes).groupBy(place.alias("region")).agg(*measures).withColumn("profile", profile)
    return grouped.orderBy(F.desc("avg_risk" if scored else "max_mag"), "region")


def leaderboard(quakes: DataFrame, n: int = 20) -> DataFrame:
    return regional_risk(quakes).limit(n)


def most_active(quakes: DataFrame, n: int = 15) -> DataFrame:
    """Regions by number of events; rows without coordinates count here."""
    magnitude = known("magnitude")
    grouped = quakes.groupBy(region_of().alias("region")).agg(
        F.count(magnitude).alias("count"), scaled_half_even(settled(F.avg(magnitude)), 2).alias("avg_mag"))
    return top(grouped, n, F.desc("count"), F.asc("region"))
