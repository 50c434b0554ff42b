"""Repeatable samples and splits, decided row by row from the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.scoring import magnitude_band
from quakeloom.functions.text import stable_fraction

# Share of each magnitude band that enters training.
BAND_SHARES = {"low": 0.05, "mid": 0.30, "high": 1.0}


def stratified(rows: DataFrame, key: str = "event_id", shares: dict[str, float] | None = None) -> DataFrame:
    """Thin the frequent small events in one pass; strong ones are all kept."""
    shares = shares or BAND_SHARES
    band = magnitude_band()
    keep = F.lit(False)
    for name, share in shares.items():
        keep = F.when(band == name, F.lit(True) if share >= 1.0 else stable_fraction(key) < share).otherwise(keep)
    return rows.filter(keep)


def split(rows: DataFrame, train_share: float = 0.8, key: str = "event_id") -> DataFrame:
    """Add ``part`` (train or test); salted so it does not follow the sample."""
    fraction = stable_fraction(F.concat(F.lit("split:"), F.col(key)))
    return rows.withColumn("part", F.when(fraction < train_share, "train").otherwise("test"))


def dataset_counts(rows: DataFrame) -> DataFrame:
    """Rows per magnitude band and part."""
    return rows.groupBy(magnitude_band().alias("band"), "part").agg(F.count("*").alias("count")).orderBy("band", "part")
