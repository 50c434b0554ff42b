"""Statistics as JSON: one line per record, so no table gathers in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

# Fixed values used until a baseline has been trained.
DEFAULT_THRESHOLDS = {
    "global_mean_count": 10.0,
    "global_std_count": 15.0,
    "threshold_moderate": 40.0,
    "threshold_high": 55.0,
}


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The saved records, or None when nothing has been saved there."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def thresholds_or_default(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Saved thresholds, else one row of defaults."""
    saved = read_json(spark, path, schema)
    if saved is not None:
        return saved
    empty = spark.createDataFrame([], schema)
    return empty.agg(*[
        F.coalesce(F.max(f.name), F.lit(DEFAULT_THRESHOLDS.get(f.name)).cast(f.dataType)).alias(f.name)
        for f in empty.schema.fields])


def cell_key(lat: str = "grid_lat", lon: str = "grid_lon"):
    """Text key of a cell, as used in exported statistics."""
    return F.concat_ws(",", F.col(lat).cast("string"), F.col(lon).cast("string"))
