"""Scratch space and session settings."""

import os

from pyspark.sql import functions as F

from quakeloom.session import materialise, prepare, scratch_path, shared_root


def test_scratch_lies_in_the_shared_folder(spark):
    root = shared_root(spark)
    path = scratch_path(spark, "t")
    assert path.startswith(root) and path != scratch_path(spark, "t")
    assert os.path.isdir(path.removeprefix("file:"))


def test_materialised_rows_are_equal_and_planned_by_size(spark):
    df = spark.range(10).select("id", F.lit(None).cast("string").alias("s"))
    again = materialise(df, "m")
    assert again.schema.simpleString() == df.schema.simpleString()
    assert sorted(again.collect()) == sorted(df.collect())
    assert "Scan parquet" in again._jdf.queryExecution().executedPlan().toString().replace("FileScan", "Scan")


def test_prepare_sets_what_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    prepare(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "TIMESTAMP_MICROS"
