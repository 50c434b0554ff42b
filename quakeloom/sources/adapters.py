"""Hazard tables derived from the generic test tables.

Each text runs unchanged in Spark and in the SQL oracle, so both sides start
from the same rows. Literals such as ``2e0`` keep the arithmetic in DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUAKES = """
WITH b AS (SELECT *, CAST(substr(props, 7, length(props) - 7) AS INT) AS k, user_id % 12 AS z,
                  event_type = 'error' AND user_id < 60 AS hot,
                  event_type = 'purchase' AND user_id % 12 < 2 AS warm,
                  event_type = 'signup' AND user_id < 20 AND CAST(ts AS DATE) >= DATE '2024-01-29' AS burst FROM events),
m AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 400 = 1 THEN 2.5e0
                     WHEN z = 5 THEN 4.3e0 + (event_id % 10) / 10e0
                     ELSE 2e0 + (event_id * 37 % (10 + z * 4)) / 10e0 + CASE WHEN k >= 97 THEN 1e0 ELSE 0e0 END END AS magnitude FROM b)
SELECT CAST(event_id AS STRING) AS event_id, magnitude,
  CASE WHEN k = 99 THEN NULL WHEN event_id % 400 = 1 THEN concat('Islet ', CAST(event_id % 7 AS STRING))
       WHEN k = 98 THEN 'off the coast,'
       ELSE concat(CAST(k AS STRING), ' km S of Town ', CAST(user_id % 20 AS STRING), ', Region ', CAST(z AS STRING)) END AS place,
  ts,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN hot THEN 36e0 + (event_id % 20) / 10e0 WHEN warm THEN -30e0 WHEN burst THEN 50e0
       ELSE (user_id * 25 % 1700) / 10e0 - 85e0 END AS latitude,
  CASE WHEN hot THEN 140e0 WHEN warm THEN -70e0 WHEN burst THEN 10e0 ELSE (user_id * 75 % 3500) / 10e0 - 175e0 END AS longitude,
  CASE WHEN k % 17 = 16 THEN NULL WHEN k = 5 THEN -1e0 ELSE k * 7e0 END AS depth_km,
  CASE WHEN k % 23 = 22 THEN NULL WHEN k % 10 = 0 THEN 1 ELSE 0 END AS tsunami,
  CASE k % 7 WHEN 0 THEN 'red' WHEN 1 THEN 'orange' WHEN 2 THEN 'yellow' WHEN 3 THEN 'green' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'RED' END AS alert,
  CASE WHEN k % 13 = 12 THEN NULL WHEN k = 7 THEN -5e0 ELSE magnitude * magnitude * 20e0 + value END AS significance,
  CASE WHEN k % 19 = 18 THEN NULL ELSE k % 31 = 0 END AS anomaly_flag,
  CASE WHEN k % 11 = 10 THEN NULL ELSE (k % 40) / 100e0 END AS tsunami_prob
FROM m
"""

NATURAL_EVENTS = """
SELECT concat('EONET_', CAST(event_id AS STRING)) AS event_id,
  CASE WHEN event_type IN ('view', 'purchase') THEN 'wildfire' WHEN event_type = 'signup' THEN 'storm' ELSE 'volcano' END AS type,
  concat('Event ', CAST(event_id AS STRING)) AS title,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN user_id < 10 THEN 30e0 + (event_id % 11) ELSE (user_id * 25 % 1700) / 10e0 - 85e0 END AS latitude,
  CASE WHEN user_id < 10 THEN 139e0 ELSE (user_id * 75 % 3500) / 10e0 - 175e0 END AS longitude,
  ts AS last_ts
FROM events
"""

DECLARATIONS = """
SELECT CAST(o_orderkey % 500 AS STRING) AS event_id, CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE n_name END AS state,
  concat('County ', CAST(c_custkey % 40 AS STRING)) AS county, o_orderpriority AS incident_type, o_orderdate AS declaration_ts, o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

ARCHIVE = """
SELECT CAST(o_orderkey AS STRING) AS event_id, 2.5e0 + (o_orderkey % 60) / 10e0 AS magnitude, o_orderdate AS ts,
  (o_custkey * 25 % 1700) / 10e0 - 85e0 AS latitude, (o_custkey * 75 % 3500) / 10e0 - 175e0 AS longitude,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey % 600) * 1e0 END AS depth_km FROM orders
"""


def _view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **frames)


def quakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, QUAKES, "events")


def natural_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, NATURAL_EVENTS, "events")


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, DECLARATIONS, "orders", "customer", "nation")


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, ARCHIVE, "orders")
