import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from quakeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "quakeloom-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def quake_rows(spark):
    """Build a small earthquake frame from keyword rows; unnamed columns are null."""
    schema = ("event_id STRING, magnitude DOUBLE, place STRING, ts TIMESTAMP_NTZ, latitude DOUBLE, longitude DOUBLE, "
              "depth_km DOUBLE, tsunami INT, alert STRING, significance DOUBLE, anomaly_flag BOOLEAN, tsunami_prob DOUBLE")
    names = [part.split()[0] for part in schema.split(", ")]

    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build


@pytest.fixture
def event_rows(spark):
    schema = "event_id STRING, type STRING, title STRING, latitude DOUBLE, longitude DOUBLE, last_ts TIMESTAMP_NTZ"
    names = [part.split()[0] for part in schema.split(", ")]

    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build
