"""Wall-clock of all queries; prints one JSON line.

BENCH_SF_DIR  directory of the tables   (default /root/testdata/sf0.1)
BENCH_CPUS    local threads             (default 8)
BENCH_RUNS    runs per query, the fastest counts (default 2: the first one
              also pays for code generation)
Name queries on the command line to time only those.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from quakeloom.operators import anomaly
from quakeloom.plans.catalog import QUERIES
from quakeloom.session import build_session
from quakeloom.sources import adapters

# a query that takes longer than this is not run again
LONG = 6.0


def nearby_naive(spark, sf_dir: str):
    """The contrast to ``nearby_events_range``: every cell paired with every event by a range join."""
    cells = anomaly.live_cells(adapters.quakes(spark, sf_dir)).select("grid_lat", "grid_lon", "event_count")
    events = adapters.natural_events(spark, sf_dir).select("latitude", "longitude", "type")
    near = (F.col("latitude").between(F.col("grid_lat") - 5, F.col("grid_lat") + 5)
            & F.col("longitude").between(F.col("grid_lon") - 5, F.col("grid_lon") + 5))
    return cells.join(events, near, "left").groupBy("grid_lat", "grid_lon", "event_count").agg(
        F.count("type").alias("nearby"), F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("types"))


BENCHED = QUERIES | {"nearby_events_naive": nearby_naive}


def timed(spark, query, sf_dir: str, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        best = min(best, took := time.perf_counter() - start)
        if took > LONG:
            break
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "quakeloom-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
        # call-site capture costs driver time for every expression built
        spark__python__sql__dataFrameDebugging__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    queries = {name: timed(spark, BENCHED[name], sf_dir, runs) for name in sys.argv[1:] or BENCHED}
    records = {"declarations": adapters.declarations(spark, sf_dir).count(), "quakes": adapters.quakes(spark, sf_dir).count()}
    fed = {"upsert_latest": "declarations", "stream_newest_versions": "declarations", "stream_scored": "quakes",
           "stream_natural_events": "quakes", "stream_dead_letters": "quakes", "stream_dedup": "quakes", "stream_daily_cells": "quakes"}
    rates = {name: round(records[source] / queries[name]) for name, source in fed.items() if name in queries}
    spark.stop()
    print(json.dumps({
        "metric": "all queries, total wall-clock", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "rows_per_second": rates, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
