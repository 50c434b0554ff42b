"""Batch operators on small frames with planted edge cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.scoring import with_risk
from quakeloom.operators import anomaly, baseline, proximity, regional, reports, rows, sampling, seasonal
from quakeloom.sources import adapters, stats

SF = "/root/testdata/sf0.001"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def cluster(n, lat, lon, mag=4.0, prefix="q", **extra):
    return [dict(event_id=f"{prefix}{i}", magnitude=mag, place=f"p{i}, R", ts=day(i % 20), latitude=lat, longitude=lon, **extra)
            for i in range(n)]


@pytest.fixture
def busy(quake_rows):
    """One crowded cell among ten quiet ones."""
    quiet = [r for k in range(10) for r in cluster(2, -60.0 + 10 * k, 20.0, prefix=f"s{k}-")]
    return quake_rows(*cluster(60, 36.0, 140.0), *quiet)


def test_cell_statistics_of_single_event_cells(quake_rows):
    cells = baseline.cell_stats(quake_rows(
        *cluster(1, 10.0, 10.0, 4.0), *cluster(2, 30.0, 30.0, 5.0, prefix="r"),
        dict(event_id="n", magnitude=None, latitude=10.0, longitude=10.0),
        dict(event_id="x", magnitude=float("nan"), latitude=10.0, longitude=10.0),
        dict(event_id="y", magnitude=5.0, latitude=None, longitude=10.0)))
    got = {(r.grid_lat, r.grid_lon): (r.event_count, r.avg_mag, r.std_mag) for r in cells.collect()}
    assert got == {(10.0, 10.0): (1, 4.0, 0.0), (30.0, 30.0): (2, 5.0, 0.0)}


def test_thresholds_of_one_day_history(quake_rows):
    r = baseline.thresholds(baseline.cell_stats(quake_rows(*[
        dict(event_id=str(i), magnitude=3.0, ts=day(0), latitude=float(5 * i), longitude=0.0) for i in range(3)]))).first()
    assert (r.global_mean_count, r.global_std_count, r.historical_span_days, r.total_cells) == (1.0, 0.0, 1, 3)


def test_box_join_equals_the_plain_range_join(spark, event_rows):
    rng = random.Random(11)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(float(a), float(b)) for a in (-5, 0, 2.5, 5, 7.5, 10) for b in (-10, -5, 0, 12.5, 15)]
    events = event_rows(*[dict(event_id=str(i), type="t", latitude=a, longitude=b, last_ts=day(0)) for i, (a, b) in enumerate(points)])
    cells = spark.createDataFrame(
        [(float(a), float(b)) for a in range(-90, 95, 5) for b in range(-180, 185, 5)], "grid_lat DOUBLE, grid_lon DOUBLE")
    naive = cells.join(
        events, F.col("latitude").between(F.col("grid_lat") - 5, F.col("grid_lat") + 5)
        & F.col("longitude").between(F.col("grid_lon") - 5, F.col("grid_lon") + 5))
    pairs = lambda df: sorted(tuple(r) for r in df.select("grid_lat", "grid_lon", "event_id").collect())
    assert pairs(proximity.box_memberships(events)) == pairs(naive)


def test_threshold_anomaly_with_and_without_events(busy, event_rows):
    near = event_rows(
        dict(event_id="a", type="storm", latitude=40.0, longitude=145.0, last_ts=day(2)),
        dict(event_id="b", type="wildfire", latitude=36.0, longitude=139.0, last_ts=day(5)),
        dict(event_id="c", type="flood", latitude=41.0, longitude=140.0, last_ts=day(6)))
    found = anomaly.anomalies_from_history(busy.drop("anomaly_flag"), near).collect()
    assert [(r.lat, r.lon, r.eq_count, r.eonet_count, r.severity, r.multi_type) for r in found] == [
        (35.0, 140.0, 60, 2, "HIGH", True)]
    assert found[0].description == (
        "60 earthquakes (max M4.0) near p59, R + 2 wildfire, storm event(s) — MULTI-TYPE CLUSTER")
    alone = anomaly.anomalies_from_history(busy, event_rows()).first()
    assert (alone.severity, alone.multi_type, alone.description) == (
        "MODERATE", False, "60 earthquakes (max M4.0) near p59, R")


def test_place_of_the_newest_event_may_be_missing(quake_rows, event_rows):
    rows_ = cluster(50, 36.0, 140.0) + [dict(event_id="z", magnitude=4.2, place=None, ts=day(30), latitude=36.0, longitude=140.0)]
    quiet = [r for k in range(10) for r in cluster(1, -60.0 + 10 * k, 20.0, prefix=f"s{k}-")]
    found = anomaly.anomalies_from_history(quake_rows(*rows_, *quiet), event_rows()).first()
    assert found.description == "51 earthquakes (max M4.2) near None"


def test_flagged_events_take_over_only_when_there_are_any(busy, event_rows):
    plain = anomaly.detect(busy, event_rows())
    assert plain.first().description.startswith("60 earthquakes")
    flagged = busy.withColumn("anomaly_flag", F.col("latitude") == -60.0)
    got = anomaly.detect(flagged, event_rows()).collect()
    assert [(r.lat, r.eq_count, r.severity, r.eonet_count) for r in got] == [(-60.0, 2, "MODERATE", 0)]
    assert got[0].description.startswith("2 flagged events (max M4.0) near p1")


def test_live_filter_counts_only_live_rows_against_the_whole_history(busy, event_rows):
    live = F.col("ts") >= F.lit(day(4))
    assert anomaly.anomalies_from_history(busy, event_rows(), live).first().eq_count == 48


def test_empty_frames_give_empty_reports(quake_rows, event_rows):
    none = quake_rows()
    assert anomaly.detect(none, event_rows()).count() == 0
    assert regional.regional_risk(with_risk(none)).count() == 0
    r = reports.key_figures(with_risk(none), event_rows(), none).first()
    assert tuple(r) == (0.0, 0.0, 0, 0, 0, 0, 0, 0)


def test_default_thresholds_without_saved_statistics(spark, busy, folder, event_rows):
    schema = baseline.thresholds(baseline.cell_stats(busy)).schema
    saved = stats.thresholds_or_default(spark, f"{folder}/none", schema)
    assert saved.first().threshold_moderate == 40.0
    assert anomaly.detect(busy.drop("anomaly_flag"), event_rows(), saved).first().eq_count == 60


def test_headline_prefers_several_hazards(spark):
    rows_ = spark.createDataFrame([("a", False, 8.0, 0.0, 0.0), ("b", True, 6.0, 0.0, 0.0)],
                                  "description STRING, multi_type BOOLEAN, max_mag DOUBLE, lat DOUBLE, lon DOUBLE")
    assert anomaly.headline(rows_).first().description == "b"


def test_rate_spike_of_a_new_cell_uses_the_global_rate(quake_rows):
    history = quake_rows(*[dict(event_id=str(i), magnitude=3.0, ts=day(i), latitude=0.0, longitude=0.0) for i in range(30)])
    cells, totals = baseline.fit_baseline(history)
    recent = quake_rows(*cluster(10, 50.0, 50.0), *cluster(2, 0.0, 0.0, prefix="o"))
    got = baseline.rate_spikes(recent, cells, totals, 2).collect()
    assert [(r.grid_lat, r.window_count, r.window_rate, r.baseline_rate) for r in got] == [(50.0, 10, 5.0, 1.034483)]


@pytest.mark.parametrize("mags, n, profile", [
    ([6.0], 1, "Critical Seismic Zone"), ([4.5, 4.5], 2, "High Seismic Activity"),
    ([3.0] * 10, 10, "Frequent Activity"), ([3.0] * 9, 9, "Low Activity"), ([4.494, 4.497], 2, "High Seismic Activity")])
def test_region_profiles(quake_rows, mags, n, profile):
    df = quake_rows(*[dict(event_id=str(i), magnitude=m, place="x, R", latitude=1.0, longitude=1.0) for i, m in enumerate(mags)])
    r = regional.regional_risk(with_risk(df)).first()
    assert (r.region, r.eq_count, r.profile) == ("R", n, profile)


def test_regions_without_coordinates_count_only_as_activity(quake_rows):
    df = quake_rows(dict(event_id="1", magnitude=5.0, place="x, R"))
    assert regional.regional_risk(with_risk(df)).count() == 0
    assert regional.most_active(df).first()["count"] == 1


def test_missing_state_and_type_are_groups(spark):
    df = spark.createDataFrame([("TX", "Fire"), ("TX", None), ("TX", "Fire"), (None, "Flood")], "state STRING, incident_type STRING")
    got = {r.state: (r["count"], r.types) for r in reports.declarations_by_state(df).collect()}
    assert got["TX"][0] == 3 and sorted(got["TX"][1], key=str) == ["Fire", None]
    assert got[None] == (1, ["Flood"])


def test_histogram_keeps_negative_and_top_values(spark):
    df = spark.createDataFrame([(-10.0,), (0.0,), (99.9,), (100.0,), (None,), (float("nan"),)], "x DOUBLE")
    got = {r.lower: r["count"] for r in reports.histogram(df, "x", 2.5, 100.0).collect()}
    assert got == {-10.0: 1, 0.0: 1, 97.5: 2}


def test_forecast_uses_fixed_draws(spark):
    trend = spark.createDataFrame([(dt.date(2024, 1, d), 1, 4.0 + d / 10) for d in range(1, 10)], "date DATE, count INT, avg_mag DOUBLE")
    got = seasonal.trend_forecast(trend).collect()
    assert len(got) == 14 and str(got[0].date) == "2024-01-10" and str(got[-1].date) == "2024-01-23"
    sigma = 0.5 * (sum((k - 3) ** 2 for k in range(7)) / 6) ** 0.5 / 10
    assert got[0].value == pytest.approx(4.6 + 0.4967141530112327 * sigma)
    assert got[0].upper - got[0].value == pytest.approx(1.96 * sigma)


def test_recent_window_without_events_gives_zero(spark, quake_rows):
    counts = seasonal.calendar_counts(quake_rows(*cluster(5, 0.0, 0.0)), "2030-01-01")
    r = seasonal.rates(counts).first()
    assert (r.recent_daily_rate, r.recent_avg_magnitude, r.total_events, r.total_days) == (0.0, None, 5, 4)


def test_unseen_keeps_the_first_arrival(spark):
    seen = spark.createDataFrame([("a",)], "event_id STRING")
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5)], "event_id STRING, arrival INT")
    assert [tuple(r) for r in rows.unseen(incoming, seen, ["event_id"], "arrival").collect()] == [("b", 2)]


def test_type_filter_and_missing_columns(spark, event_rows):
    events = event_rows(dict(event_id="1", type="storm", last_ts=day(1)), dict(event_id="2", type="flood", last_ts=day(2)))
    assert [r.event_id for r in reports.recent_events(events, 5, ["storm"]).collect()] == ["1"]
    assert [r.event_id for r in reports.recent_events(events, 5, []).collect()] == ["2", "1"]
    assert rows.existing(events, ["title", "nothing", "type"]).columns == ["title", "type"]


def test_sample_is_stable_and_fair(spark):
    quakes = adapters.quakes(spark, "/root/testdata/sf0.01").filter("magnitude IS NOT NULL")
    ids = lambda df: sorted(r.event_id for r in sampling.stratified(df).select("event_id").collect())
    first = ids(quakes)
    assert first == ids(quakes.repartition(13))
    low = quakes.filter("magnitude < 4").count()
    kept = sampling.stratified(quakes.filter("magnitude < 4")).count()
    assert abs(kept - 0.05 * low) < 3 * (low * 0.05 * 0.95) ** 0.5
    assert sampling.stratified(quakes.filter("magnitude >= 5")).count() == quakes.filter("magnitude >= 5").count()


def test_hot_key_and_hot_cell_give_whole_results(spark):
    quakes = adapters.quakes(spark, SF)
    hot = quakes.crossJoin(spark.range(20)).withColumn("event_id", F.when(F.col("id") < 7, "hot").otherwise(F.concat("event_id", F.lit("-"), "id")))
    newest = rows.latest_per_key(hot, ["event_id"], "ts")
    assert newest.count() == hot.select("event_id").distinct().count()
    assert anomaly.live_cells(hot).agg(F.sum("event_count")).first()[0] == 20 * anomaly.live_cells(quakes).agg(F.sum("event_count")).first()[0]
    assert grid.CELL == ["grid_lat", "grid_lon"]


@pytest.mark.parametrize("values, bins, edges", [
    ([0.5, 1.5, 9.9], 10, [(0.0, 1.0, 1), (1.0, 2.0, 1), (9.0, 10.0, 1)]),
    ([-3.0, 3.0, 3.0], 2, [(-5.0, 0.0, 1), (0.0, 5.0, 2)]),
    ([1e6 + 0.001, 1e6 + 0.004, 1e6 + 0.0095], 10, [(1e6 + 0.001, 1e6 + 0.002, 1), (1e6 + 0.004, 1e6 + 0.005, 1), (1e6 + 0.009, 1e6 + 0.01, 1)]),
    ([1.0, 20.0, 300.0, 4e9], 5, [(0.0, 1e9, 3), (4e9, 5e9, 1)]),
    ([7.25, 7.25], 4, [(7.0, 8.0, 2)]),
    ([None, float("nan"), float("inf")], 4, []),
    ([], 4, []),
])
def test_nice_histogram(spark, values, bins, edges):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    found = [(r.lower, r.upper, r["count"]) for r in reports.nice_histogram(df, "v", bins).collect()]
    assert found == [pytest.approx(e, rel=1e-12) for e in edges]


def test_nice_histogram_needs_two_bins(spark):
    with pytest.raises(ValueError):
        reports.nice_histogram(spark.range(3).selectExpr("id * 1e0 AS v"), "v", 1)
