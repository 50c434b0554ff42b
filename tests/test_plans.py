"""Physical plans: what reaches the scan, which joins and aggregates are chosen."""

import pytest
from pyspark.sql import functions as F

from quakeloom.functions.scoring import with_risk
from quakeloom.operators import anomaly, baseline, proximity, regional, reports, rows, seasonal
from quakeloom.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    with_risk(adapters.quakes(spark, SF)).write.parquet(f"{root}/q")
    adapters.natural_events(spark, SF).write.parquet(f"{root}/e")
    return spark.read.parquet(f"{root}/q"), spark.read.parquet(f"{root}/e")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(reports.high_risk_table(rows.since(stored[0], "ts", "2024-01-10")).select("event_id", "magnitude"))
    assert "GreaterThanOrEqual(magnitude,5.5)" in text and "GreaterThanOrEqual(ts" in text
    assert "latitude" not in text.split("ReadSchema")[1] and "place" not in text.split("ReadSchema")[1]
    assert "TakeOrderedAndProject" in text


def test_magnitude_floor_is_pushed(stored):
    assert "GreaterThanOrEqual(magnitude,2.5)" in plan(reports.recent_quakes(stored[0], 10, 2.5))


@pytest.mark.parametrize("build", [
    lambda q, e: anomaly.live_cells(q), lambda q, e: baseline.cell_stats(q), lambda q, e: anomaly.count_rollup(q),
    lambda q, e: regional.regional_risk(q), lambda q, e: seasonal.calendar_counts(q, "2024-01-31"),
    lambda q, e: seasonal.daily_trend(q, "2024-01-10"), lambda q, e: reports.histogram(q, "risk_score", 2.5, 100.0)])
def test_group_bys_combine_by_hash_with_one_exchange(stored, build):
    text = plan(build(*stored))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_box_join_never_pairs_rows(stored):
    quakes, events = stored
    cells = anomaly.live_cells(quakes)
    text = plan(proximity.cells_with_nearby(cells, events))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "Generate explode" in text


def test_no_python_in_any_operator_plan(stored):
    quakes, events = stored
    for df in (with_risk(quakes), proximity.hazard_correlation(quakes, events), reports.alert_feed(quakes, events),
               reports.map_layer(quakes, events, anomaly.flagged_anomalies(quakes))):
        text = plan(df)
        assert "EvalPython" not in text and "Pandas" not in text


def test_hot_keys_shrink_before_the_shuffle(stored):
    text = plan(rows.latest_per_key(stored[0], ["event_id"], "ts"))
    assert "WindowGroupLimit" in text.split("Exchange")[1]


def scanned_rows(df):
    """Rows that left each file scan of the executed plan."""
    df.collect()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_newest_rows_skip_old_files(spark, stored, tmp_path):
    dated = stored[0].withColumn("ts", F.col("ts").cast("timestamp"))
    dated.repartitionByRange(8, "ts").write.parquet(f"{tmp_path}/by_time")
    quakes = spark.read.parquet(f"{tmp_path}/by_time")
    recent = reports.recent_quakes(quakes, 10)
    assert sum(scanned_rows(recent)) < quakes.count() / 4
    assert [r.event_id for r in recent.collect()] == [
        r.event_id for r in quakes.filter("magnitude >= 0").orderBy(F.desc("ts"), "event_id").limit(10).collect()]


def test_undated_rows_come_last_but_are_kept(quake_rows):
    import datetime as dt

    df = quake_rows(dict(event_id="a", magnitude=1.0), dict(event_id="b", magnitude=1.0, ts=dt.datetime(2024, 1, 1)),
                    dict(event_id="c", magnitude=1.0))
    assert [r.event_id for r in reports.recent_quakes(df, 2).collect()] == ["b", "a"]
    assert [r.event_id for r in reports.recent_quakes(df.filter("ts IS NULL"), 5).collect()] == ["a", "c"]


def test_calendar_reads_two_columns(stored):
    schema = plan(seasonal.calendar_counts(stored[0], "2024-01-31")).split("ReadSchema: ")[1]
    assert schema.split(">")[0].count(":") == 2


def test_scoring_is_one_generated_stage(stored):
    operators = plan(with_risk(stored[0]).select("event_id", "risk_score", "risk_tier")).strip().split("FileScan")[0]
    assert operators.count("*(1)") == operators.count("\n") and "*(2)" not in operators
