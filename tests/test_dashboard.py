"""The report bundle equals the single reports on the same rows."""

import pytest
from pyspark.sql import functions as F

from quakeloom.functions.scoring import with_risk
from quakeloom.operators import anomaly, regional, reports, seasonal
from quakeloom.plans import dashboard, training
from quakeloom.sources import adapters

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bundle(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("trained"))
    quakes = with_risk(adapters.quakes(spark, SF)).drop("anomaly_flag")
    events, declared = adapters.natural_events(spark, SF), adapters.declarations(spark, SF)
    training.train_all(quakes, root, "2024-01-01", "2024-01-31")
    filters = dashboard.Filters(min_magnitude=0.0, quakes=50, events=20, types=("storm", "volcano"))
    return quakes, events, root, dashboard.report_tables(quakes, events, declared, root, "2024-01-31", filters)


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_every_table_has_rows(bundle):
    empty = [name for name, df in bundle[3].items() if df.isEmpty()]
    assert empty == [] and len(bundle[3]) == 26


def test_views_hold_the_filtered_rows(bundle):
    quakes, _, _, tables = bundle
    assert same(tables["earthquakes"], reports.recent_quakes(quakes, 50)) and tables["natural_events"].count() == 20
    assert {r.type for r in tables["event_types"].collect()} == {"storm", "volcano"}


def test_reports_are_those_of_the_view(spark, bundle):
    quakes, events, root, tables = bundle
    shown = quakes.filter("magnitude >= 0")
    active = reports.recent_events(events, None, ["storm", "volcano"])
    assert same(tables["regions"], regional.regional_risk(shown))
    assert same(tables["anomalies"], anomaly.detect(shown, active, training.load_thresholds(spark, root)))
    assert tables["headline"].first().description == tables["anomalies"].first().description
    assert same(tables["trend"], seasonal.daily_trend(quakes, "2024-01-01"))
    figures = tables["key_figures"].first()
    assert (figures.quakes, figures.active_events) == (shown.count(), active.count())
    assert shown.count() > 50 and active.count() > 20  # the lists' limits cut no aggregate


def test_forecast_starts_after_the_last_day(bundle):
    tables = bundle[3]
    last = tables["trend"].agg(F.max("date")).first()[0]
    assert (tables["forecast"].first().date - last).days == 1
    assert [r.day for r in tables["weekdays"].collect()] == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def test_untrained_bundle_uses_defaults(spark, folder):
    quakes = with_risk(adapters.quakes(spark, SF))
    tables = dashboard.report_tables(
        quakes, adapters.natural_events(spark, SF), adapters.declarations(spark, SF), folder, "2024-01-31")
    assert "weekdays" not in tables and tables["forecast"].count() == 14
