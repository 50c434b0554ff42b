"""Rounding, cells, scoring and text rules against hand-made tables."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from quakeloom.functions import grid, numeric, scoring, text


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_exact_rounding_equals_the_language_rule(spark):
    rng = random.Random(7)
    values = [2.675, 1.005, 1.115, 0.125, -0.125, 2.5, 100.0, 0.0, 40.125, 41.235]
    values += [k / 1000 for k in range(-3000, 3000, 5)]
    values += [rng.uniform(-1000, 1000) for _ in range(4000)]
    values += [round(rng.uniform(0, 100), 3) for _ in range(4000)]
    df = column(spark, values)
    for digits in (1, 2, 3, 6):
        got = results(df, numeric.exact_half_even("x", digits))
        assert got == [round(v, digits) + 0.0 for v in values]


def test_half_up_goes_away_from_zero(spark):
    values = [2.5, -2.5, 0.5, -0.5, 0.49999999999999994, 1.4999, -1.5, 0.0, 3.0]
    want = [float(Decimal(str(v)).quantize(Decimal(1), ROUND_HALF_UP)) + 0.0 for v in values]
    assert results(column(spark, values), numeric.half_up_integer("x")) == want


def test_known_drops_nan_and_null(spark):
    df = column(spark, [1.0, None, float("nan")])
    assert results(df, numeric.known("x")) == [1.0, None, None]


def test_settled_ignores_the_last_bits(spark):
    df = column(spark, [5.3625, 5.362499999999999, 5.362500000000001])
    assert len(set(results(df, numeric.exact_half_even(numeric.settled("x"), 3)))) == 1


def test_cells_differ_only_on_ties(spark):
    values = [12.5, 2.5, -2.5, 7.5, 11.0, -0.1, 90.0]
    df = column(spark, values)
    assert results(df, grid.cell_centre("x", 5, grid.BATCH)) == [15.0, 5.0, -5.0, 10.0, 10.0, 0.0, 90.0]
    assert results(df, grid.cell_centre("x", 5, grid.LIVE)) == [10.0, 0.0, 0.0, 10.0, 10.0, 0.0, 90.0]


def test_candidate_centres_hold_every_box(spark):
    rng = random.Random(3)
    values = [rng.uniform(-90, 90) for _ in range(500)] + [float(v) for v in range(-90, 95, 5)] + [2.5, -2.5, 5e-17, -5e-17]
    got = results(column(spark, values), grid.centres_within_reach("x", 5))
    for value, centres in zip(values, got):
        needed = {c * 5.0 for c in range(-20, 21) if c * 5.0 - 5 <= value <= c * 5.0 + 5}
        assert needed <= set(centres)
        assert len(centres) == len(set(centres)) <= 3


# magnitude, tsunami, alert, depth -> score
SCORES = [
    (None, 1, "red", 10.0, 0.0),
    (float("nan"), 1, "red", 10.0, 0.0),
    (5.0, 0, None, None, 50.0),
    (6.0, 0, None, None, 60.0),
    (9.5, 0, None, None, 60.0),
    (5.0, 1, None, None, 70.0),
    (5.0, None, None, None, 50.0),
    (5.0, 0, "red", None, 70.0),
    (5.0, 0, "orange", None, 65.0),
    (5.0, 0, "yellow", None, 60.0),
    (5.0, 0, "green", None, 55.0),
    (5.0, 0, "RED", None, 50.0),
    (5.0, 0, "", None, 50.0),
    (5.0, 0, None, 69.99, 55.0),
    (5.0, 0, None, 70.0, 50.0),
    (5.0, 0, None, 0.0, 50.0),
    (5.0, 0, None, -1.0, 55.0),
    (7.0, 1, "red", 10.0, 100.0),
    (-1.0, 0, None, None, -10.0),
    (4.567, 0, None, None, 45.67),
]


def test_risk_score_table(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(SCORES)],
                               "i INT, magnitude DOUBLE, tsunami INT, alert STRING, depth_km DOUBLE, want DOUBLE")
    for r in scoring.with_risk(df).collect():
        assert r.risk_score == r.want, r


@pytest.mark.parametrize("score, tier", [(90.0, "Critical"), (89.99, "High"), (70.0, "High"), (69.99, "Moderate"),
                                         (40.0, "Moderate"), (39.99, "Low"), (-10.0, "Low"), (None, "Low"),
                                         (float("nan"), "Low")])
def test_tiers(spark, score, tier):
    assert results(column(spark, [score]), scoring.risk_tier("x")) == [tier]


def test_depth_classes_are_right_closed(spark):
    values = [0.0, 0.1, 70.0, 70.1, 300.0, 300.1, 9999.0, 10000.0, -1.0, None]
    got = results(column(spark, values), scoring.depth_category("x"))
    assert [g and g.split()[0] for g in got] == [None, "Shallow", "Shallow", "Intermediate", "Intermediate", "Deep", "Deep",
                                                 None, None, None]


def test_severity_bands(spark):
    df = column(spark, [6.0, 5.9, 5.0, 4.9, 4.0, 3.9, None])
    assert results(df, scoring.severity_band("x")) == ["red", "orange", "orange", "orange", "orange", "yellow", "yellow"]
    assert results(df, scoring.severity_band("x", 5.0)) == ["red", "orange", "orange"] + ["yellow"] * 4


def test_regions(spark):
    places = ["12 km S of X, Chile", "Mid-Atlantic Ridge ", "off the coast,", None, "a, b,\tFiji\t"]
    assert results(column(spark, places, "string"), text.region_of("x")) == [
        "Chile", "Mid-Atlantic Ridge", "", "Unknown", "Fiji"]


def test_categories_and_titles(spark):
    df = column(spark, ["wildfires", "seaLakeIce", "tempExtremes", None], "string")
    assert results(df, text.category_name("x")) == ["wildfire", "ice", "tempExtremes", None]
    assert results(column(spark, ["dust_haze", "storm"], "string"), text.title_case("x")) == ["Dust_Haze", "Storm"]
    odd = ["sea-ice 3d", "o'neil é_x", "", None]
    assert results(column(spark, odd, "string"), text.title_case("x")) == [o and o.title() for o in odd]
    assert results(column(spark, [None, 2.25], "double"), text.one_decimal("x")) == ["nan", "2.2"]


def test_iso_text(spark):
    df = column(spark, [1704067207179, 1704067207000, 0], "bigint")
    assert results(df, text.iso_utc(F.col("x"))) == [
        "2024-01-01T00:00:07.179000+00:00", "2024-01-01T00:00:07+00:00", "1970-01-01T00:00:00+00:00"]


def test_location_keeps_the_equator(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0), (1, None, 3.0), (2, float("nan"), 3.0)], "i INT, longitude DOUBLE, latitude DOUBLE")
    points = results(df, scoring.geo_point())
    assert points[0].type == "Point" and list(points[0].coordinates) == [0.0, 0.0]
    assert points[1] is None and points[2] is None
