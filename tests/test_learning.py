"""Forest and cluster pipelines: properties that hold for any fit."""

import duckdb
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from quakeloom.ml import regions, risk_forest
from quakeloom.operators import anomaly, baseline
from quakeloom.plans import training
from quakeloom.sources import adapters

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("forest") / "model")
    quakes = adapters.quakes(spark, SF)
    model, test = risk_forest.train(quakes, path)
    return quakes, path, model, test


def test_forest_beats_the_mean(trained):
    r = risk_forest.metrics(trained[3]).first()
    assert r.r2 > 0.85 and r.rmse < 10 and r.rows > 300


def test_metrics_agree_with_the_evaluator(trained):
    r = risk_forest.metrics(trained[3]).first()
    for name, value in (("rmse", r.rmse), ("r2", r.r2)):
        evaluator = RegressionEvaluator(labelCol="sig_norm", predictionCol="prediction", metricName=name)
        assert evaluator.evaluate(trained[3]) == pytest.approx(value, rel=1e-6)


def test_importances(spark, trained):
    rows = risk_forest.importances(spark, trained[2]).collect()
    assert len(rows) == 11 and sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows == sorted(rows, key=lambda r: -r.importance) and {rows[0].feature, rows[1].feature} == {"magnitude", "mag_squared"}


def test_saved_model_scores_every_event_with_a_magnitude(trained):
    quakes, path, model, _ = trained
    scored = risk_forest.score(quakes, path)
    assert scored.count() == quakes.filter("magnitude IS NOT NULL").count()
    assert scored.filter("predicted_score < 0 OR predicted_score > 100").count() == 0
    assert len(PipelineModel.load(path).stages) == len(model.stages) == 3


def test_training_and_test_rows_do_not_overlap(trained):
    frame = risk_forest.training_frame(trained[0])
    parts = {r.part: r["count"] for r in frame.groupBy("part").count().collect()}
    assert parts["test"] / (parts["test"] + parts["train"]) == pytest.approx(0.2, abs=0.03)
    assert frame.select("event_id").distinct().count() == frame.count()


def test_labels(spark):
    df = spark.createDataFrame([(1001.0,), (1000.0,), (-5.0,), (123.45,), (0.0,)], "significance DOUBLE")
    assert [r[0] for r in df.select(risk_forest.label()).collect()] == [100.0, 100.0, 0.0, 12.35, 0.0]


@pytest.fixture(scope="module")
def tables(spark, trained, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    risk_forest.write_tables(spark, trained[1], path)
    return path


def test_scores_from_the_node_table(spark, trained, tables):
    quakes, path, _, _ = trained
    want = {r.event_id: (r.predicted_score, r.predicted_tier) for r in risk_forest.score(quakes, path).collect()}
    got = {r.event_id: (r.predicted_score, r.predicted_tier) for r in risk_forest.score_by_nodes(quakes, tables).collect()}
    assert set(got) == set(want) and all(abs(got[k][0] - want[k][0]) < 1e-9 for k in want)
    # the other engine goes down the written trees by itself
    rows = PipelineModel.load(path).stages[0].transform(risk_forest.features(quakes)).select("event_id", *risk_forest.FEATURES).toArrow()
    sql = duckdb.connect()
    sql.register("rows", rows)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in risk_forest.FEATURES)
    walked = sql.execute(f"""WITH RECURSIVE n AS (SELECT * FROM read_parquet('{tables}/nodes/*.parquet')), e AS (SELECT event_id, [{values}] AS x FROM rows),
        w AS (SELECT event_id, x, tree, 0 AS node FROM e, (SELECT DISTINCT tree FROM n) UNION ALL SELECT event_id, x, w.tree, CASE WHEN
        CASE WHEN categories IS NULL THEN x[feature + 1] <= threshold ELSE list_contains(categories, x[feature + 1]) END THEN n.left ELSE n.right END
        FROM w JOIN n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NOT NULL)
        SELECT event_id, avg(value) FROM w JOIN n ON n.tree = w.tree AND n.node = w.node WHERE n.feature IS NULL GROUP BY 1""").fetchall()
    assert len(walked) == len(want) and all(abs(v - want[k][0]) < 1e-9 for k, v in walked)


def test_scoring_copies_no_row_for_the_trees(spark, trained, tables):
    plan = risk_forest.score_by_nodes(trained[0], tables)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "SortMergeJoin" not in plan


def test_rows_alike_in_id_and_features_are_scored_once(spark, tables, quake_rows):
    row, other = dict(event_id="a", magnitude=6.0, alert="red"), dict(event_id="a", magnitude=3.0)
    assert risk_forest.score_by_nodes(quake_rows(row, row, other, dict(magnitude=6.0), dict(magnitude=6.0)), tables).count() == 3


def test_the_forest_keeps_the_nodes_of_its_rows(trained):
    assert trained[2].stages[-1].getCacheNodeIds()


def test_importances_from_gains(spark, trained, tables):
    want = {r.feature: r.importance for r in risk_forest.importances(spark, trained[2]).collect()}
    got = risk_forest.importances_by_nodes(spark, tables).collect()
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert {r.feature for r in got} == set(want) and all(abs(r.importance - want[r.feature]) < 1e-9 for r in got)


def test_an_alert_level_the_forest_never_saw(spark, trained, tables, quake_rows):
    new = quake_rows(dict(event_id="a", magnitude=6.0, alert="purple"), dict(event_id="b", magnitude=6.0))
    want = {r.event_id: r.predicted_score for r in risk_forest.score(new, trained[1]).collect()}
    got = {r.event_id: r.predicted_score for r in risk_forest.score_by_nodes(new, tables).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_feature_defaults(spark, quake_rows):
    r = risk_forest.features(quake_rows(
        dict(event_id="a", magnitude=2.0), dict(event_id="b", magnitude=2.0, depth_km=-4.0, alert=""),
        dict(event_id="c", magnitude=2.0, depth_km=300.0), dict(event_id="d"))).orderBy("event_id").collect()
    assert [x.depth_km for x in r] == [33.0, 0.0, 300.0]
    assert (r[0].tsunami, r[0].alert, r[0].month, r[0].hour_of_day, r[0].day_of_week) == (0, "none", 6, 12, 4)
    assert r[1].alert == "" and [(x.is_shallow, x.is_intermediate) for x in r] == [(1, 0), (1, 0), (0, 0)]


def test_clusters(spark, folder):
    fitted = regions.fit(adapters.archive(spark, SF))
    assert 3 <= fitted.k <= 8 and fitted.sweep.count() == 6
    assigned = fitted.assignments()
    assert assigned.filter((F.col("cluster_id") < 0) | (F.col("cluster_id") >= fitted.k)).count() == 0
    profiles = regions.cluster_profiles(assigned)
    assert profiles.agg(F.sum("region_count")).first()[0] == fitted.regions.count()
    regions.save(fitted, f"{folder}/model")
    again = PipelineModel.load(f"{folder}/model").transform(fitted.regions)
    assert again.groupBy("cluster_id").count().count() == profiles.count()


def test_sweep_settles_at_nearest_means(spark):
    found = regions.sweep(baseline.region_features(adapters.archive(spark, SF)))
    rows = regions.nearest(found.points, found.centres).collect()
    centres = {r["k"]: np.array(r["centres"]) for r in found.centres.collect()}
    assert sorted(centres) == [*range(3, 9)] and all(len(c) == k for k, c in centres.items())
    costs = {r["k"]: r["wssse"] for r in found.costs.collect()}
    for k, c in centres.items():
        z = np.array([r["z"] for r in rows if r["k"] == k])
        own = np.array([r["cluster_id"] for r in rows if r["k"] == k])
        far = ((z[:, None, :] - c[None]) ** 2).sum(2)
        assert (far.argmin(1) == own).all() and abs(far.min(1).sum() - costs[k]) < 1e-6
        for i in set(own.tolist()):  # no step moves a centre any more
            assert np.allclose(z[own == i].mean(0), c[i], atol=1e-8)
    assert found.chosen().count() == found.points.count()


def test_sweep_of_few_regions(spark):
    cells = baseline.region_features(adapters.archive(spark, SF))
    assert regions.sweep(cells.limit(0)).chosen().count() == 0
    two = regions.sweep(cells.orderBy("grid_lat", "grid_lon").limit(2))
    assert two.costs.agg(F.max("wssse")).first()[0] == 0.0


def test_elbow_takes_the_first_largest_drop(spark):
    pick = lambda costs: regions.elbow(spark.createDataFrame(costs, "k INT, wssse DOUBLE")).first().best_k
    assert pick([(3, 100.0), (4, 80.0), (5, 60.0), (6, 50.0)]) == 4
    assert pick([(3, 10.0), (4, 20.0), (5, 30.0)]) == 5


@pytest.mark.parametrize("row, label", [
    ((0, 51.0, 4.0, 7.0, 10.0), "Critical Seismic Zone"), ((0, 50.0, 4.5, 7.0, 10.0), "High Seismic Activity"),
    ((0, 20.0, 4.4, 6.9, 10.0), "Frequent Moderate Activity"), ((0, 19.0, 4.4, 6.9, 200.1), "Deep Seismic Zone"),
    ((0, 19.0, 4.4, 6.9, 200.0), "Low Activity")])
def test_cluster_labels(spark, row, label):
    df = spark.createDataFrame([row], "cluster_id INT, eq_count DOUBLE, avg_mag DOUBLE, max_mag DOUBLE, avg_depth DOUBLE")
    assert regions.cluster_profiles(df).first().label == label


def test_training_job_writes_every_result(spark, folder, event_rows):
    quakes = adapters.quakes(spark, "/root/testdata/sf0.001")
    assert training.load_thresholds(spark, folder).first().threshold_moderate == 40.0
    assert training.load_cells(spark, folder) is None and training.load_rates(spark, folder) is None
    training.train_all(quakes, folder, "2024-01-03", "2024-01-31")
    window = quakes.filter("ts >= '2024-01-03' AND magnitude IS NOT NULL")
    rates = training.load_rates(spark, folder).first()
    assert rates.total_events == window.count() and rates.recent_avg_magnitude > 0
    stats = training.load_thresholds(spark, folder).first()
    assert stats.total_cells == training.load_cells(spark, folder).count()
    assert spark.read.json(f"{folder}/risk_forest_importances").count() == 11
    for saved in ("risk_forest_metrics", "anomaly_thresholds", "anomaly_cells", "region_profiles", "seasonal_rates"):
        assert spark.read.json(f"{folder}/{saved}").filter("try_to_timestamp(trained_at) IS NULL").count() == 0
    assert spark.read.json(f"{folder}/region_sweep").filter("chosen").count() == 1
    assert spark.read.json(f"{folder}/seasonal_patterns").filter("level = 'day_of_week'").count() == 7
    found = anomaly.detect(quakes.drop("anomaly_flag"), event_rows(), training.load_thresholds(spark, folder))
    assert found.count() >= 1
