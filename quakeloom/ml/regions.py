"""KMeans profiles of 10-degree regions with elbow selection.

:func:`fit` makes a saved MLlib pipeline, one fit for each k. :func:`sweep` takes Lloyd
steps for all k together: one scan and one aggregate by (k, cluster) a step, with the centres
as a table of a row a k, so its result can be followed by value and applied without a model object.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeloom.functions.grid import CELL
from quakeloom.functions.numeric import settled
from quakeloom.operators.baseline import region_features
from quakeloom.session import materialise

# fixed values: the model's inputs, by name and in order
FEATURES = ["eq_count", "avg_mag", "max_mag", "avg_depth", "mag_variability", "grid_lat", "grid_lon"]
DEFAULT_K = 5


@dataclass
class RegionModel:
    model: PipelineModel
    k: int
    sweep: DataFrame
    regions: DataFrame

    def assignments(self) -> DataFrame:
        return self.model.transform(self.regions)


def elbow(sweep: DataFrame) -> DataFrame:
    """Cost drop from one k to the next; ``chosen`` marks the largest (first wins).

    The frame has one row per tried k.
    """
    drops = sweep.withColumn("drop", F.lag("wssse").over(Window.orderBy("k")) - F.col("wssse"))
    best = drops.filter(F.col("drop") > 0).orderBy(F.desc("drop"), "k").limit(1)
    pick = best.agg(F.coalesce(F.max("k"), F.lit(DEFAULT_K)))
    return drops.withColumn("best_k", pick.scalar()).withColumn("chosen", F.col("k") == F.col("best_k")).orderBy("k")


def standardiser(regions: DataFrame) -> PipelineModel:
    """Feature vectors with zero mean and unit sample deviation."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=True),
    ]).fit(regions)


def fit(quakes: DataFrame, ks: range = range(3, 9), seed: int = 42) -> RegionModel:
    """Sweep k over the standardised features and keep the elbow's model.

    The features are one row per grid cell, written once: the sweep's many
    passes never return to the events.
    """
    regions = materialise(region_features(quakes), "regions")
    prep = standardiser(regions)
    ready = prep.transform(regions).persist()
    try:
        fitted, costs = {}, []
        for k in ks:  # with fewer regions than k, KMeans finds fewer centres
            fitted[k] = KMeans(featuresCol="features", predictionCol="cluster_id", k=k, seed=seed, maxIter=100).fit(ready)
            costs.append((k, round(float(fitted[k].summary.trainingCost), 2)))
    finally:
        ready.unpersist()
    spark = quakes.sparkSession
    sweep = spark.createDataFrame(costs, "k INT, wssse DOUBLE")
    k = elbow(sweep).first()["best_k"]
    return RegionModel(PipelineModel(prep.stages + [fitted[k]]), k, sweep, regions)


@dataclass
class Sweep:
    """``points`` (the regions with ``z`` and their ``number``), ``centres`` (k, centres: an array of positions) and ``costs`` (k, wssse)."""

    points: DataFrame
    centres: DataFrame
    costs: DataFrame

    def chosen(self) -> DataFrame:
        """The regions with cluster_id and squared distance under the elbow's k."""
        best = elbow(self.costs).agg(F.max("best_k")).scalar()
        return nearest(self.points, self.centres).filter(F.col("k") == best)


def scaled(regions: DataFrame) -> DataFrame:
    """Regions with ``z``, their standardised features (0 where all are alike), and ``number`` by events, then place."""
    sums = [f(n).alias(f"{n}_{label}") for n in FEATURES for label, f in (("mean", F.avg), ("std", F.stddev_samp))]
    parts = [settled(F.coalesce(F.try_divide(F.col(n) - F.col(f"{n}_mean"), F.col(f"{n}_std")), F.lit(0.0))) for n in FEATURES]
    # a grid of 10 degrees has 703 cells at most, so one task can number them
    numbered = regions.withColumn("number", F.row_number().over(Window.orderBy("eq_count", *CELL)) - 1)
    return numbered.crossJoin(F.broadcast(regions.agg(*sums))).withColumn("z", F.array(*parts)).select(*regions.columns, "number", "z")


def nearest(points: DataFrame, centres: DataFrame) -> DataFrame:
    """A row for each point and k: the nearest centre (ties: the first) and the squared distance to it."""
    far = lambda c: F.aggregate(F.zip_with("z", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    best = F.array_min(F.transform("centres", lambda c, i: F.struct(far(c).alias("distance"), i.alias("cluster_id"))))
    # one row for each k that is tried
    return points.crossJoin(F.broadcast(centres)).withColumn("best", best).select(
        "k", *points.columns, F.col("best.cluster_id").alias("cluster_id"), F.col("best.distance").alias("distance"))


def sweep(regions: DataFrame, ks: range = range(3, 9), steps: int = 40) -> Sweep:
    """Lloyd steps for all ``ks`` at once, from regions that lie evenly in the order of their events, until no centre moves.

    A cluster that loses its regions keeps its centre.
    """
    spark = regions.sparkSession
    points = materialise(scaled(regions), "scaled-regions")
    n = points.count()
    starts = {k: [(2 * i + 1) * n // (2 * k) for i in range(k)] if n else [] for k in ks}
    held = {r["number"]: r["z"] for r in points.filter(F.col("number").isin(sorted({x for s in starts.values() for x in s}))).select("number", "z").collect()}
    centres = {k: [held[x] for x in s] for k, s in starts.items()}
    frame = lambda: spark.createDataFrame(list(centres.items()), "k INT, centres ARRAY<ARRAY<DOUBLE>>")
    for _ in range(steps if n else 0):
        means = [settled(F.avg(F.get("z", F.lit(i)))) for i in range(len(FEATURES))]
        found = nearest(points, frame()).groupBy("k", "cluster_id").agg(F.array(*means).alias("z")).collect()  # a row for each centre
        moved = {k: list(c) for k, c in centres.items()}
        for r in found:
            moved[r["k"]][r["cluster_id"]] = r["z"]
        if moved == centres:
            break
        centres = moved
    costs = nearest(points, frame()).groupBy("k").agg(settled(F.sum("distance")).alias("wssse"))
    return Sweep(points, frame(), materialise(costs, "sweep-costs"))


def cluster_profiles(assigned: DataFrame) -> DataFrame:
    """Size, means and label of every cluster."""
    profile = assigned.groupBy("cluster_id").agg(
        F.count("*").alias("region_count"), F.avg("eq_count").alias("avg_eq_count"),
        F.avg("avg_mag").alias("cluster_avg_mag"), F.max("max_mag").alias("cluster_max_mag"),
        F.avg("avg_depth").alias("cluster_avg_depth"))
    name = (
        F.when((F.col("cluster_max_mag") >= 7.0) & (F.col("avg_eq_count") > 50), "Critical Seismic Zone")
        .when(F.col("cluster_avg_mag") >= 4.5, "High Seismic Activity")
        .when(F.col("avg_eq_count") >= 20, "Frequent Moderate Activity")
        .when(F.col("cluster_avg_depth") > 200, "Deep Seismic Zone")
        .otherwise("Low Activity")
    )
    return profile.withColumn("label", name).orderBy("cluster_id")


def save(fitted: RegionModel, path: str) -> None:
    fitted.model.write().overwrite().save(path)
