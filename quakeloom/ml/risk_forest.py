"""Random-forest regression of the normalised significance."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeloom.functions.numeric import is_known, known
from quakeloom.functions.scoring import risk_tier
from quakeloom.operators.sampling import split, stratified

# fixed values: the model's inputs, by name and in order
FEATURES = ["magnitude", "depth_km", "tsunami", "alert_idx", "is_shallow", "is_intermediate", "log_depth",
            "mag_squared", "month", "hour_of_day", "day_of_week"]
LABEL = "sig_norm"


def features(quakes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Model inputs; gaps get fixed defaults, depths above ground count as 0."""
    depth = F.coalesce(known(F.col("depth_km").try_cast("double")), F.lit(33.0))
    x = quakes.filter(is_known("magnitude")).select(
        "event_id",
        F.col("magnitude").try_cast("double").alias("magnitude"),
        F.greatest(depth, F.lit(0.0)).alias("depth_km"),
        F.coalesce(F.col("tsunami").try_cast("int"), F.lit(0)).alias("tsunami"),
        F.coalesce(F.col("alert").cast("string"), F.lit("none")).alias("alert"),
        F.coalesce(F.month("ts"), F.lit(6)).alias("month"),
        F.coalesce(F.hour("ts"), F.lit(12)).alias("hour_of_day"),
        F.coalesce(F.dayofweek("ts"), F.lit(4)).alias("day_of_week"),
        *keep,
    )
    return x.withColumns({
        "is_shallow": (F.col("depth_km") < 70).cast("int"),
        "is_intermediate": ((F.col("depth_km") >= 70) & (F.col("depth_km") < 300)).cast("int"),
        "log_depth": F.log1p("depth_km"),
        "mag_squared": F.col("magnitude") * F.col("magnitude"),
    })


def label(significance: str = "significance") -> Column:
    """Significance scaled to 0..100, two digits, half up."""
    s = known(significance)
    return F.round(F.when(s > 1000, 100.0).when(s < 0, 0.0).otherwise(s / 10.0), 2)


def labelled(quakes: DataFrame) -> DataFrame:
    """Features with the label and the tier of the label."""
    rows = quakes.filter(is_known("magnitude", "significance")).withColumn(LABEL, label())
    return features(rows, [LABEL]).withColumn("risk_tier", risk_tier(LABEL))


def training_frame(quakes: DataFrame) -> DataFrame:
    """Sampled first, so the feature work is done only on the rows kept."""
    return split(labelled(stratified(quakes.filter(is_known("magnitude", "significance")))))


def alert_indexer() -> StringIndexer:
    """Alert levels by falling frequency; an unknown level gets an index of its own."""
    return StringIndexer(inputCol="alert", outputCol="alert_idx", handleInvalid="keep")


def fit(train: DataFrame, trees: int = 100, depth: int = 8, seed: int = 42) -> PipelineModel:
    stages = [
        alert_indexer(),
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip"),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True),
    ]
    return Pipeline(stages=stages).fit(train)


def metrics(predictions: DataFrame) -> DataFrame:
    """RMSE and R2 from one pass over the predictions."""
    error = F.col(LABEL) - F.col("prediction")
    sums = predictions.agg(
        F.count("*").alias("rows"), F.sum(error * error).alias("sse"),
        (F.var_pop(LABEL) * F.count("*")).alias("sst"))
    return sums.select(
        "rows", F.sqrt(F.try_divide("sse", "rows")).alias("rmse"),
        (F.lit(1.0) - F.try_divide("sse", "sst")).alias("r2"))


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature names and importances, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(FEATURES, values)]
    frame = spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return frame.orderBy(F.desc("importance"), "feature")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score(quakes: DataFrame, path: str) -> DataFrame:
    """Score stored events with a saved forest, kept apart from the rule's score."""
    model = PipelineModel.load(path)
    scored = model.transform(features(quakes))
    return scored.select("event_id", F.col("prediction").alias("predicted_score"),
                         risk_tier("prediction").alias("predicted_tier"))


# The forest as tables: what it learned can be read, joined and checked without the model object.

def write_tables(spark: SparkSession, model_path: str, path: str) -> None:
    """From a saved model, write ``nodes`` (a row for each node of each tree) and ``alerts`` (the index of each level) under ``path``.

    An inner node sends a row left when its feature is at most ``threshold``, or, with ``categories``, is one of them.
    """
    stage = lambda n: f"{model_path}/stages/{n}_*/data"
    n = F.col("nodeData")
    inner, listed = n["leftChild"] >= 0, n["split"]["numCategories"] >= 0
    spark.read.parquet(stage(2)).select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, n["split"]["featureIndex"]).alias("feature"),
        F.when(inner & ~listed, n["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & listed, n["split"]["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        n["prediction"].alias("value"), n["gain"].alias("gain"), n["impurityStats"][0].alias("weight"),
    ).write.mode("overwrite").parquet(f"{path}/nodes")
    levels = spark.read.parquet(stage(0)).select(F.posexplode(F.col("labelsArray")[0]).alias("i", "alert"))
    levels.select("alert", F.col("i").cast("double").alias("alert_idx")).write.mode("overwrite").parquet(f"{path}/alerts")


def score_by_nodes(quakes: DataFrame, path: str) -> DataFrame:
    """event_id, predicted_score and predicted_tier from the written tables, level by level.

    Every task holds the node table, whose size the number and depth of the trees bound, as arrays, and takes
    the rows of a batch down all trees by lookups, so no row is copied for the trees or shuffled with them.
    Rows alike in id and features are one.
    """
    spark = quakes.sparkSession
    nodes, alerts = spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/alerts")
    forest, unknown = spark.sparkContext.broadcast(_arrays(nodes)), alerts.count()
    x = features(quakes).join(alerts, "alert", "left").withColumn("alert_idx", F.coalesce("alert_idx", F.lit(float(unknown))))
    rows = x.select("event_id", F.array(*[F.col(c).cast("double") for c in FEATURES]).alias("x")).distinct()

    def score_batches(batches):
        for batch in batches:
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("event_id"), pa.array(_descend(forest.value, values))], ["event_id", "predicted_score"])

    kind = rows.schema["event_id"].dataType.simpleString()
    scored = rows.mapInArrow(score_batches, f"event_id {kind}, predicted_score double")
    return scored.select("event_id", "predicted_score", risk_tier("predicted_score").alias("predicted_tier"))


def _arrays(nodes: DataFrame) -> dict[str, np.ndarray]:
    """The node table as arrays, trees one after another: where each row goes from a node, and the leaves' values.

    A leaf leads to itself. ``listed`` has a row for each node with categories: whether a value goes left.
    """
    found = nodes.orderBy("tree", "node").collect()
    at = {(r["tree"], r["node"]): i for i, r in enumerate(found)}
    leaf = np.array([r["feature"] is None for r in found], bool)
    sets = [r["categories"] for r in found]
    listed = np.array([c is not None for c in sets], bool)
    known = sorted({v for c in sets if c is not None for v in c})
    member = np.zeros((int(listed.sum()), len(known) + 1), bool)  # the last column: a value that no node lists
    for i, c in enumerate(c for c in sets if c is not None):
        member[i, np.searchsorted(known, c)] = True
    return {
        "roots": np.array(sorted(i for (_, node), i in at.items() if node == 0), np.int32),
        "feature": np.array([0 if x else r["feature"] for r, x in zip(found, leaf)], np.int64),
        "threshold": np.array([np.inf if r["threshold"] is None else r["threshold"] for r in found], np.float64),
        "set": np.where(listed, np.cumsum(listed) - 1, -1).astype(np.int32), "known": np.array(known, np.float64), "member": member,
        "left": np.array([i if x else at[r["tree"], r["left"]] for i, (r, x) in enumerate(zip(found, leaf))], np.int32),
        "right": np.array([i if x else at[r["tree"], r["right"]] for i, (r, x) in enumerate(zip(found, leaf))], np.int32),
        "value": np.array([r["value"] for r in found], np.float64),
    }


def _descend(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The rows' mean over the trees."""
    which, known = forest["set"], forest["known"]
    node = np.tile(forest["roots"], (len(x), 1))
    while True:
        mine = np.take_along_axis(x, forest["feature"][node], 1)
        goes = mine <= forest["threshold"][node]
        if len(known):
            some = np.nonzero(which[node] >= 0)
            place = np.minimum(np.searchsorted(known, mine[some]), len(known) - 1)
            place[known[place] != mine[some]] = len(known)
            goes[some] = forest["member"][which[node[some]], place]
        after = np.where(goes, forest["left"][node], forest["right"][node])
        if (after == node).all():
            return forest["value"][node].mean(1)
        node = after


def importances_by_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Feature names and importances from the nodes' gains: shares within a tree, averaged, largest first."""
    gains = spark.read.parquet(f"{path}/nodes").filter("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("gain"))
    shares = gains.withColumn("share", F.try_divide("gain", F.sum("gain").over(Window.partitionBy("tree"))))
    summed = shares.groupBy("feature").agg(F.sum("share").alias("share"))
    names = spark.createDataFrame(list(enumerate(FEATURES)), "i INT, name STRING")
    every = names.join(summed, names["i"] == summed["feature"], "left").select(F.col("name").alias("feature"), F.coalesce("share", F.lit(0.0)).alias("share"))
    total = summed.agg(F.sum("share")).scalar()
    return every.select("feature", F.coalesce(F.try_divide(F.col("share"), total), F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")


def train(quakes: DataFrame, path: str) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training part, save the model, return it with the test predictions."""
    frame = training_frame(quakes).persist()
    try:
        model = fit(frame.filter("part = 'train'"))
        save(model, path)
        # scored from the raw rows, so that nothing outlives this call's cache
        return model, model.transform(training_frame(quakes).filter("part = 'test'"))
    finally:
        frame.unpersist()
