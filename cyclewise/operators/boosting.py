"""Boosting round by round with early stopping (M6) and importances from the node tables of fitted trees (M7).

A round is one ``pyspark.ml`` regression tree on the residuals of a seeded sample of the training rows.
A round's residuals come from the trees so far, as one model over the rows as they were given: nothing is
written between rounds, however wide the rows are.  The validation error of each round is one aggregate.
Training ends once the best error is ``patience`` rounds old, and the model keeps the trees up to the best
round.  The driver holds the trees and one error for each round.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.telemetry import scratch_path
from .models import BOOSTED_PARAMS, EARLY_STOPPING_ROUNDS


@dataclass
class BoostedStages:
    """Base value, trees and learning rate; ``curve`` holds (round, validation mse) of every round that ran."""

    base: float
    rate: float
    trees: list = field(default_factory=list)
    curve: list[tuple[int, float]] = field(default_factory=list)

    @property
    def best_round(self) -> int:
        return min(self.curve, key=lambda x: (x[1], x[0]))[0]

    @property
    def stopped_round(self) -> int:
        return self.curve[-1][0]

    def model(self, rounds: int | None = None) -> GBTRegressionModel:
        """The trees up to the best round, or the first ``rounds``, as one Spark model (its prediction is without the base value)."""
        rounds = rounds or self.best_round
        spark = SparkSession.getActiveSession()
        gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
        trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
        weights = gateway.new_array(jvm.double, rounds)
        for i in range(rounds):
            trees[i], weights[i] = self.trees[i]._java_obj, float(self.rate)
        return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"gbtr_{uuid.uuid4().hex[:12]}", trees, weights))

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Predictions, clipped at 0 as those of every member (M8)."""
        scored = self.model().setPredictionCol(out).transform(df)
        return scored.withColumn(out, F.greatest(F.col(out) + F.lit(self.base), F.lit(0.0)))

    def curve_frame(self, spark: SparkSession) -> DataFrame:
        """(round, error, best_round, stopped_round)."""
        rows = [(i, e, self.best_round, self.stopped_round) for i, e in self.curve]
        return spark.createDataFrame(rows, "round int, error double, best_round int, stopped_round int")


def fit_stages(train: DataFrame, val: DataFrame, label: str = "RUL", features: str = "features", patience: int = EARLY_STOPPING_ROUNDS,
               rounds: int = BOOSTED_PARAMS["maxIter"], depth: int = BOOSTED_PARAMS["maxDepth"], rate: float = BOOSTED_PARAMS["stepSize"],
               sample: float = BOOSTED_PARAMS["subsamplingRate"], seed: int = BOOSTED_PARAMS["seed"]) -> BoostedStages:
    """M6: boost on ``train``, stop by the error on ``val``; both are read in every round."""
    label = F.col(label).cast("double").alias("_y")
    learn, check = train.select(features, label, F.monotonically_increasing_id().alias("_row")), val.select(features, label)
    base = learn.agg(F.avg("_y")).first()[0]
    if base is None:
        raise ValueError("no training rows")
    out = BoostedStages(float(base), rate)

    def left(df):
        """What the trees so far leave of ``_y``, as ``_res``."""
        so_far = out.model(len(out.trees)).setFeaturesCol(features).setPredictionCol("_f").transform(df) if out.trees else df.withColumn("_f", F.lit(0.0))
        return so_far.withColumn("_res", F.col("_y") - F.lit(out.base) - F.col("_f"))

    for i in range(1, rounds + 1):
        part = F.pmod(F.xxhash64("_row", F.lit(seed + i)), F.lit(1000)) < int(round(sample * 1000))
        learner = DecisionTreeRegressor(featuresCol=features, labelCol="_res", predictionCol="_t", maxDepth=depth, seed=seed + i)
        out.trees.append(learner.fit(left(learn.filter(part)).select(features, "_res")))
        out.curve.append((i, left(check).agg(F.avg(F.col("_res") * F.col("_res"))).first()[0]))
        if i - out.best_round >= patience:
            break
    return out


def node_table(model, path: str | None = None) -> DataFrame:
    """One row for each split of the model's trees: (tree, feature index, gain, cover = training rows at the node).

    The model is written with Spark's own format and its node rows are read back."""
    spark = SparkSession.getActiveSession()
    path = path or scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in rows.columns else None
    fields = rows.select(f"{node}.*", *[c for c in ("treeID",) if c in rows.columns]) if node else rows
    tree = F.col("treeID") if "treeID" in fields.columns else F.lit(0)
    return fields.filter("split.featureIndex >= 0").select(tree.alias("tree"), F.col("split.featureIndex").alias("feature_index"), "gain", F.col("rawCount").cast("double").alias("cover"))


def importances(model, features: Sequence[str]) -> DataFrame:
    """M7: (feature, weight, gain, cover, total_gain, total_cover) of every feature, those without a split at 0:
    weight = splits, gain and cover = means over the splits."""
    spark = SparkSession.getActiveSession()
    names = spark.createDataFrame(list(enumerate(features)), "feature_index int, feature string")
    nodes = node_table(model)
    per = nodes.groupBy("feature_index").agg(F.count(F.lit(1)).alias("weight"), F.avg("gain").alias("gain"), F.avg("cover").alias("cover"),
                                             F.sum("gain").alias("total_gain"), F.sum("cover").alias("total_cover"))
    return names.join(per, "feature_index", "left").na.fill(0).select("feature", "weight", "gain", "cover", "total_gain", "total_cover")
