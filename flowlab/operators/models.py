"""Thin MLlib builders, scoring, and leakage and transform experiments."""

from __future__ import annotations

import math
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import Bucketizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.operators import metrics
from flowlab.operators.joins import shared_vectors
from flowlab.sources.shared import shared_dir, stage, unstage

#: A forest draws its bootstrap from about so many points; a point stands for several equal rows where there are more.
POINTS = 250_000
BINS = 32  # MLlib's own


def scaler_pipeline(features: list[str], out: str = "scaled") -> Pipeline:
    """Assembler and scaler, to be fitted on training rows only."""
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep"), StandardScaler(inputCol="raw_features", outputCol=out, withMean=True, withStd=True)])


def index_labels(train: DataFrame, label: str, out: str = "label_idx"):
    """A fitted indexer; labels unseen in training get the index one past the last."""
    return StringIndexer(inputCol=label, outputCol=out, handleInvalid="keep", stringOrderType="frequencyDesc").fit(train)


def label_map(indexer) -> list[tuple[int, str]]:
    return list(enumerate(indexer.labels))


def random_forest(label: str, features: str = "scaled", weight: str | None = None, trees: int = 50, depth: int = 10, seed: int = 42) -> RandomForestClassifier:
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True)
    return rf.setWeightCol(weight) if weight else rf


def _levels(rows: DataFrame, features: list[str]) -> tuple[int, list[list[float]]]:
    """The number of rows, and the values of each feature that stand for all of them: every one if there are at most BINS, else quantiles."""
    at = [(k + 0.5) / BINS for k in range(BINS)]
    kinds = [(f, n, c) for f in features for n, c in (("d", F.approx_count_distinct(f, 0.02)), ("q", F.percentile_approx(f, at, 10_000)))]
    seen = rows.agg(F.count(F.lit(1)).alias("n"), *[c.alias(n + f) for f, n, c in kinds]).first()
    few = [f for f in features if seen[f"d{f}"] <= 2 * BINS]  # an estimate, so the exact number decides below
    sets = rows.agg(*[F.collect_set(f).alias(f) for f in few]).first() if few else {}
    values = [sets[f] if f in few and len(sets[f]) <= BINS else seen[f"q{f}"] or [] for f in features]
    return seen["n"], [sorted({v + 0.0 for v in vs if not math.isnan(v)}) or [0.0] for vs in values]


def forest_points(rows: DataFrame, features: list[str], most: int | None = None) -> DataFrame:
    """(label, x, weight, i): all rows(label, features), with each feature moved to the nearest of at most BINS levels. MLlib splits half way between
    levels, so moved and original rows fall on the same side of every split. Rows that are equal then are met as blocks, of as many rows as there
    are for each of `most` points (of one where there are fewer), and the weight is the number of rows. Where rows differ nothing is merged."""
    n, levels = _levels(rows, features)
    # a bucket starts with its lower bound, a split ends with its value
    cuts = [[-math.inf, *[math.nextafter((a + b) / 2, math.inf) for a, b in zip(vs, vs[1:], strict=False)], math.inf] for vs in levels]
    bins = [f"_{f}" for f in features]
    placed = Bucketizer(splitsArray=cuts, inputCols=features, outputCols=bins, handleInvalid="keep").transform(rows)
    cells = placed.groupBy("label", *bins).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("m", F.ceil(F.col("n") / max(1, math.ceil(n / (most or POINTS))))).withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), "m")))
    value = [F.get(F.array(*[F.lit(v) for v in vs]), F.least(F.col(b).cast("int"), F.lit(len(vs) - 1))) for b, vs in zip(bins, levels, strict=True)]
    return cells.select("label", F.array(*value).alias("x"), F.expr("n * i div m - n * (i - 1) div m").cast("double").alias("weight"), "i")


def fit_forest(df: DataFrame, label: str, features: str = "scaled", trees: int = 50, depth: int = 10, seed: int = 42):
    """A random forest of all rows, from their `forest_points`. The parts are as many as there are cores, as MLlib looks for splits in the parts of
    its input and each part sends the statistics of all nodes; points of a part are in order, so the same table gives the same forest."""
    array = df.select(F.col(label).cast("double").alias("label"), vector_to_array(features).alias("x"))
    first = array.first()
    if first is None:
        raise ValueError("no rows to fit a forest")
    names = [f"x{i}" for i in range(len(first["x"]))]
    rows = stage(array.select("label", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(names)]), "rows")
    points = stage(forest_points(rows, names), "points")
    parts = max(min(df.sparkSession.sparkContext.defaultParallelism, 64), math.ceil(points.count() / POINTS))
    dealt = points.repartition(parts, "label", "x", "i").sortWithinPartitions("label", "x", "i").select("label", array_to_vector("x").alias(features), "weight")
    model = random_forest("label", features, "weight", trees, depth, seed).fit(dealt)
    unstage(rows, points)
    return model


def logistic(label: str, features: str = "scaled") -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features, maxIter=20, regParam=0.01)


def category_tree(label: str, categories: list[str], out: str, classes: bool = False, depth: int = 8) -> Pipeline:
    """A decision tree over text columns, each indexed as a category (at most 32 values). `out` is the share of a 0/1 label in the leaf; with classes
    it is the more frequent class (a tree of classes is pruned where leaves agree, so its shares are of merged leaves)."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categories]
    assembled = VectorAssembler(inputCols=[f"{c}_idx" for c in categories], outputCol="tree_features", handleInvalid="keep")
    kind = DecisionTreeClassifier if classes else DecisionTreeRegressor
    return Pipeline(stages=[*indexers, assembled, kind(labelCol=label, featuresCol="tree_features", predictionCol=out, maxDepth=depth, maxBins=33)])


def specialist(df: DataFrame, label: str, target: str, key: str, features: str = "scaled", trees: int = 100, depth: int = 12):
    """A one-vs-rest forest on all rows of the target class and about as many others."""
    from flowlab.operators.splits import sample_balanced

    rows = sample_balanced(df, label, target, key).withColumn("_y", F.when(F.col(label) == target, 1.0).otherwise(0.0))
    return fit_forest(rows, "_y", features, trees, depth)


def score(df: DataFrame, model, out: str, keep: list[str]) -> DataFrame:
    """Only the kept columns and the probability of class 1."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(out))


def predict_labels(df: DataFrame, model, labels: list[str], keep: list[str], out: str = "predicted") -> DataFrame:
    """Predicted index turned into its label by a literal array; unseen indexes are null."""
    return model.transform(df).select(*keep, F.get(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int")).alias(out), vector_to_array("probability").alias("probabilities"))


def kmeans(df: DataFrame, k: int, features: str = "scaled", seed: int = 42):
    """(model, clustered rows, silhouette)"""
    model = KMeans(k=k, featuresCol=features, predictionCol="cluster", seed=seed).fit(df)
    out = model.transform(df)
    return model, out, ClusteringEvaluator(featuresCol=features, predictionCol="cluster").evaluate(out)


def importance(model, features: list[str], spark, k: int = 10) -> DataFrame:
    pairs = sorted(zip(features, model.featureImportances.toArray().tolist(), strict=True), key=lambda x: (-x[1], x[0]))[:k]
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(pairs)], "rank int, feature string, importance double")


def auc(df: DataFrame, label: str, raw: str = "rawPrediction") -> float | None:
    """Null on a single class."""
    if df.select(label).distinct().limit(2).count() < 2:
        return None
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw).evaluate(df)


def _fitted(train: DataFrame, scaled_by: DataFrame, features: list[str], label: str, trees: int):
    """A scaler, the indexer of the labels, and a forest."""
    pipe, indexer = scaler_pipeline(features).fit(scaled_by), index_labels(train, label)
    return pipe, indexer, fit_forest(indexer.transform(pipe.transform(train)), "label_idx", trees=trees)


def _recall(fitted, test: DataFrame, label: str, out: str) -> DataFrame:
    pipe, indexer, model = fitted
    return metrics.per_class_recall(predict_labels(pipe.transform(test), model, indexer.labels, [label]), label, "predicted").select("label", F.col("recall").alias(out))


def leakage_causal_test(train: DataFrame, test: DataFrame, features: list[str], label: str, trees: int = 50) -> DataFrame:
    """Recall per class, by one forest, with the test set as it is and without rows whose vector occurs in training."""
    fitted = _fitted(train, train, features, label, trees)
    base = _recall(fitted, test, label, "recall_all")
    clean = _recall(fitted, shared_vectors(test, train, features, "left_anti"), label, "recall_clean")
    return base.join(clean, "label", "full_outer").withColumn("drop", F.round(F.col("recall_all") - F.col("recall_clean"), 6))


def scaler_leakage_test(train: DataFrame, test: DataFrame, features: list[str], label: str, trees: int = 50) -> DataFrame:
    """Recall per class with the scaler fitted on training rows and on all rows."""
    own = _recall(_fitted(train, train, features, label, trees), test, label, "recall_train_scaler")
    both = _recall(_fitted(train, train.unionByName(test), features, label, trees), test, label, "recall_all_scaler")
    return own.join(both, "label", "full_outer")


def transform_ablation(train: DataFrame, test: DataFrame, features: list[str], logged: list[str], label: str, trees: int = 50) -> DataFrame:
    """Recall per class with and without log1p on the named features."""
    from flowlab.operators.clean import log1p_with_floor

    logs = [log1p_with_floor(x, {f: 0.0 for f in logged}) for x in (train, test)]
    plain = _recall(_fitted(train, train, features, label, trees), test, label, "recall_plain")
    return plain.join(_recall(_fitted(logs[0], logs[0], features, label, trees), logs[1], label, "recall_log"), "label", "full_outer")


def vectors(df: DataFrame, column: str, out: str = "scaled") -> DataFrame:
    """An array column as an MLlib vector."""
    return df.withColumn(out, array_to_vector(F.col(column).cast("array<double>")))


def save_bundle(path: str, parts: dict) -> None:
    """Fitted models of any kind (scaler, indexer with its labels, forest, regression, clusters) under their names; each is saved as a
    pipeline, so that one reader loads them all."""
    for name, model in parts.items():
        whole = model if isinstance(model, PipelineModel) else PipelineModel([model])
        whole.write().overwrite().save(f"{path}/{name}")


def stored(spark: SparkSession, model) -> PipelineModel:
    """A fitted model, saved and loaded again, to score with: a model that was just fitted holds its training summary, with the tables of the
    training, and would take them into every task's closure."""
    path = f"{shared_dir(spark).rstrip('/')}/flowlab/model-{uuid.uuid4().hex}"
    save_bundle(path, {"model": model})
    return load_bundle(path, ["model"])["model"]


def load_bundle(path: str, names: list[str]) -> dict[str, PipelineModel]:
    """What `save_bundle` saved; the model itself is the last of `stages`."""
    return {n: PipelineModel.load(f"{path}/{n}") for n in names}
