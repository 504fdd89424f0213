"""Forests fitted on weighted points in place of rows."""

import random

import pytest
from flowlab.operators import models
from flowlab.plans import registry
from flowlab.sources import files
from flowlab.sources.shared import shared_dir
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def rows(spark):
    """A number, one of few values, and a flag that few rows carry; the label follows from the flag and from the number."""
    rng = random.Random(3)
    made = [(float(x > 6 or f), x, float(rng.randrange(5)), f) for _ in range(6000) for x, f in [(rng.random() * 10, float(rng.random() < 0.01))]]
    return spark.createDataFrame(made, "label double, x0 double, x1 double, x2 double").cache()


NAMES = ["x0", "x1", "x2"]


def test_points_are_all_rows(rows):
    points = models.forest_points(rows, NAMES, most=500).cache()
    assert points.agg(F.sum("weight")).first()[0] == rows.count()
    per = lambda df, n: {r["label"]: r["n"] for r in df.groupBy("label").agg(n.alias("n")).collect()}
    assert per(points, F.sum("weight")) == per(rows, F.count(F.lit(1)))
    cells = points.select("label", "x").distinct().count()
    assert points.count() <= 500 + cells and points.agg(F.max("weight")).first()[0] <= 12
    assert {r["v"] for r in points.select(F.get("x", F.lit(2)).alias("v")).distinct().collect()} == {0.0, 1.0}  # the rare value too
    assert models.forest_points(rows, NAMES).count() == rows.count()  # one each, where rows are few


def test_moved_rows_fall_where_their_originals_do(spark, rows):
    made = rows.withColumn("scaled", array_to_vector(F.array(*NAMES)))
    model = models.fit_forest(made, "label", trees=5, depth=4)
    scored = {r["v"]: r["p"] for r in models.score(made.withColumn("v", F.struct(*NAMES)), model, "p", ["v"]).collect()}
    moved = models.forest_points(rows, NAMES).withColumn("scaled", array_to_vector("x"))
    want = sorted(round(r["p"], 9) for r in models.score(moved, model, "p", ["label"]).collect())
    assert sorted(round(scored[tuple(r)], 9) for r in rows.select(*NAMES).collect()) == want
    hits = models.predict_labels(made, model, ["0", "1"], ["label"]).filter(F.col("predicted").cast("double") == F.col("label")).count()
    assert hits > 0.97 * rows.count()


def test_a_forest_uses_all_cores_and_leaves_no_tables(spark, rows, monkeypatch):
    """One part of the input is many of the forest's, as MLlib looks for splits in the parts of its input; and the same rows give the same forest."""
    folder, parts, build = f"{shared_dir(spark)}/flowlab", [], models.random_forest

    class Watched:
        def __init__(self, forest):
            self.forest = forest

        def fit(self, df):
            parts.append(df.rdd.getNumPartitions())
            return self.forest.fit(df)

    monkeypatch.setattr(models, "random_forest", lambda *a: Watched(build(*a)))
    before, made = set(files.names(spark, folder)), rows.withColumn("scaled", array_to_vector(F.array(*NAMES)))
    one, other = (models.fit_forest(x, "label", trees=3, depth=4) for x in (made.coalesce(1), made.repartition(7)))
    assert parts == [4, 4] and set(files.names(spark, folder)) == before
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]


@pytest.fixture
def fitted(monkeypatch):
    """The number of rows of each forest that is fitted."""
    seen, fit = [], models.fit_forest
    monkeypatch.setattr(models, "fit_forest", lambda df, *a, **k: seen.append(df.count()) or fit(df, *a, **k))
    return seen


@pytest.fixture(scope="module")
def halves(rows):
    made = rows.select(*NAMES, F.when(F.col("label") > 0, "bad").otherwise("good").alias("kind"))
    return made.filter("x1 < 3"), made.filter("x1 >= 2")


def test_one_forest_for_both_test_sets(halves, fitted):
    train, test = halves
    got = {r["label"]: r for r in models.leakage_causal_test(train, test, ["x0", "x1"], "kind", trees=3).collect()}
    assert fitted == [train.count()] and set(got) == {"good", "bad"}
    assert all(0.9 < r["recall_all"] <= 1 and r["recall_clean"] is not None for r in got.values())


@pytest.mark.parametrize("kind", ["scaler", "logs"])
def test_experiments_fit_all_training_rows(halves, fitted, kind):
    train, test = halves
    if kind == "scaler":
        out = models.scaler_leakage_test(train, test, ["x0", "x1"], "kind", trees=3)
    else:
        out = models.transform_ablation(train, test, ["x0", "x1"], ["x0"], "kind", trees=3)
    got = out.collect()
    assert fitted == [train.count()] * 2 and {r["label"] for r in got} == {"good", "bad"}
    assert all(abs(r[1] - r[2]) < 0.05 and r[1] > 0.9 for r in got)  # a forest hardly minds a scale


@pytest.mark.parametrize("name", ["train_rf_multiclass", "topn_feature_importance", "train_rf_binary"])
def test_queries_fit_points(spark, fitted, monkeypatch, name):
    fit = models.fit_forest
    monkeypatch.setattr(models, "fit_forest", lambda df, label: fit(df, label, trees=2, depth=3))
    assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() >= 3 and len(fitted) == 1
