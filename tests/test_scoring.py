"""Models that are saved and loaded, the scoring stream against the batch, metrics from stored predictions against SQL."""

import random

import duckdb
import pytest
from flowlab.operators import filters, metrics, models, policy, schema, sets
from flowlab.sources import keyed, sinks
from flowlab.streaming import detection, scoring
from pyspark.sql import functions as F

FEATURES = ["x", "y"]


@pytest.fixture(scope="module")
def flows(spark):
    rng = random.Random(1)
    rows = [(i, rng.gauss(k, 1), rng.gauss(-k, 1), ["BENIGN", "DoS", "Bot"][k]) for i in range(600) for k in [rng.choice([0, 0, 1, 2])]]
    return spark.createDataFrame(rows, "id bigint, x double, y double, label string").cache()


@pytest.fixture(scope="module")
def bundle(spark, flows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models"))
    pipe = models.scaler_pipeline(FEATURES).fit(flows)
    scaled = pipe.transform(flows)
    indexer = models.index_labels(flows, "label")
    gate = models.random_forest("a", trees=5, depth=4).fit(scaled.withColumn("a", F.when(F.col("label") != "BENIGN", 1.0).otherwise(0.0)))
    several = models.logistic("label_idx").fit(indexer.transform(scaled))
    models.save_bundle(path, {"scaler": pipe, "gate": gate, "specialist": models.specialist(scaled, "label", "Bot", "id", trees=5, depth=4), "labels": indexer, "several": several})
    return models.load_bundle(path, ["scaler", "gate", "specialist", "labels", "several"])


def test_stream_gives_the_alerts_of_the_batch(spark, flows, bundle, tmp_path):
    th = policy.Thresholds(attack=0.4, critical=0.9, high=0.7, medium=0.4)
    parts = {k: v for k, v in bundle.items() if k in ("scaler", "gate", "specialist")}
    score = lambda df: scoring.scored_alerts(df, parts, ["id"], th, "label")
    flows.repartition(3).write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(flows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    detection.start(rows, sinks.alert_sink(f"{tmp_path}/alerts", "ml", score), f"{tmp_path}/check").awaitTermination()
    want = score(flows)
    got = spark.read.option("recursiveFileLookup", True).schema(want.schema).parquet(f"{tmp_path}/alerts")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # and those of the parts, one after another
    ready = parts["scaler"].transform(flows)
    p = models.score(ready, parts["gate"].stages[0], "p", ["id", "label", "scaled"])
    both = models.score(p, parts["specialist"].stages[0], "p_bot", ["id", "label", "p"])
    plain = policy.classified(both, "p", "p_bot", "label", th)
    assert {(r["id"], r["attack_type"], r["severity"]) for r in plain.collect()} == {(r["id"], r["attack_type"], r["severity"]) for r in want.collect()}
    assert 100 < want.count() < 600
    alone = scoring.scored_alerts(flows, {k: parts[k] for k in ("scaler", "gate")}, ["id"], th)
    assert {r["id"] for r in alone.collect()} == {r["id"] for r in want.collect()} and alone.filter("p_bot IS NOT NULL").isEmpty()


def test_metrics_of_stored_predictions_against_sql(flows, bundle, tmp_path):
    names = bundle["labels"].stages[0].labels
    out = models.predict_labels(bundle["scaler"].transform(flows), bundle["several"].stages[0], names, ["label"])
    out.select("label", "predicted").write.parquet(f"{tmp_path}/p")
    got = metrics.multiclass_metrics(metrics.confusion_counts(out, "label", "predicted")).first()
    sql = f"""WITH p AS (SELECT * FROM '{tmp_path}/p/*.parquet'), c AS (SELECT DISTINCT label FROM p), m AS (SELECT c.label, count(*) FILTER (p.label = c.label) AS s, count(*) FILTER (predicted = c.label) AS q,
      count(*) FILTER (p.label = c.label AND predicted = c.label) AS h FROM c, p GROUP BY 1)
      SELECT (SELECT avg(CASE WHEN label = predicted THEN 1.0 ELSE 0 END) FROM p), avg(2 * h / (s + q)), sum(h / q * s) / sum(s), sum(h / s * s) / sum(s), sum(2 * h / (s + q) * s) / sum(s) FROM m"""
    want = duckdb.sql(sql).fetchall()[0]
    assert [got[c] for c in ("accuracy", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")] == pytest.approx(want, abs=2e-6)
    assert models.label_map(bundle["labels"].stages[0])[0] == (0, "BENIGN")


def test_counts_unions_paths_and_state(spark, flows, tmp_path):
    n = {r["label"]: r["count"] for r in flows.groupBy("label").count().collect()}
    assert schema.assert_counts(flows, "label", n) is flows
    with pytest.raises(ValueError, match="Bot"):
        schema.assert_counts(flows, "label", n | {"Bot": 1})
    both = sets.union_positional(flows.select("id", "label"), flows.select("id", F.lower("label")))
    assert both.columns == ["id", "label"] and both.count() == 2 * flows.count()
    with pytest.raises(ValueError):
        sets.union_positional(flows.select("id"), flows)
    flows.withColumn("day", F.col("label")).write.partitionBy("day").parquet(f"{tmp_path}/days")
    rows = spark.read.schema(flows.schema).parquet(f"{tmp_path}/days")
    assert {r["label"] for r in filters.source_path(rows, ["day=Bot/"]).collect()} == {"Bot"}
    assert filters.source_path(rows, ["day=Bot/"], keep=False).count() == flows.count() - n["Bot"]
    for v, t in ((1, 0.5), (3, 0.7), (2, 0.6)):
        keyed.upsert_state(spark.createDataFrame([("k", v, t), (f"k{v}", v, t)], "key string, v int, t double"), f"{tmp_path}/state", ["key"], "v")
    assert {r["key"]: r["t"] for r in keyed.latest_state(spark, f"{tmp_path}/state", ["key"], "v").collect()} == {"k": 0.7, "k1": 0.5, "k2": 0.6, "k3": 0.7}
