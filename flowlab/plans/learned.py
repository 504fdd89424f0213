"""Queries that fit models, and streaming queries run to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowlab.operators import metrics, models, splits
from flowlab.plans.base import F4, KEY, SQL_S, Book, events, lineitem, table
from flowlab.plans.alerts import SPIKES
from flowlab.sources.shared import shared_dir, stage
from flowlab.streaming import adaptive, detection

book = Book()


def split_flows(spark, d):
    df = stage(splits.split_random(lineitem(spark, d), KEY).select(KEY, *F4, "l_returnflag", "l_linestatus", "split"), "flows")  # read many times
    return df.filter("split = 'train'"), df.filter("split = 'test'")


def forest_scores(spark, d):
    train, test = split_flows(spark, d)
    pipe = models.scaler_pipeline(F4).fit(train)
    indexer = models.index_labels(train, "l_returnflag")
    model = models.fit_forest(indexer.transform(pipe.transform(train)), "label_idx")
    return pipe, indexer, model, test


@book.add()
def train_rf_multiclass(spark, d):
    pipe, indexer, model, test = forest_scores(spark, d)
    return metrics.per_class_prf(metrics.confusion_counts(models.predict_labels(pipe.transform(test), model, indexer.labels, ["l_returnflag"]), "l_returnflag", "predicted"))


@book.add()
def topn_feature_importance(spark, d):
    _, _, model, _ = forest_scores(spark, d)
    return models.importance(model, F4, spark)


@book.add()
def train_lr_binary(spark, d):
    train, test = split_flows(spark, d)
    y = F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)
    pipe = models.scaler_pipeline(F4).fit(train)
    model = models.stored(spark, models.logistic("y").fit(pipe.transform(train).withColumn("y", y)))
    out = models.score(pipe.transform(test), model, "p", ["l_linestatus"])
    return metrics.threshold_sweep(out, "p", F.col("l_linestatus") == "F", [0.4, 0.5, 0.6])


@book.add()
def train_specialist(spark, d):
    train, test = split_flows(spark, d)
    pipe = models.scaler_pipeline(F4).fit(train)
    model = models.specialist(pipe.transform(train), "l_returnflag", "R", KEY)
    return metrics.per_class_score(models.score(pipe.transform(test), model, "p", ["l_returnflag"]), "l_returnflag", "p", 0.5)


@book.add()
def train_kmeans(spark, d):
    df = models.vectors(table(spark, d, "embeddings"), "embedding").select("vec_id", "label", "scaled")
    _, out, silhouette = models.kmeans(df, 10)
    return metrics.cluster_composition(out, "cluster", "label", -1).withColumn("silhouette", F.round(F.lit(silhouette), 6))


@book.add()
def leakage_causal_test(spark, d):
    train, test = split_flows(spark, d)
    return models.leakage_causal_test(train, test, ["l_quantity", "l_discount", "l_tax"], "l_returnflag")


@book.add()
def scaler_leakage_test(spark, d):
    train, test = split_flows(spark, d)
    return models.scaler_leakage_test(train.drop("split"), test.drop("split"), F4, "l_returnflag")


@book.add()
def transform_ablation(spark, d):
    train, test = split_flows(spark, d)
    return models.transform_ablation(train, test, F4, ["l_extendedprice"], "l_returnflag")


# -- streams: the events table as a file stream, read once -----------------------------------------------------------------


def stream(spark, d):
    schema = table(spark, d, "events").schema
    # a pattern, because a stream reads directories and patterns, not single files
    rows = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value") / 500)))


def finished(spark, df, mode="append"):
    """The output of a streaming query over what is there, through a sink that writes each batch under its number."""
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/stream-{uuid.uuid4().hex}"
    query = detection.start(df, lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/out/batch_id={n}"), f"{root}/checkpoint", mode)
    query.awaitTermination()
    return spark.read.schema(df.schema).option("recursiveFileLookup", True).parquet(f"{root}/out")


@book.add(f"SELECT * FROM {SPIKES} WHERE window_end <= (SELECT max(ts) - INTERVAL 30 SECOND FROM events)")
def stream_tumbling_spike(spark, d):
    """Append mode: each window once, when the watermark has passed its end."""
    return finished(spark, detection.spikes(stream(spark, d), "user_id", "ts", "value", "event_type", "1 day", 5, 7, 9))


@book.add("SELECT event_id, user_id FROM events WHERE user_id % 17 = 0")
def stream_membership(spark, d):
    keys = table(spark, d, "events").select("user_id").filter("user_id % 17 = 0").distinct()
    return finished(spark, detection.membership(stream(spark, d), keys, "user_id").select("event_id", "user_id"))


@book.add(f"SELECT event_id, p FROM {SQL_S} WHERE p >= 0.4")
def stream_score_gate(spark, d):
    return finished(spark, detection.gated(stream(spark, d), "p", 0.4).select("event_id", "p"))


@book.add()
def stream_adaptive_policy(spark, d):
    """The policy of each event type after one micro-batch over all events; every fiftieth event has a verdict."""
    rows = stream(spark, d).withColumn("polarity", F.when(F.col("event_id") % 50 == 0, F.when(F.col("event_type") == "error", 1).otherwise(0)))
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/policy-{uuid.uuid4().hex}"
    detection.start(adaptive.once(rows, "event_id", "ts", "polarity"), adaptive.policy_sink(root, "event_type", "p", "ts", "event_id", "polarity"), f"{root}/checkpoint").awaitTermination()
    return adaptive.telemetry(spark, root)


@book.add(f"""WITH w AS (SELECT event_type AS key, p, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC, p DESC) AS r, polarity IS NOT NULL AS v, p <= 0.0257502 AS low, p >= 0.257502 AS a
 FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN 1 END AS polarity FROM {SQL_S})),
 b AS (SELECT key, greatest(0, least(19, CAST(floor(p * 20) AS INTEGER))) AS bin, count(*) AS n FROM w WHERE r <= 2000 GROUP BY ALL)
 SELECT key, n, alerts, learned, nominal, 0.257502 AS threshold, scores, round(top, 9) AS top_share FROM (SELECT key, CAST(count(*) AS BIGINT) AS n, count(*) FILTER (a) AS alerts, count(*) FILTER (v) AS learned, count(*) FILTER (low) AS nominal FROM w GROUP BY 1)
 JOIN (SELECT key, CAST(sum(n) AS BIGINT) AS scores, max(n) / sum(n) AS top FROM b GROUP BY 1) USING (key)""")
def adaptive_first_batch(spark, d):
    """Counts of a policy's first micro-batch, its threshold, and the size and largest share of the baseline it leaves."""
    rows = events(spark, d).withColumn("polarity", F.when(F.col("event_id") % 50 == 0, 1))
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/policy-{uuid.uuid4().hex}"
    adaptive.policy_sink(root, "event_type", "p", "ts", "event_id", "polarity")(rows, 0)
    state = adaptive.snapshot(spark, root).select("key", F.size("window").cast("bigint").alias("scores"), F.round(F.array_max("baseline"), 9).alias("top_share"))
    return adaptive.telemetry(spark, root).select("key", "n", "alerts", "learned", "nominal", "threshold").join(state, "key")


@book.add("SELECT key, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positive FROM (SELECT event_type AS key, event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events WHERE event_id % 7 = 0) GROUP BY 1")
def learn_feedback(spark, d):
    """Verdicts of a stream in which every event comes twice, in files that follow each other: each counts once."""
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/feedback-{uuid.uuid4().hex}"
    said = events(spark, d).select("event_id", "ts", F.col("event_type").alias("key"), F.when(F.col("event_id") % 7 == 0, (F.col("event_type") == "error").cast("int")).alias("y"))
    schema = said.schema
    for _ in range(2):
        said.repartition(3, "event_id").write.mode("append").parquet(f"{root}/in")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    out = finished(spark, adaptive.once(rows, "event_id", "ts", "y", "365 days"))
    return out.filter(F.col("y").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive"))


@book.add("""SELECT event_type AS key, CAST(3 AS BIGINT) AS batches, CAST(count(*) FILTER (event_id % 50 = 0) AS BIGINT) AS learned, CAST(least(count(*), 2000) AS BIGINT) AS scores FROM events GROUP BY 1""")
def state_save_restore(spark, d):
    """Two micro-batches in one stream, its snapshot saved, and a third in another stream that starts from it."""
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/policy-{uuid.uuid4().hex}"
    rows = events(spark, d).withColumn("polarity", F.when(F.col("event_id") % 50 == 0, 1))
    part = lambda i: rows.filter(F.pmod("event_id", F.lit(3)) == i)
    names = ("event_type", "p", "ts", "event_id", "polarity")
    first = adaptive.policy_sink(f"{root}/one", *names)
    for n in (0, 1):
        first(part(n), n)
    adaptive.snapshot(spark, f"{root}/one").write.parquet(f"{root}/saved")
    adaptive.policy_sink(f"{root}/two", *names, saved=spark.read.parquet(f"{root}/saved"))(part(2), 0)
    state = adaptive.snapshot(spark, f"{root}/two")
    return state.select("key", F.col("batches").cast("bigint").alias("batches"), "learned", F.size("window").cast("bigint").alias("scores"))


@book.add(f"""SELECT key, threshold, CAST(count(*) AS BIGINT) AS n, count(*) FILTER (p >= threshold) AS alerts FROM (SELECT event_type AS key, p, 0.1 + length(event_type) / 100 AS threshold FROM {SQL_S}) GROUP BY ALL""")
def adapt_and_classify(spark, d):
    e = events(spark, d)
    states = e.select(F.col("event_type").alias("key")).distinct().withColumn("threshold", 0.1 + F.length("key") / 100)
    out = adaptive.apply_policy(e, "event_type", "p", states)
    return out.groupBy(F.col("event_type").alias("key"), "threshold").agg(F.count(F.lit(1)).alias("n"), F.count_if("alert").alias("alerts"))


@book.add("""SELECT key, threshold, verdict, batches, updated_at, CAST(epoch(TIMESTAMP '2024-03-01 00:00:00') - floor(epoch(updated_at)) AS BIGINT) AS age, true AS stale FROM
 (SELECT event_type AS key, arg_max(value, ts) AS threshold, arg_max(CASE WHEN value > 50 THEN 'shift' ELSE 'stable' END, ts) AS verdict, arg_max(event_id, ts) AS batches, max(ts) AS updated_at FROM events GROUP BY 1)""")
def learning_status(spark, d):
    t = events(spark, d).select(F.col("event_type").alias("key"), F.col("value").alias("threshold"), F.when(F.col("value") > 50, "shift").otherwise("stable").alias("verdict"), F.col("event_id").alias("batches"), "ts")
    return adaptive.learning_status(t, "ts", "2024-03-01 00:00:00")
