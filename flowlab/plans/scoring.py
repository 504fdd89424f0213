"""Queries of the composed scoring stream, of saved models and of metrics over several classes."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from flowlab.operators import filters, metrics, models, schema, sets
from flowlab.plans import alerts, graphs
from flowlab.plans.base import F4, KEY, SQL_S, Book, events, lineitem, table
from flowlab.plans.learned import split_flows, stream
from flowlab.sources import sinks
from flowlab.sources.shared import shared_dir
from flowlab.streaming import detection, scoring

book = Book()


def folder(spark) -> str:
    return f"{shared_dir(spark).rstrip('/')}/flowlab/scoring-{uuid.uuid4().hex}"


def verdicts(df):
    return df.groupBy("attack_type", "severity", "bot_routed", "auto_alert", "review_reason").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 6).alias("confidence"), F.round(F.sum("p_bot"), 6).alias("p_bot"))


def saved_scores(spark) -> dict:
    """A gate and a specialist with the scores of `classify_flow`, saved and loaded again."""
    path = folder(spark)
    models.save_bundle(path, {
        "gate": SQLTransformer(statement="SELECT *, greatest(0.0, least(1.0, value / 500)) AS p_attack FROM __THIS__"),
        "specialist": SQLTransformer(statement="SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 - p_attack END AS p_bot FROM __THIS__"),
    })
    return models.load_bundle(path, ["gate", "specialist"])


def hinted(df):
    """A class name for some event types, as a hint to the verdict."""
    kind = F.col("event_type")
    return df.withColumn("hint", F.when(kind == "view", "Benign").when(kind == "click", "Infiltration").when(kind == "signup", F.lit(None)).otherwise(kind))



@book.add(alerts.book.sql["classify_flow"])
def stream_score(spark, d):
    """The whole scoring stream with loaded models, through the alert sink; its alerts are those of the batch."""
    path = folder(spark)
    loaded = saved_scores(spark)
    rows = hinted(stream(spark, d).select("event_id", "event_type", "value"))
    sink = sinks.alert_sink(f"{path}/alerts", "ml", lambda b: scoring.scored_alerts(b, loaded, ["event_id"], alerts.TH, "hint"))
    detection.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    return verdicts(spark.read.option("recursiveFileLookup", True).parquet(f"{path}/alerts"))


@book.add()
def stream_score_forest(spark, d):
    """The same with a fitted scaler, forest and specialist that are saved and loaded: alerts of a batch of flows by label and verdict."""
    train, test = split_flows(spark, d)
    pipe = models.scaler_pipeline(F4).fit(train)
    scaled = pipe.transform(train)
    gate = models.fit_forest(scaled.withColumn("y", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)), "y")
    path = folder(spark)
    models.save_bundle(path, {"scaler": pipe, "gate": gate, "specialist": models.specialist(scaled, "l_linestatus", "F", KEY)})
    loaded = models.load_bundle(path, ["scaler", "gate", "specialist"])
    out = scoring.scored_alerts(test, loaded, [KEY, "l_returnflag"])
    return out.groupBy("l_returnflag", "attack_type", "severity").agg(F.count(F.lit(1)).alias("n"))


@book.add()
def train_rf_binary(spark, d):
    """A forest of 50 trees of depth 10 for one class against the rest, swept on held-out rows."""
    train, test = split_flows(spark, d)
    y = F.when(F.col("l_returnflag") == "N", 1.0).otherwise(0.0)
    pipe = models.scaler_pipeline(F4).fit(train)
    model = models.stored(spark, models.fit_forest(pipe.transform(train).withColumn("y", y), "y"))
    out = models.score(pipe.transform(test), model, "p", ["l_returnflag"])
    return metrics.threshold_sweep(out, "p", F.col("l_returnflag") == "N", [0.3, 0.5, 0.7])


@book.add()
def train_lr_multinomial(spark, d):
    train, test = split_flows(spark, d)
    pipe = models.scaler_pipeline(F4).fit(train)
    indexer = models.index_labels(train, "l_returnflag")
    model = models.stored(spark, models.logistic("label_idx").fit(indexer.transform(pipe.transform(train))))
    out = models.predict_labels(pipe.transform(test), model, indexer.labels, ["l_returnflag"])
    return metrics.multiclass_metrics(metrics.confusion_counts(out, "l_returnflag", "predicted"))


@book.add(f"""SELECT t.*, c.*, round(t.correct / t.n, 6) AS accuracy FROM (SELECT CAST(count(*) AS BIGINT) AS n, count(*) FILTER (event_type = pred) AS correct FROM {alerts.PRED}) t,
 (SELECT count(*) AS classes, round(avg(f1), 6) AS macro_f1, round(sum(precision * support) / sum(support), 6) AS weighted_precision, round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM {alerts.PRF}) c""")
def multiclass_metrics(spark, d):
    return metrics.multiclass_metrics(metrics.confusion_counts(alerts.predicted(spark, d), "event_type", "pred"))


@book.add("SELECT 'map' AS part, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS idx, label FROM (SELECT l_returnflag AS label, count(*) AS n FROM lineitem GROUP BY 1)")
def load_label_map(spark, d):
    """A label map that was saved with its indexer and is loaded again: most frequent first, ties by name."""
    path = folder(spark)
    models.save_bundle(path, {"labels": models.index_labels(lineitem(spark, d), "l_returnflag")})
    loaded = models.load_bundle(path, ["labels"])["labels"].stages[0]
    return spark.createDataFrame([("map", i, x) for i, x in models.label_map(loaded)], "part string, idx int, label string")


@book.add("SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'R' THEN 'test' ELSE 'train' END AS split, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1, 2")
def split_by_day_file(spark, d):
    """Whole day files to test or train, by where rows were read from."""
    path = folder(spark)
    lineitem(spark, d).select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_returnflag").alias("day")).write.partitionBy("day").parquet(path)
    rows = spark.read.schema("l_returnflag string, l_linestatus string, l_linenumber bigint").parquet(path)
    parts = {s: filters.source_path(rows, ["day=R/"], keep=s == "test").withColumn("split", F.lit(s)) for s in ("test", "train")}
    return parts["test"].unionByName(parts["train"]).groupBy("l_returnflag", "l_linestatus", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@book.add(f"SELECT event_id, severity FROM {alerts.GRADED} WHERE severity IN ('Critical', 'High')")
def filter_severity(spark, d):
    return filters.severity_in(alerts.graded(spark, d), ["Critical", "High"]).select("event_id", "severity")


@book.add("SELECT user_id AS k, event_type AS name FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, upper(event_type) FROM events WHERE event_id % 2 = 1")
def union_positional(spark, d):
    e = events(spark, d)
    left = e.filter("event_id % 2 = 0").select(F.col("user_id").alias("k"), F.col("event_type").alias("name"))
    return sets.union_positional(left, e.filter("event_id % 2 = 1").select("event_id", F.upper("event_type")))


@book.add("""SELECT coalesce(e.label, a.label) AS label, coalesce(e.n, 0) AS expected, coalesce(a.n, 0) AS actual, coalesce(e.n, 0) = coalesce(a.n, 0) AS passed FROM (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1 UNION ALL SELECT 'X', 5) e
 LEFT JOIN (SELECT o_orderpriority AS label, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) a USING (label)""")
def assert_counts(spark, d):
    """Orders as their lines have them against the counts of the table of orders; a label that is missing fails."""
    orders = table(spark, d, "orders")
    want = {r["label"]: r["n"] for r in orders.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = lineitem(spark, d).select("l_orderkey").distinct().join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return schema.count_report(seen, "o_orderpriority", want | {"X": 5})


@book.add(f"""SELECT t.n, round(t.correct / t.n, 6) AS accuracy, p.label, p.support, p.precision, p.recall, p.f1, c.cells FROM (SELECT count(*) AS n, count(*) FILTER (event_type = pred) AS correct FROM {alerts.PRED}) t, {alerts.PRF} p
 JOIN (SELECT label, string_agg(pred || '=' || n, ',' ORDER BY pred) AS cells FROM (SELECT event_type AS label, pred, count(*) AS n FROM {alerts.PRED} GROUP BY ALL) GROUP BY 1) c USING (label)""")
def sink_metrics_json(spark, d):
    """The nested artifact of an evaluation (totals, a list of classes, of each a map of its predictions) written as one JSON document and read back."""
    path = folder(spark)
    counts = metrics.confusion_counts(alerts.predicted(spark, d), "event_type", "pred")
    sinks.write_artifact(metrics.evaluation(counts), path)
    read = spark.read.schema(metrics.EVALUATION).json(path).select("n", "accuracy", F.explode("classes").alias("c"))
    cells = F.array_join(F.transform(F.array_sort(F.map_entries("c.predicted")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return read.select("n", "accuracy", "c.label", "c.support", "c.precision", "c.recall", "c.f1", cells.alias("cells"))


@book.add(f"SELECT src, dst, weight, has_attack, greatest(1.0, least(5.0, weight / 10)) AS width FROM {graphs.EDGES} WHERE src <> dst")
def sink_graph_payload(spark, d):
    """Nodes and links of a view as the two line-JSON tables that a front end loads, read back."""
    from flowlab.operators import graph

    path = folder(spark)
    e = graphs.edges(spark, d)
    sinks.write_payload(graphs.nodes(spark, d).select("ip", "total_flows"), graph.edge_payload(e), path)
    return spark.read.schema("src bigint, dst bigint, weight bigint, has_attack boolean, width double").json(f"{path}/links")


@book.add(f"SELECT 'all' AS name, count(*) AS n FROM events UNION ALL SELECT 'gated', count(*) FROM {SQL_S} WHERE p >= 0.4")
def stream_checkpoint_multi(spark, d):
    """Two queries over one source, started together, each with its own checkpoint."""
    path = folder(spark)
    rows = stream(spark, d).select("event_id", "p")
    write = lambda name: lambda b, n: b.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={n}")
    detection.run_all({"all": (rows, write("all")), "gated": (detection.gated(rows, "p", 0.4), write("gated"))}, f"{path}/checkpoints")
    read = lambda n: spark.read.option("recursiveFileLookup", True).schema("event_id bigint, p double").parquet(f"{path}/{n}")
    return sets.union_all([read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in ("all", "gated")])
