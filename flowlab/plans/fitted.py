"""Fitted artifacts whose results SQL has in closed form: scaled features, a tree over categories, one step of the adaptive layer; and renamed columns."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowlab.operators import models, schema
from flowlab.plans import alerts
from flowlab.plans.base import F4, KEY, SQL_S, Book, events, lineitem
from flowlab.plans.flows import SPLIT
from flowlab.plans.learned import split_flows, stream
from flowlab.plans.scoring import folder, hinted, verdicts
from flowlab.sources import sinks
from flowlab.sources.shared import shared_dir
from flowlab.streaming import adaptive, detection, scoring

book = Book()


@book.add("SELECT l_orderkey AS l_order_key, l_quantity, l_tax AS l_quantity_2, l_discount AS Disc FROM lineitem")
def clean_column_names(spark, d):
    return schema.clean_column_names(lineitem(spark, d).select("l_orderkey", "l_quantity", "l_tax", "l_discount").toDF(" l order key", "l  quantity ", "l quantity", "\tDisc"))


@book.add("SELECT l_orderkey, l_linenumber, l_quantity AS size FROM lineitem")
def fix_positional_duplicate(spark, d):
    """A header that occurs twice, as a reader numbers it: the first one stays."""
    twice = lineitem(spark, d).select("l_orderkey", "l_linenumber", F.col("l_tax").alias("size10"), F.col("l_quantity").alias("size4"))
    return schema.fix_positional_duplicate(twice, "size")


@book.add(f"WITH s AS {SPLIT}, f AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in F4)} FROM s WHERE split = 'train') SELECT l_rowkey, {', '.join(f'round(({c} - m_{c}) / s_{c}, 5) AS {c}' for c in F4)} FROM s, f WHERE split = 'test'")
def fit_scaler_train_only(spark, d):
    """Assembler and scaler fitted on training rows, saved and loaded, and applied to test rows."""
    train, test = split_flows(spark, d)
    pipe = models.stored(spark, models.scaler_pipeline(F4).fit(train))
    x = vector_to_array("scaled")
    return pipe.transform(test).select(KEY, *[F.round(x[i], 5).alias(c) for i, c in enumerate(F4)])


@book.add(f"""WITH s AS {SPLIT}, f AS (SELECT l_returnflag, l_linestatus, count(*) FILTER (l_linenumber <= 2) / count(*) AS p FROM s WHERE split = 'train' GROUP BY ALL)
 SELECT l_rowkey, round(p, 6) AS p, CASE WHEN p > 0.5 THEN 'few' ELSE 'more' END AS predicted FROM s JOIN f USING (l_returnflag, l_linestatus) WHERE split = 'test'""")
def score_models(spark, d):
    """Trees over categories, saved and loaded: leaves are groups of training rows, scores their shares; and indexes to labels."""
    train, test = split_flows(spark, d)
    label = F.when(F.col("l_linenumber") <= 2, 1.0).otherwise(0.0)
    with_lines = lambda df: df.withColumn("l_linenumber", F.col(KEY) % 10).withColumn("pair", F.concat("l_returnflag", "l_linestatus"))
    rows = with_lines(train).withColumn("y", label)
    shares = models.stored(spark, models.category_tree("y", ["pair"], "p").fit(rows))
    classes = models.stored(spark, models.category_tree("y", ["pair"], "prediction", True).fit(rows))
    scored = scoring.probability(with_lines(test), shares, "p", [KEY, "pair"])
    return models.predict_labels(scored, classes, ["more", "few"], [KEY, "p"]).select(KEY, F.round("p", 6).alias("p"), "predicted")


RATES = f"(SELECT event_type, count(*) FILTER (event_id % 10 < length(event_type)) / count(*) AS p FROM {SQL_S} GROUP BY 1)"


@book.add(f"""WITH x AS (SELECT event_id, p, CASE event_type WHEN 'view' THEN 'Benign' WHEN 'click' THEN 'Infiltration' WHEN 'signup' THEN NULL ELSE event_type END AS hint FROM events JOIN {RATES} USING (event_type) WHERE p >= 0.2),
 z AS (SELECT *, CASE WHEN trim(coalesce(hint, '')) <> '' AND upper(hint) NOT IN ('BENIGN', 'NORMAL', 'ATTACK') THEN hint ELSE 'Attack (unclassified)' END AS kind FROM x)
 SELECT kind AS attack_type, CASE WHEN p >= 0.6 THEN 'Critical' WHEN p >= 0.4 THEN 'High' ELSE 'Medium' END AS severity, false AS bot_routed, kind <> 'Infiltration' AS auto_alert, CASE WHEN kind = 'Infiltration' THEN 'infiltration_label_suppressed' END AS review_reason,
 count(*) AS n, round(sum(p), 4) AS confidence FROM z GROUP BY ALL""")
def stream_score_tree(spark, d):
    """The scoring stream with a model that was fitted on the events, saved and loaded: alerts through the sink, rolled up."""
    path = folder(spark)
    train = events(spark, d).withColumn("y", F.when(F.col("event_id") % 10 < F.length("event_type"), 1.0).otherwise(0.0))
    models.save_bundle(path, {"gate": models.category_tree("y", ["event_type"], "p_attack").fit(train)})
    loaded = models.load_bundle(path, ["gate"])
    rows = hinted(stream(spark, d).select("event_id", "event_type", "value"))
    sink = sinks.alert_sink(f"{path}/alerts", "ml", lambda b: scoring.scored_alerts(b, loaded, ["event_id"], alerts.TH, "hint"))
    detection.start(rows, sink, f"{path}/checkpoint").awaitTermination()
    out = verdicts(spark.read.option("recursiveFileLookup", True).parquet(f"{path}/alerts"))
    return out.drop("p_bot").withColumn("confidence", F.round("confidence", 4))


# -- the adaptive layer: one micro-batch over all events, whose state SQL can give -----------------------------------------

WINDOW = f"(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC, p DESC) AS r FROM {SQL_S})"


def first_batch(spark, d, config):
    root = f"{shared_dir(spark).rstrip('/')}/flowlab/policy-{uuid.uuid4().hex}"
    rows = events(spark, d).withColumn("polarity", F.when(F.col("event_id") % 50 == 0, (F.col("event_type") == "error").cast("int")))
    adaptive.policy_sink(root, "event_type", "p", "ts", "event_id", "polarity", config=config)(rows, 0)
    return adaptive.snapshot(spark, root)


@book.add(f"""SELECT event_type AS key, round(least(0.493131, greatest(0.128751, 0.257502 + 0.25 * (least(0.493131, greatest(0.128751, target)) - 0.257502))), 9) AS threshold, target < 0.128751 - 1e-9 OR target > 0.493131 + 1e-9 AS saturated
 FROM (SELECT event_type, quantile_cont(p, 0.95) AS target FROM {WINDOW} WHERE r <= 2000 GROUP BY 1)""")
def rate_controller(spark, d):
    """One step of each threshold toward the quantile that meets the budget, inside the band."""
    state = first_batch(spark, d, adaptive.Config(warmup=0, least_window=1))
    return state.select("key", F.round("threshold", 9).alias("threshold"), "saturated")


@book.add(f"""WITH x AS (SELECT event_type AS key, ln(least(1 - 1e-9, greatest(1e-9, p)) / (1 - least(1 - 1e-9, greatest(1e-9, p)))) AS odds, CASE WHEN event_id % 50 = 0 THEN 0.5 - CASE WHEN event_type = 'error' THEN 1 ELSE 0 END ELSE 0 END + CASE WHEN p <= 0.1 * 0.257502 THEN 0.125 ELSE 0 END AS e,
  CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS v, CASE WHEN p <= 0.1 * 0.257502 THEN 1 ELSE 0 END AS low FROM {SQL_S}),
 g AS (SELECT key, CAST(sum(v) AS BIGINT) AS learned, sum(e) / sum(v + low) AS g0, sum(e * odds) / sum(v + low) AS g1, sum(e) * ln(20) / sum(v + low) AS g3 FROM x GROUP BY 1)
 SELECT key, learned, {', '.join(f'round(0 - 0.08 * g{i} / (abs(g{i}) + 1e-8) * 0.99, 6) AS w{i}' for i in (0, 1, 3))} FROM g""")
def residual_calibrator(spark, d):
    """One step of the weights on the mean gradient of verdicts and nominal rows."""
    state = first_batch(spark, d, adaptive.Config())
    return state.select("key", "learned", *[F.round(F.col("weights")[i], 6).alias(f"w{i}") for i in (0, 1, 3)])
