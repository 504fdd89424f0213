"""Queries on events as a scored stream: spikes, policy, feeds, metrics, drift and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlab.functions import labels, scores
from flowlab.operators import drift, feeds, metrics, policy, timeseries
from flowlab.plans.base import SQL_S, Book, events, lineitem, long_sql
from flowlab.streaming import detection

book = Book()
CUTS = [0.05, 0.1, 0.2, 0.4, 0.6, 0.8]
TH = policy.Thresholds(attack=0.2, critical=0.6, high=0.4, medium=0.2, bot=0.1, correct_prior=True)


def is_error():
    return F.col("event_type") == "error"


def scored(spark, d):
    """Events as scored flows: p attack score, p_bot bot score of some, hint a class name."""
    e = events(spark, d)
    hint = F.when(F.col("event_type") == "view", "Benign").when(F.col("event_type") == "click", "Infiltration").when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("event_type"))
    return e.withColumn("p_bot", F.when(F.col("event_id") % 3 == 0, 1 - F.col("p"))).withColumn("hint", hint)


def graded(spark, d):
    """Events graded by score, the alert table of the feeds."""
    return events(spark, d).withColumn("severity", scores.severity(F.col("p"), 0.6, 0.4, 0.2)).withColumn("src_ip", F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 16).cast("string"), F.lit("."), F.col("user_id").cast("string")))


GRADED = f"""(SELECT *, CASE WHEN p >= 0.6 THEN 'Critical' WHEN p >= 0.4 THEN 'High' WHEN p >= 0.2 THEN 'Medium' ELSE 'Low' END AS severity, '10.0.' || CAST(floor(user_id / 16) AS BIGINT) || '.' || user_id AS src_ip FROM {SQL_S})"""


# -- spikes and their roll-up -------------------------------------------------------------------------------------------

SPIKES = """(WITH c AS (SELECT user_id, date_trunc('day', ts) AS w, event_type, count(*) AS k, sum(value) AS s FROM events GROUP BY ALL),
 m AS (SELECT user_id, w, CAST(sum(k) AS BIGINT) AS connection_count, round(sum(s), 6) AS total_size, arg_min(event_type, (-k, event_type)) AS attack_label FROM c GROUP BY ALL)
 SELECT user_id, w AS window_start, w + INTERVAL 1 DAY AS window_end, connection_count, total_size, attack_label, CASE WHEN connection_count >= 9 THEN 'Critical' WHEN connection_count >= 7 THEN 'High' ELSE 'Medium' END AS severity FROM m WHERE connection_count >= 5)"""


@book.add(f"SELECT * FROM {SPIKES}")
def tumbling_spike(spark, d):
    return detection.spikes(events(spark, d), "user_id", "ts", "value", "event_type", "1 day", 5, 7, 9)


@book.add(f"""SELECT attack_label, severity, CAST(count(*) AS BIGINT) AS flow_count, count(DISTINCT user_id) AS dst_count, min(window_start) AS first_seen, max(window_start) AS last_seen, CAST(max(connection_count) AS DOUBLE) AS max_confidence FROM {SPIKES} GROUP BY ALL""")
def spike_rollup(spark, d):
    """The flagship: spikes of the stream, graded, rolled up by label and severity."""
    s = tumbling_spike(spark, d).withColumn("o", F.unix_seconds("window_start"))
    return policy.alert_rollup(s, ["attack_label", "severity"], "user_id", "o", "connection_count", "window_start").drop("dsts", "top_dst")


@book.add(f"""WITH a AS (SELECT user_id, event_type, event_id AS o, ts, p, CAST(event_id % 40 AS VARCHAR) AS dst FROM {SQL_S} WHERE p >= 0.2), f AS (SELECT user_id, event_type, dst, min(o) AS f FROM a GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY f) AS n FROM f)
 SELECT a.user_id, a.event_type, count(*) AS flow_count, count(DISTINCT a.dst) AS dst_count, any_value(l.dsts) AS dsts, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(a.dst, (p, -o)) AS top_dst, max(p) AS max_confidence
 FROM a JOIN (SELECT user_id, event_type, string_agg(dst, ',' ORDER BY f) AS dsts FROM r WHERE n <= 3 GROUP BY ALL) l USING (user_id, event_type) GROUP BY ALL""")
def alert_rollup(spark, d):
    a = events(spark, d).filter("p >= 0.2").withColumn("dst", (F.col("event_id") % 40).cast("string"))
    return policy.alert_rollup(a, ["user_id", "event_type"], "dst", "event_id", "p", "ts", 3).withColumn("dsts", F.array_join("dsts", ","))


# -- scores and policy --------------------------------------------------------------------------------------------------


@book.add(f"""WITH x AS (SELECT event_id, p, least(1 - 1e-9, greatest(1e-9, p)) AS q FROM {SQL_S}) SELECT event_id, round(ln(q / (1 - q)), 6) AS logit, round(1 / (1 + exp(-(ln(q / (1 - q)) + ln(0.05 / 0.95)))), 6) AS rebased, round(1 / (1 + exp(-(ln(q / (1 - q)) - ln(0.05 / 0.95)))), 6) AS inverse,
 CAST(least(19, floor(p * 20)) AS INTEGER) AS bin FROM x""")
def prior_rebasing(spark, d):
    p = F.col("p")
    return events(spark, d).select("event_id", F.round(scores.logit(p), 6).alias("logit"), F.round(scores.rebase(p, 0.5, 0.05), 6).alias("rebased"), F.round(scores.rebase_inverse(p, 0.5, 0.05), 6).alias("inverse"), scores.score_bin(p).alias("bin"))


@book.add(f"""WITH x AS (SELECT event_id, event_type, p, CASE WHEN event_id % 3 = 0 THEN 1 - p END AS pb, CASE event_type WHEN 'view' THEN 'Benign' WHEN 'click' THEN 'Infiltration' WHEN 'signup' THEN NULL ELSE event_type END AS hint FROM {SQL_S} WHERE p >= 0.2),
 y AS (SELECT *, CASE WHEN pb IS NOT NULL THEN 1 / (1 + exp(-(ln(least(1 - 1e-9, greatest(1e-9, pb)) / (1 - least(1 - 1e-9, greatest(1e-9, pb)))) + ln(0.05 / 0.95)))) END AS b FROM x),
 z AS (SELECT *, CASE WHEN b >= 0.1 THEN 'Bot' WHEN trim(coalesce(hint, '')) <> '' AND upper(hint) NOT IN ('BENIGN', 'NORMAL', 'ATTACK') THEN hint ELSE 'Attack (unclassified)' END AS kind FROM y)
 SELECT kind AS attack_type, CASE WHEN p >= 0.6 THEN 'Critical' WHEN p >= 0.4 THEN 'High' ELSE 'Medium' END AS severity, pb IS NOT NULL AS bot_routed, kind <> 'Infiltration' AS auto_alert, CASE WHEN kind = 'Infiltration' THEN 'infiltration_label_suppressed' END AS review_reason,
 count(*) AS n, round(sum(p), 6) AS confidence, round(sum(b), 6) AS p_bot FROM z GROUP BY ALL""")
def classify_flow(spark, d):
    v = policy.classified(scored(spark, d).select("event_id", "p", "p_bot", "hint"), "p", "p_bot", "hint", TH)
    return v.groupBy("attack_type", "severity", "bot_routed", "auto_alert", "review_reason").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 6).alias("confidence"), F.round(F.sum("p_bot"), 6).alias("p_bot"))


@book.add(f"""SELECT 'review' AS route, count(*) AS n FROM {SQL_S} WHERE p >= 0.2 AND event_type = 'click' UNION ALL SELECT 'auto', count(*) FROM {SQL_S} WHERE p >= 0.2 AND event_type <> 'click'""")
def route_auto_vs_review(spark, d):
    v = policy.classified(scored(spark, d).withColumn("p_bot", F.lit(None).cast("double")).select("event_id", "p", "p_bot", "hint"), "p", "p_bot", "hint", TH)
    auto, review = policy.route(v)
    return auto.agg(F.count(F.lit(1)).alias("n")).select(F.lit("auto").alias("route"), "n").unionByName(review.agg(F.count(F.lit(1)).alias("n")).select(F.lit("review").alias("route"), "n"))


@book.add(f"""SELECT event_id, 'nominal' AS tag FROM {SQL_S} WHERE p < 0.2 AND CAST(CAST('0x' || substr(md5('nominal' || event_id), 1, 15) AS BIGINT) % 1000000 AS INTEGER) / 1000000 < 0.1""")
def mirror_nominal(spark, d):
    return policy.mirror_nominal(events(spark, d), "p", 0.2, "event_id", 0.1).select("event_id", "tag")


@book.add(f"""WITH x AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'Confirmed' WHEN 'view' THEN 'FALSE-POSITIVE' WHEN 'click' THEN '1' WHEN 'signup' THEN 'maybe' END AS v, CASE WHEN event_id % 11 = 0 THEN 2.0 ELSE p END AS s FROM {SQL_S}),
 y AS (SELECT *, CAST(CASE v WHEN 'Confirmed' THEN 1 WHEN 'FALSE-POSITIVE' THEN 0 WHEN '1' THEN 1 END AS INTEGER) AS polarity FROM x)
 SELECT polarity, CASE WHEN polarity IS NULL THEN 'unusable verdict' WHEN s > 1 THEN 'score outside [0, 1]' END AS reject_reason, count(*) AS n FROM y GROUP BY ALL""")
def validate_feedback(spark, d):
    v = F.when(is_error(), "Confirmed").when(F.col("event_type") == "view", "FALSE-POSITIVE").when(F.col("event_type") == "click", "1").when(F.col("event_type") == "signup", "maybe")
    df = events(spark, d).select("event_id", v.alias("v"), F.when(F.col("event_id") % 11 == 0, 2.0).otherwise(F.col("p")).alias("s"))
    return policy.validate_feedback(df, "v", "s").groupBy("polarity", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@book.add(f"SELECT count(*) FILTER (p >= 0.4) AS gate, count(*) FILTER (p >= 1 / (1 + exp(-(ln(0.4 / 0.6) - 1.5)))) AS prefilter, count(*) AS n FROM {SQL_S}")
def filter_score_gate(spark, d):
    p = F.col("p")
    return events(spark, d).agg(F.count_if(scores.above(p, 0.4)).alias("gate"), F.count_if(p >= scores.safe_prefilter(0.4)).alias("prefilter"), F.count(F.lit(1)).alias("n"))


@book.add("""SELECT CAST(CASE WHEN l_quantity >= 17.92 AND (l_tax * 100 <= 6.21 OR CAST(l_suppkey AS INTEGER) IN (80, 443, 8080, 8443, 3389, 22, 21, 25, 53) OR l_extendedprice / greatest(l_discount * 100000, 1.0) >= 3.0) THEN 1 ELSE 0 END AS INTEGER) AS rule, count(*) AS n FROM lineitem GROUP BY 1""")
def rules_infiltration(spark, d):
    r = policy.rules_infiltration(F.col("l_quantity"), F.col("l_tax") * 100, F.col("l_suppkey"), F.col("l_discount") * 100000, F.col("l_extendedprice"))
    return lineitem(spark, d).groupBy(r.alias("rule")).agg(F.count(F.lit(1)).alias("n"))


@book.add(f"""SELECT CASE WHEN p > 0.8 THEN event_type WHEN event_id % 3 = 0 AND 1 - p > 0.5 THEN 'Bot' WHEN event_id % 5 = 0 THEN 'Infiltration' WHEN event_id % 7 = 0 THEN 'PortScan' ELSE 'Unknown' END AS label, count(*) AS n FROM {SQL_S} GROUP BY 1""")
def tiered_fallback(spark, d):
    df = scored(spark, d)
    rule, pure = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0), F.when(F.col("event_id") % 7 == 0, 0.9).otherwise(0.5)
    return df.groupBy(policy.tiered(F.col("p"), F.col("event_type"), F.col("p_bot"), rule, F.lit("PortScan"), pure).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@book.add("SELECT CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'Infiltration' ELSE event_type END AS label, count(*) AS n FROM events GROUP BY 1")
def rule_override_label(spark, d):
    return events(spark, d).groupBy(policy.rule_override(F.col("event_type"), F.when(F.col("event_id") % 2 == 0, 1).otherwise(0), "view").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@book.add(f"""WITH k AS (SELECT DISTINCT user_id FROM events), a AS (SELECT user_id, round(max(p), 6) AS danger FROM {SQL_S} WHERE event_type = 'error' AND p >= 0.5 GROUP BY 1)
 SELECT user_id, user_id % 17 = 0 AS listed, danger IS NOT NULL AS attacker, coalesce(danger, 0.0) AS danger, CASE WHEN user_id % 17 = 0 OR danger IS NOT NULL THEN 'malicious' ELSE 'unknown' END AS verdict FROM k LEFT JOIN a USING (user_id)""")
def ip_reputation(spark, d):
    e = events(spark, d)
    attackers = e.filter("event_type = 'error' AND p >= 0.5").select("user_id", F.round("p", 6).alias("danger"))
    return policy.ip_reputation(e, "user_id", e.filter("user_id % 17 = 0"), attackers)


# -- metrics ------------------------------------------------------------------------------------------------------------

PRED = "(SELECT *, CASE WHEN event_id % 4 = 0 THEN 'view' ELSE event_type END AS pred FROM events)"


def predicted(spark, d):
    return events(spark, d).withColumn("pred", F.when(F.col("event_id") % 4 == 0, "view").otherwise(F.col("event_type")))


@book.add(f"SELECT event_type AS label, pred AS prediction, count(*) AS n FROM {PRED} GROUP BY ALL")
def confusion_counts(spark, d):
    return metrics.confusion_counts(predicted(spark, d), "event_type", "pred")


@book.add(f"SELECT event_type = 'view' AS benign, p >= 0.3 AS gate, event_id % 3 = 0 AS bot, count(*) AS n FROM {SQL_S} GROUP BY ALL")
def confusion_cells(spark, d):
    return metrics.confusion_cells(events(spark, d), benign=F.col("event_type") == "view", gate=scores.above(F.col("p"), 0.3), bot=F.col("event_id") % 3 == 0)


@book.add(f"SELECT pred AS prediction, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {PRED} WHERE event_type = 'error' AND pred <> 'error' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
def miss_breakdown(spark, d):
    return metrics.miss_breakdown(predicted(spark, d), "event_type", "pred", "error")


@book.add(f"SELECT event_type AS label, count(*) AS support, count(*) FILTER (event_type = pred) AS correct, round(count(*) FILTER (event_type = pred) / count(*), 6) AS recall FROM {PRED} GROUP BY 1")
def per_class_recall(spark, d):
    return metrics.per_class_recall(predicted(spark, d), "event_type", "pred")


@book.add(f"SELECT event_type AS label, count(*) AS n, round(avg(p), 6) AS mean_score, round(avg(CASE WHEN p >= 0.2 THEN 1.0 ELSE 0.0 END), 6) AS flagged FROM {SQL_S} GROUP BY 1")
def per_class_mean_score(spark, d):
    return metrics.per_class_score(events(spark, d), "event_type", "p", 0.2)


PRF = f"""(WITH s AS (SELECT event_type AS label, count(*) AS support, count(*) FILTER (event_type = pred) AS correct FROM {PRED} GROUP BY 1), q AS (SELECT pred AS label, count(*) AS predicted FROM {PRED} GROUP BY 1)
 SELECT label, support, round(coalesce(correct / predicted, 0), 6) AS precision, round(correct / support, 6) AS recall, round(2 * correct / (predicted + support), 6) AS f1 FROM s LEFT JOIN q USING (label))"""


@book.add(f"SELECT * FROM {PRF}")
def per_class_precision_recall(spark, d):
    return metrics.per_class_prf(confusion_counts(spark, d))


@book.add(f"SELECT round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM {PRF}")
def macro_scores(spark, d):
    return metrics.macro_scores(per_class_precision_recall(spark, d))


SWEEP = f"""(WITH g AS (SELECT unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in CUTS)}]) AS cut), t AS (SELECT count(*) FILTER (event_type = 'error') AS np, count(*) FILTER (event_type <> 'error') AS nn FROM events)
 SELECT cut, count(*) FILTER (p >= cut) AS alerts, count(*) FILTER (p >= cut AND event_type = 'error') AS tp, count(*) FILTER (p >= cut AND event_type <> 'error') AS fp, round(count(*) FILTER (p >= cut AND event_type <> 'error') / any_value(nn), 6) AS fpr,
 round(count(*) FILTER (p >= cut AND event_type = 'error') / any_value(np), 6) AS recall, round(count(*) FILTER (p >= cut AND event_type = 'error') / nullif(count(*) FILTER (p >= cut), 0), 6) AS precision FROM {SQL_S}, g, t GROUP BY cut)"""


@book.add(f"SELECT * FROM {SWEEP}")
def threshold_sweep(spark, d):
    return metrics.threshold_sweep(events(spark, d), "p", is_error(), CUTS)


@book.add(f"SELECT unnest([0.05, 0.1]::DOUBLE[]) AS fpr, unnest([round(quantile_cont(p, 0.95), 6), round(quantile_cont(p, 0.9), 6)]) AS cut FROM {SQL_S} WHERE event_type <> 'error'")
def cut_for_target_fpr(spark, d):
    return metrics.cut_for_fpr(events(spark, d).filter(~is_error()), "p", [0.05, 0.1])


@book.add(f"SELECT round(quantile_cont(p, 0.9), 6) AS medium, round(quantile_cont(p, 0.95), 6) AS high, round(quantile_cont(p, 0.99), 6) AS critical FROM {SQL_S} WHERE event_type = 'view'")
def severity_ladder_fit(spark, d):
    return metrics.severity_ladder(events(spark, d).filter("event_type = 'view'"), "p", 0.1)


V2 = f"(SELECT *, CASE WHEN event_type = 'error' THEN least(1.0, p * 1.5) ELSE p END AS p2 FROM {SQL_S})"


def versions(spark, d):
    return events(spark, d).withColumn("p2", F.when(is_error(), F.least(F.lit(1.0), F.col("p") * 1.5)).otherwise(F.col("p")))


@book.add(f"""WITH c AS (SELECT quantile_cont(p, 0.9) AS a, quantile_cont(p2, 0.9) AS b FROM {V2} WHERE event_type = 'view'), x AS (SELECT 'p' AS version, p AS s, event_type, a AS cut FROM {V2}, c UNION ALL SELECT 'p2', p2, event_type, b FROM {V2}, c)
 SELECT event_type AS label, count(*) AS n, version, round(any_value(cut), 6) AS cut, count(*) FILTER (s >= cut) AS flagged, round(count(*) FILTER (s >= cut) / count(*), 6) AS rate FROM x GROUP BY 1, 3""")
def matched_fpr_compare(spark, d):
    return metrics.matched_fpr_compare(versions(spark, d), ["p", "p2"], "event_type", "view", 0.1)


@book.add(f"""WITH x AS (SELECT event_type AS label, round(avg(CASE WHEN p >= 0.3 THEN 1.0 ELSE 0.0 END), 6) AS left_rate, round(avg(CASE WHEN p2 >= 0.3 THEN 1.0 ELSE 0.0 END), 6) AS right_rate FROM {V2} GROUP BY 1)
 SELECT *, round(right_rate - left_rate, 6) AS delta, CASE WHEN round(right_rate - left_rate, 6) > 0 THEN 'up' WHEN round(right_rate - left_rate, 6) < 0 THEN 'down' ELSE 'same' END AS mark FROM x""")
def compare_versions_fixed_cut(spark, d):
    return metrics.compare_at_cut(versions(spark, d), "p", "p2", "event_type", 0.3)


@book.add(f"""WITH f AS (SELECT cut, 2 * precision * recall / nullif(precision + recall, 0) AS f FROM {SWEEP} WHERE precision >= 0.1 AND recall >= 0.2), m AS (SELECT max(f) AS f FROM f)
 SELECT coalesce(min(cut) FILTER (f.f = m.f), 0.5) AS cut, round(any_value(m.f), 6) AS f1, count(m.f) > 0 AS met FROM m LEFT JOIN f ON true""")
def best_cut_with_floors(spark, d):
    return metrics.best_cut(threshold_sweep(spark, d), 0.1, 0.2, 0.5)


@book.add(f"""SELECT count(*) FILTER (t) AS positives, count(*) FILTER (t AND g) AS gate, count(*) FILTER (t AND s) AS specialist, count(*) FILTER (t AND g AND s) AS "both", count(*) FILTER (NOT t AND g AND s) AS false_both, count(*) FILTER (NOT t) AS negatives,
 round(count(*) FILTER (t AND g AND s) / count(*) FILTER (t), 6) AS recall, round(count(*) FILTER (NOT t AND g AND s) / count(*) FILTER (NOT t), 6) AS fpr FROM (SELECT event_type = 'error' AS t, p >= 0.1 AS g, event_id % 3 > 0 AS s FROM {SQL_S})""")
def gated_recall(spark, d):
    return metrics.gated_recall(events(spark, d), scores.above(F.col("p"), 0.1), F.col("event_id") % 3 > 0, is_error())


@book.add(f"""SELECT event_type AS label, count(*) AS n, cut, count(*) FILTER (greatest(p, 1 - p) >= cut) AS kept, round(count(*) FILTER (greatest(p, 1 - p) >= cut) / count(*), 6) AS coverage FROM {SQL_S}, (SELECT unnest([0.6, 0.9]::DOUBLE[]) AS cut) GROUP BY event_type, cut""")
def open_set_reject(spark, d):
    return metrics.open_set_reject(events(spark, d), F.array("p", 1 - F.col("p")), "event_type", [0.6, 0.9])


F4C = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@book.add(f"""WITH x AS (SELECT k = 'R' AS t, feature, value FROM ({long_sql(F4C, "l_returnflag")})), c AS (SELECT feature, value, count(*) FILTER (t) AS pos, count(*) FILTER (NOT t) AS neg FROM x GROUP BY ALL), w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM c)
 SELECT feature, round(sum(pos * (b + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc, greatest(round(sum(pos * (b + neg / 2)) / (sum(pos) * sum(neg)), 6), 1 - round(sum(pos * (b + neg / 2)) / (sum(pos) * sum(neg)), 6)) > 0.8 AS flagged FROM w GROUP BY 1""")
def single_feature_auc(spark, d):
    return metrics.rank_auc(lineitem(spark, d), F4C, F.col("l_returnflag") == "R")


@book.add(f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (p >= 0.1 AND event_type = 'error') AS tp, count(*) FILTER (p >= 0.1 AND event_type <> 'error') AS fp, count(*) FILTER (p < 0.1 AND event_type = 'error') AS fn, count(*) FILTER (p < 0.1 AND event_type <> 'error') AS tn FROM {SQL_S})
 SELECT *, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def binary_metrics(spark, d):
    return metrics.binary_metrics(events(spark, d), "p", is_error(), 0.1)


@book.add(f"""WITH x AS (SELECT avg(value) FILTER (p >= 0.1) AS a, avg(value) FILTER (p < 0.1) AS b, avg(user_id) FILTER (p >= 0.1) AS c, avg(user_id) FILTER (p < 0.1) AS e FROM {SQL_S} WHERE event_type <> 'error'), r AS (SELECT 'value' AS feature, a, b FROM x UNION ALL SELECT 'user_id', c, e FROM x)
 SELECT feature, round(a, 6) AS fp_mean, round(b, 6) AS tn_mean, round(a / b, 6) AS ratio, a / b > 3 OR a / b < 0.33 AS flagged FROM r""")
def fp_tn_feature_means(spark, d):
    return metrics.outcome_feature_means(events(spark, d), ["value", "user_id"], "p", is_error(), 0.1)


@book.add(f"SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, count(*) FILTER (p >= 0.1) AS fp, round(count(*) FILTER (p >= 0.1) / count(*), 6) AS fpr FROM {SQL_S} WHERE event_type <> 'error' GROUP BY 1")
def hourly_fpr(spark, d):
    return metrics.hourly_fpr(events(spark, d), "ts", "p", is_error(), 0.1)


@book.add(f"SELECT cut, fp, round(fp / 6.0, 6) AS hours, round(fp / 6.0 * 50, 6) AS cost FROM {SWEEP}")
def fp_cost(spark, d):
    return metrics.fp_cost(threshold_sweep(spark, d))


COMP = """(WITH c AS (SELECT CAST(user_id % 10 AS INTEGER) AS cluster, event_type AS label, count(*) AS n FROM events GROUP BY ALL)
 SELECT cluster, CAST(sum(n) AS BIGINT) AS size, arg_min(label, (-n, label)) AS dominant, round(max(n) / sum(n), 6) AS purity, round(coalesce(sum(n) FILTER (label <> 'view'), 0) / sum(n), 6) AS attack_share, count(*) AS labels FROM c GROUP BY 1)"""


@book.add(f"SELECT * FROM {COMP}")
def cluster_composition(spark, d):
    return metrics.cluster_composition(events(spark, d).withColumn("c", (F.col("user_id") % 10).cast("int")), "c", "event_type", "view")


@book.add(f"SELECT round(avg(purity), 6) AS mean_purity, round(sum(purity * size) / sum(size), 6) AS weighted_purity FROM {COMP}")
def cluster_purity(spark, d):
    return metrics.cluster_purity(cluster_composition(spark, d))


# -- feeds --------------------------------------------------------------------------------------------------------------


@book.add(f"SELECT severity AS value, count(*) AS n FROM {GRADED} GROUP BY 1")
def count_by_severity(spark, d):
    return feeds.counts_by(graded(spark, d), "severity")


@book.add(f"SELECT src_ip AS value, count(*) AS n FROM {GRADED} GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def top_src_ips(spark, d):
    return feeds.counts_by(graded(spark, d), "src_ip", 10)


@book.add(f"""WITH m AS (SELECT max(ts) AS m FROM events) SELECT count(*) AS total, count(*) FILTER (severity = 'Critical') AS critical, count(*) FILTER (severity = 'High') AS high, count(*) FILTER (ts > m - INTERVAL 300 MINUTE) AS active FROM {GRADED}, m""")
def kpi_summary(spark, d):
    return feeds.kpi_summary(graded(spark, d), "severity", "ts", 300)


@book.add(f"SELECT date_trunc('hour', ts) AS bucket, severity AS value, count(*) AS n FROM {GRADED} GROUP BY ALL")
def hourly_alert_volume(spark, d):
    return feeds.timeline(graded(spark, d), "ts", "severity")


@book.add("SELECT date_trunc('day', ts) AS bucket, event_type AS value, count(*) AS n FROM events GROUP BY ALL")
def attack_timeline(spark, d):
    return feeds.timeline(events(spark, d), "ts", "event_type", "day")


@book.add("SELECT event_type AS value, count(*) AS n FROM events WHERE user_id % 17 = 0 GROUP BY 1")
def membership_hit_counts(spark, d):
    e = events(spark, d)
    return feeds.counts_by(detection.membership(e, e.filter("user_id % 17 = 0"), "user_id"), "event_type")


VOLUME = "(SELECT to_timestamp(floor(epoch(ts) / 3600) * 3600)::TIMESTAMP AS bucket, CASE WHEN event_type = 'error' THEN 'DoS' ELSE event_type END AS family, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL)"


def volume(spark, d):
    raw = F.when(is_error(), "DoS Hulk").otherwise(F.col("event_type"))
    return feeds.bucketed_volume(events(spark, d), "ts", labels.attack_family(raw), 3600, "value")


@book.add(f"SELECT * FROM {VOLUME}")
def bucketed_family_volume(spark, d):
    return volume(spark, d)


@book.add(f"SELECT event_id, severity FROM {GRADED} ORDER BY ts DESC, event_id LIMIT 25")
def topn_recent(spark, d):
    return feeds.top_recent(graded(spark, d), "ts", "event_id", 25).select("event_id", "severity")


@book.add(f"""WITH m AS (SELECT max(ts) AS m FROM events), r AS (SELECT event_id, severity, row_number() OVER (PARTITION BY severity ORDER BY ts DESC, event_id) AS n FROM {GRADED}, m WHERE ts > m - INTERVAL 2000 MINUTE AND severity <> 'Low')
 SELECT event_id, severity, CAST(2000 AS INTEGER) AS window_minutes FROM r WHERE n <= 4""")
def sample_stratified_bands(spark, d):
    return feeds.banded_sample(graded(spark, d), "severity", ["Critical", "High", "Medium"], "ts", "event_id", 12, 2000).select("event_id", "severity", "window_minutes")


@book.add(f"""SELECT event_id FROM (SELECT * FROM {GRADED} WHERE severity = 'Low' ORDER BY ts DESC, event_id LIMIT 10) UNION ALL SELECT event_id FROM (SELECT * FROM {GRADED} WHERE severity <> 'Low' ORDER BY ts DESC, event_id LIMIT 13)""")
def feed_quota_union(spark, d):
    g, q = graded(spark, d), feeds.feed_quotas(30)
    return feeds.quota_union([(g.filter("severity = 'Low'"), q["nominal"]), (g.filter("severity <> 'Low'"), q["ml"])], "ts", "event_id").select("event_id")


DIVERSE = f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY severity, event_type, split_part(src_ip, '.', 3) ORDER BY p DESC, event_id) AS r FROM {GRADED} WHERE severity <> 'Low'), n AS (SELECT *, row_number() OVER (PARTITION BY severity ORDER BY least(r, 2), p DESC, event_id) AS n FROM r WHERE r <= 6),
 o AS (SELECT *, CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 ELSE 2 END AS b, CASE severity WHEN 'Critical' THEN 3 WHEN 'High' THEN 2 ELSE 1 END AS q FROM n WHERE n <= 6)
 SELECT event_id, severity, CAST(row_number() OVER (ORDER BY CASE WHEN n <= q THEN 0 ELSE 1 END, b, n) AS INTEGER) AS pick FROM o QUALIFY pick <= 6"""


@book.add(DIVERSE)
def diversified_pick(spark, d):
    g = graded(spark, d)
    return feeds.diversified_pick(g, "severity", {"Critical": 3, "High": 2, "Medium": 1}, "event_type", feeds.subnet24(F.col("src_ip")), [F.desc("p")], 6, "event_id").select("event_id", "severity", "pick")


@book.add(f"SELECT src_ip AS source, event_type AS attack, printf('%.1f%%', p * 100) AS confidence FROM {GRADED} WHERE p >= 0.8")
def alert_export(spark, d):
    return feeds.alert_export(graded(spark, d).filter("p >= 0.8"), {"source": ["srcip", "src_ip"], "attack": ["attack_type", "event_type"], "confidence": ["p"]}, ("confidence",))


# -- drift --------------------------------------------------------------------------------------------------------------

HIST = f"""(WITH c AS (SELECT event_type AS key, CAST(least(19, floor(p * 20)) AS INTEGER) AS bin, count(*) AS n FROM {SQL_S} GROUP BY ALL), g AS (SELECT key, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM (SELECT DISTINCT key FROM c))
 SELECT key, bin, coalesce(n, 0) AS n, coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY key) AS share FROM g LEFT JOIN c USING (key, bin))"""
REF = f"(SELECT b.bin, coalesce(c.n, 0) / (SELECT count(*) FROM events) AS share FROM (SELECT CAST(unnest(range(0, 20)) AS INTEGER) AS bin) b LEFT JOIN (SELECT CAST(least(19, floor(p * 20)) AS INTEGER) AS bin, count(*) AS n FROM {SQL_S} GROUP BY 1) c USING (bin))"


@book.add(f"SELECT key, bin, n, round(share, 9) AS share FROM {HIST}")
def score_histogram(spark, d):
    return drift.histogram(events(spark, d), "p", "event_type").withColumn("share", F.round("share", 9))


DRIFT = f"""(WITH b AS (SELECT key, h.bin, h.share AS o, r.share AS r FROM {HIST} h JOIN {REF} r USING (bin)), x AS (SELECT key, (greatest(o, 1e-4) - greatest(r, 1e-4)) * ln(greatest(o, 1e-4) / greatest(r, 1e-4)) AS part, abs(sum(o) OVER w - sum(r) OVER w) AS gap FROM b WINDOW w AS (PARTITION BY key ORDER BY bin))
 SELECT key, round(sum(part), 6) AS psi, round(max(gap), 6) AS ks, CASE WHEN round(sum(part), 6) >= 0.5 THEN 'severe' WHEN round(sum(part), 6) >= 0.25 OR round(max(gap), 6) >= 0.15 THEN 'shift' ELSE 'stable' END AS verdict FROM x GROUP BY 1)"""


@book.add(f"SELECT * FROM {DRIFT}")
def drift_psi_ks(spark, d):
    e = events(spark, d)
    return drift.drift(drift.histogram(e, "p", "event_type"), drift.histogram(e, "p"))


@book.add(f"SELECT event_id, round(least(5.0, greatest(0.0, ln(1 / greatest(share, 1e-3)))), 6) AS novelty FROM {SQL_S} JOIN {REF} ON bin = CAST(least(19, floor(p * 20)) AS INTEGER)")
def novelty(spark, d):
    e = events(spark, d)
    return drift.novelty(e, "p", drift.histogram(e, "p")).select("event_id", "novelty")


@book.add("""WITH v AS (SELECT user_id % 5 AS k, date_trunc('day', ts) AS day, CASE WHEN avg(value) > 55 THEN 'shift' ELSE 'stable' END AS verdict FROM events GROUP BY ALL), i AS (SELECT *, sum(CASE WHEN verdict = 'stable' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY day) AS i FROM v),
 s AS (SELECT k, day, verdict, sum(CASE WHEN verdict <> 'stable' THEN 1 ELSE 0 END) OVER (PARTITION BY k, i ORDER BY day ROWS UNBOUNDED PRECEDING) AS streak FROM i) SELECT k, day, verdict, CAST(streak AS BIGINT) AS streak, streak > 0 AND streak % 3 = 0 AS act FROM s""")
def win_streak(spark, d):
    v = events(spark, d).groupBy((F.col("user_id") % 5).alias("k"), F.date_trunc("day", "ts").alias("day")).agg(F.when(F.avg("value") > 55, "shift").otherwise("stable").alias("verdict"))
    return drift.streaks(v, "k", "day", 3)


@book.add("""WITH RECURSIVE v AS (SELECT k, x, row_number() OVER (PARTITION BY k ORDER BY day) AS i FROM (SELECT user_id % 5 AS k, date_trunc('day', ts) AS day, CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY ALL)), e AS (SELECT k, i, x AS m FROM v WHERE i = 1 UNION ALL SELECT v.k, v.i, e.m + 0.1 * (v.x - e.m) FROM e JOIN v ON v.k = e.k AND v.i = e.i + 1)
 SELECT k, round(arg_max(m, i), 6) AS ema FROM e GROUP BY 1""")
def win_ema(spark, d):
    v = events(spark, d).groupBy((F.col("user_id") % 5).alias("k"), F.date_trunc("day", "ts").alias("day")).agg(F.count(F.lit(1)).alias("x"))
    return drift.ema(v, "k", "day", "x", 0.1)


@book.add("""WITH RECURSIVE v AS (SELECT event_type AS k, event_id, value AS x, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS i FROM events), e AS (SELECT k, i, event_id, x AS m FROM v WHERE i = 1 UNION ALL SELECT v.k, v.i, v.event_id, e.m + 0.05 * (v.x - e.m) FROM e JOIN v ON v.k = e.k AND v.i = e.i + 1)
 SELECT event_id, k, round(m, 4) AS ema FROM e""")
def win_ema_running(spark, d):
    """The mean after every event of its type: few keys of many rows."""
    e = events(spark, d).select(F.col("event_type").alias("k"), "event_id", "value")
    return drift.ema_running(e, "k", "event_id", "value", 0.05, digits=4).select("event_id", "k", "ema")


@book.add("""WITH v AS (SELECT event_type AS k, event_id, CASE WHEN value > 30 THEN 'shift' ELSE 'stable' END AS verdict FROM events), i AS (SELECT *, sum(CASE WHEN verdict = 'stable' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY event_id) AS i FROM v)
 SELECT event_id, k, CAST(sum(CASE WHEN verdict <> 'stable' THEN 1 ELSE 0 END) OVER (PARTITION BY k, i ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM i""")
def win_streak_rows(spark, d):
    """Runs of high values among the events of a type."""
    v = events(spark, d).select(F.col("event_type").alias("k"), "event_id", F.when(F.col("value") > 30, "shift").otherwise("stable").alias("verdict"))
    return drift.streaks(v, "k", "event_id").select("event_id", "k", "streak")


@book.add(f"SELECT r.bin, round(0.75 * r.share + 0.25 * h.share, 9) AS share FROM {REF} r JOIN (SELECT bin, share FROM {HIST} WHERE key = 'error') h USING (bin)")
def drift_reanchor(spark, d):
    e = events(spark, d)
    return drift.reanchor(drift.histogram(e, "p"), drift.histogram(e.filter(is_error()), "p")).withColumn("share", F.round("share", 9))


# -- time series --------------------------------------------------------------------------------------------------------

ENDS = "(SELECT CAST(floor(epoch(min(ts)) / 3600) AS BIGINT) AS lo, CAST(floor(epoch(max(ts)) / 3600) AS BIGINT) AS hi FROM events)"
GRID = f"(SELECT to_timestamp(3600 * t)::TIMESTAMP AS bucket FROM (SELECT unnest(range(lo, hi + 1)) AS t FROM {ENDS}))"
FRAMES = f"(SELECT unnest(range(0, (hi - lo + 1 - 16) // 8 + 1)) AS frame FROM {ENDS})"
SERIES = f"(SELECT bucket, family, coalesce(CAST(n AS DOUBLE), 0.0) AS value FROM {GRID} CROSS JOIN (SELECT DISTINCT family FROM {VOLUME}) LEFT JOIN {VOLUME} USING (bucket, family))"


def series(spark, d):
    """Hourly volumes of all families from the first to the last event."""
    return timeseries.densify(volume(spark, d), timeseries.grid_over(events(spark, d), "ts", 3600))


@book.add(f"SELECT * FROM {SERIES}")
def ts_densify(spark, d):
    return series(spark, d)


@book.add(f"""WITH t AS (SELECT bucket, sum(value) AS v FROM {SERIES} GROUP BY 1) SELECT max(v) AS peak, arg_min(bucket, (-v, bucket)) AS peak_bucket, CAST(round((epoch(max(bucket)) - epoch(arg_min(bucket, (-v, bucket)))) / 3600) AS BIGINT) AS from_end FROM t""")
def ts_aggregate_peak(spark, d):
    return timeseries.aggregate_peak(series(spark, d))


@book.add(f"""WITH p AS (SELECT family, max(value) AS peak, quantile_cont(value, 0.5) AS median, sum(value) AS volume FROM {SERIES} GROUP BY 1) SELECT family, peak, round(median, 6) AS median, round(CASE WHEN median > 0 THEN peak / median - 1 END, 6) AS surge, CAST(rank() OVER (ORDER BY volume DESC) AS INTEGER) AS rank FROM p""")
def ts_surge(spark, d):
    return timeseries.surge(series(spark, d))


@book.add(f"SELECT bucket, family, CASE WHEN total * 8 / 3600 >= 1000 THEN 'Kbps' ELSE 'bps' END AS unit FROM {VOLUME}")
def ts_bandwidth(spark, d):
    return volume(spark, d).select("bucket", "family", F.substring_index(timeseries.bandwidth(F.col("total"), 3600), " ", -1).alias("unit"))


@book.add(f"SELECT a.family AS x, b.family AS y, round(corr(a.value, b.value), 6) AS r FROM {SERIES} a JOIN {SERIES} b ON a.bucket = b.bucket AND a.family < b.family GROUP BY ALL")
def ts_pearson(spark, d):
    return timeseries.pearson(series(spark, d))


LAG = f"""(WITH s AS (SELECT CAST(epoch(bucket) / 3600 AS BIGINT) AS t, family, value FROM {SERIES}), l AS (SELECT a.family AS x, b.family AS y, b.t - a.t AS lag, round(corr(a.value, b.value), 9) AS r FROM s a JOIN s b ON a.family < b.family AND b.t - a.t BETWEEN -15 AND 15 GROUP BY ALL)
 SELECT x, y, CAST(arg_min(lag, (-r, abs(lag), lag)) AS INTEGER) AS lag, round(max(r), 6) AS r FROM l GROUP BY ALL)"""


@book.add(f"SELECT * FROM {LAG}")
def ts_best_lag(spark, d):
    return timeseries.best_lag(timeseries.lag_correlation(series(spark, d), 3600))


@book.add(f"""SELECT x, y, lag, r, CASE WHEN lag > 0 THEN printf('%s leads %s by %d s', x, y, abs(lag) * 3600) WHEN lag < 0 THEN printf('%s trails %s by %d s', x, y, abs(lag) * 3600) ELSE printf('%s and %s move together', x, y) END AS sentence FROM {LAG} WHERE abs(r) >= 0.1""")
def ts_narrative(spark, d):
    return timeseries.narrative(ts_best_lag(spark, d), 3600, 0.1)


@book.add(f"""WITH s AS (SELECT *, abs(value - lag(value) OVER (PARTITION BY family ORDER BY bucket)) AS d, row_number() OVER (PARTITION BY family ORDER BY value DESC, bucket) AS k FROM {SERIES}),
 p AS (SELECT family, avg(value) AS m, stddev_pop(value) AS s, avg(CASE WHEN d IS NULL THEN NULL WHEN d = 0 THEN 1.0 ELSE 0.0 END) AS flat, avg(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) AS active, sum(CASE WHEN k <= 3 THEN value ELSE 0 END) / nullif(sum(value), 0) AS top3 FROM s GROUP BY 1), c AS (SELECT *, CASE WHEN m > 0 THEN s / m ELSE 0 END AS cv FROM p)
 SELECT family, round(cv, 6) AS cv, round(flat, 6) AS flat, round(active, 6) AS active, round(top3, 6) AS top3, CASE WHEN m = 0 THEN 'silent' WHEN top3 > 0.6 AND active < 0.3 THEN 'burst' WHEN cv < 0.35 THEN 'steady' WHEN flat > 0.6 THEN 'stepped' WHEN cv > 1.2 THEN 'spiky' ELSE 'variable' END AS shape FROM c""")
def ts_classify_shape(spark, d):
    return timeseries.shape(series(spark, d))


@book.add(f"""WITH s AS (SELECT family, value, CAST(epoch(bucket) / 3600 AS BIGINT) - min(CAST(epoch(bucket) / 3600 AS BIGINT)) OVER (PARTITION BY family) AS i FROM {SERIES}), f AS (SELECT family, value, frame, i - frame * 8 AS k FROM s, {FRAMES} WHERE i >= frame * 8 AND i < frame * 8 + 16),
 x AS (SELECT family, frame, k, (value - avg(value) OVER (PARTITION BY family, frame)) * (0.5 - 0.5 * cos(2 * pi() * k / 15)) AS x FROM f), m AS (SELECT family, frame, b AS bin, sqrt(power(sum(x * cos(2 * pi() * b / 16 * k)), 2) + power(sum(x * sin(2 * pi() * b / 16 * k)), 2)) AS m FROM x, (SELECT CAST(unnest(range(0, 9)) AS INTEGER) AS b) GROUP BY ALL),
 q AS (SELECT *, max(m) OVER (PARTITION BY family) AS peak FROM m) SELECT family, CAST(frame AS BIGINT) AS frame, bin, round(20 * log10(greatest(m, peak * 1e-6) / peak), 4) AS db FROM q""")
def ts_stft(spark, d):
    return timeseries.stft(series(spark, d), 3600)
