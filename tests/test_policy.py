import pytest
from flowlab.functions import labels, scores
from flowlab.operators import policy
from pyspark.sql import functions as F

PAIR = "p double, b double, hint string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_logit_and_rebasing(spark):
    for p in (0.001, 0.3, 0.5, 0.97):
        assert abs(one(spark, scores.sigmoid(scores.logit(F.lit(p)))) - p) < 1e-9
    assert abs(one(spark, scores.logit(F.lit(0.0)))) < 100 and abs(one(spark, scores.logit(F.lit(1.0)))) < 100
    assert one(spark, scores.rebase(F.lit(0.5), 0.5, 0.05)) == pytest.approx(0.05)
    assert one(spark, scores.rebase(F.lit(0.95), 0.5, 0.05)) == pytest.approx(0.5)
    assert one(spark, scores.rebase(F.lit(0.37), 0.2, 0.2)) == pytest.approx(0.37)
    assert one(spark, scores.rebase_inverse(scores.rebase(F.lit(0.37), 0.5, 0.05), 0.5, 0.05)) == pytest.approx(0.37)


def test_gate_is_inclusive_and_never_alerts_on_nothing(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,), (None,), (float("nan"),)], "p double")
    assert [r["a"] for r in df.select(scores.above(F.col("p"), 0.5).alias("a")).collect()] == [True, False, False, False]


def test_severity_ladders(spark):
    df = spark.createDataFrame([(0.99,), (0.85,), (0.70,), (0.50,), (0.10,)], "p double")
    th = policy.Thresholds()
    assert [r["s"] for r in df.select(scores.severity(F.col("p"), th.critical, th.high, th.medium).alias("s")).collect()] == ["Critical", "Critical", "High", "Medium", "Low"]
    n = spark.createDataFrame([(199,), (200,), (499,), (500,)], "n int")
    assert [r["s"] for r in n.select(scores.spike_severity(F.col("n")).alias("s")).collect()] == ["Medium", "High", "High", "Critical"]


def classify(spark, rows, **th):
    df = spark.createDataFrame(rows, PAIR)
    return [r["v"] for r in df.select(policy.classify_flow(F.col("p"), F.col("b"), F.col("hint"), policy.Thresholds(**th)).alias("v")).collect()]


def test_bot_routing(spark):
    v = classify(spark, [(0.9, 0.5, "DDoS"), (0.9, 0.49, "DDoS"), (0.9, None, "DDoS"), (0.2, 0.9, "DDoS")])
    assert [x["attack_type"] for x in v] == ["Bot", "DDoS", "DDoS", None] and [x["bot_routed"] for x in v] == [True, True, False, None]
    gated = classify(spark, [(0.78, 0.9, "DDoS"), (0.95, 0.9, "DDoS")], bot_route_most=0.80)
    assert [x["attack_type"] for x in gated] == ["Bot", "DDoS"]
    assert classify(spark, [(0.9, 0.94, ""), (0.9, 0.951, "")], correct_prior=True)[0]["attack_type"] == policy.UNCLASSIFIED


def test_hints_and_suppression(spark):
    v = classify(spark, [(0.9, None, h) for h in ("BENIGN", " ", None, "attack", "Infiltration", " XSS ")])
    assert [x["attack_type"] for x in v] == [policy.UNCLASSIFIED] * 4 + ["Infiltration", "XSS"]
    assert (v[4]["auto_alert"], v[4]["review_reason"], v[4]["severity"], v[4]["confidence"]) == (False, "infiltration_label_suppressed", "Critical", 0.9)
    assert classify(spark, [(0.9, 0.9, "Infiltration")])[0]["auto_alert"] is True
    assert classify(spark, [(0.9, None, "Infiltration")], suppress_infiltration=False)[0]["auto_alert"] is True


def test_verdicts(spark):
    rows = [("confirmed", 1), ("FALSE-POSITIVE", 0), ("1", 1), ("maybe", None), (None, None), ("True Positive", 1), ("0.2", 0)]
    got = spark.createDataFrame(rows, "v string, want int").select("want", labels.verdict(F.col("v")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_label_keys(spark):
    df = spark.createDataFrame([("Web Attack � XSS",), (" Benign",), ("DDOS HOIC",), ("Infilteration",), (" Strange One ",), (None,)], "l string")
    assert [r["x"] for r in df.select(labels.normalise_label(F.col("l")).alias("x")).collect()] == ["Web Attack - XSS", "BENIGN", "DDoS", "Infiltration", "Strange One", None]


ALERT = "id bigint, src string, kind string, sev string, dst string, conf string, t string"


def rollup(spark, rows, most=10):
    return policy.alert_rollup(spark.createDataFrame(rows, ALERT), ["src", "kind", "sev"], "dst", "id", "conf", "t", most).collect()


def test_rollup_collapses_volume(spark):
    r = rollup(spark, [(i, "a", "DDoS", "High", f"d{i % 50}", "0.9", f"{i:05d}") for i in range(5000)])
    assert len(r) == 1 and (r[0]["flow_count"], r[0]["dst_count"], len(r[0]["dsts"])) == (5000, 50, 10)
    assert r[0]["dsts"] == [f"d{i}" for i in range(10)] and (r[0]["first_seen"], r[0]["last_seen"]) == ("00000", "04999")


def test_rollup_keys_strongest_and_malformed(spark):
    rows = [(1, "a", "x", "High", "d1", "0.5", "1"), (2, "a", "x", "High", "d2", "0.9", "2"), (3, "a", "y", "High", "d1", None, "3"), (4, "b", "x", "High", None, "text", "4"), (5, None, None, None, None, "NaN", None)]
    r = {(x["src"], x["kind"]): x for x in rollup(spark, rows, 5)}
    assert sum(x["flow_count"] for x in r.values()) == 5
    assert (r["a", "x"]["top_dst"], r["a", "x"]["max_confidence"], r["a", "x"]["dsts"]) == ("d2", 0.9, ["d1", "d2"])
    assert (r["b", "x"]["dst_count"], r["b", "x"]["dsts"], r["b", "x"]["max_confidence"]) == (0, [], 0.0)
    wide = rollup(spark, [(i, "a", "x", "High", f"d{i}", "0.5", str(i)) for i in range(200)], 5)[0]
    assert (wide["dst_count"], len(wide["dsts"])) == (200, 5)


def test_rules_and_tiers(spark):
    df = spark.createDataFrame([(18.0, 6.0, 5.0, 1.0, 1.0), (18.0, 9.0, 443.0, 1.0, 1.0), (18.0, 9.0, 5.0, 1.0, 3.0), (17.0, 1.0, 443.0, 1.0, 9.0)], "d double, r double, p double, f double, b double")
    assert [r["x"] for r in df.select(policy.rules_infiltration(*(F.col(c) for c in "drpfb")).alias("x")).collect()] == [1, 1, 1, 0]
    lit = F.lit
    assert one(spark, policy.tiered(lit(0.8), lit("DDoS"), lit(0.5), lit(0), lit("C"), lit(0.9))) == "C"
    assert one(spark, policy.tiered(lit(0.81), lit("DDoS"), lit(0.9), lit(1), lit("C"), lit(0.9))) == "DDoS"
    assert one(spark, policy.tiered(lit(None).cast("double"), lit("DDoS"), lit(None).cast("double"), lit(0), lit("C"), lit(0.8))) == "Unknown"
