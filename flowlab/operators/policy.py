"""Decision policy: scores to graded, routed alerts, and the roll-up of alerts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions import scores
from flowlab.functions.fingerprint import md5_share
from flowlab.functions.labels import verdict


@dataclass(frozen=True)
class Thresholds:
    """An operating point. The defaults."""

    attack: float = 0.5
    bot: float = 0.5
    critical: float = 0.85
    high: float = 0.7
    medium: float = 0.5
    bot_train_prior: float = 0.5
    bot_deploy_prior: float = 0.05
    correct_prior: bool = False
    bot_route_most: float | None = None
    suppress_infiltration: bool = True


UNCLASSIFIED = "Attack (unclassified)"


def classify_flow(p_attack: Column, p_bot: Column, hint: Column, th: Thresholds = Thresholds()) -> Column:
    """struct<alert,attack_type,severity,confidence,p_bot,bot_routed,auto_alert,review_reason>; below the gate alert is false
    and the rest null. The hint only names an alert, it never makes one."""
    alert = scores.above(p_attack, th.attack)
    routed = p_bot.isNotNull() & ~F.isnan(p_bot) & (F.lit(True) if th.bot_route_most is None else p_attack <= th.bot_route_most)
    bot = F.when(routed, scores.rebase(p_bot, th.bot_train_prior, th.bot_deploy_prior) if th.correct_prior else p_bot)
    text = F.trim(F.coalesce(hint, F.lit("")))
    named = (text != "") & ~F.upper(text).isin("BENIGN", "NORMAL", "ATTACK")
    kind = F.when(F.coalesce(bot >= th.bot, F.lit(False)), "Bot").when(named, text).otherwise(UNCLASSIFIED)
    held = F.lit(th.suppress_infiltration) & (kind == "Infiltration")
    return F.struct(
        alert.alias("alert"), F.when(alert, kind).alias("attack_type"), F.when(alert, scores.severity(p_attack, th.critical, th.high, th.medium)).alias("severity"), F.when(alert, p_attack).alias("confidence"),
        F.when(alert, bot).alias("p_bot"), F.when(alert, routed).alias("bot_routed"), F.when(alert, ~held).alias("auto_alert"), F.when(alert & held, F.lit("infiltration_label_suppressed")).alias("review_reason"),
    )


def classified(df: DataFrame, p_attack: str, p_bot: str, hint: str, th: Thresholds = Thresholds()) -> DataFrame:
    """The alerts among the rows of df, with the fields of `classify_flow`."""
    return df.withColumn("_v", classify_flow(F.col(p_attack), F.col(p_bot), F.col(hint), th)).filter("_v.alert").select(*[F.col(f"`{c}`") for c in df.columns if c != p_bot], "_v.*").drop("alert")


def route(alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(automatic, for review)"""
    return alerts.filter("auto_alert"), alerts.filter("not auto_alert")


def mirror_nominal(df: DataFrame, score: str, cut: float, key: str, share: float) -> DataFrame:
    """A repeatable sample of the rows that the gate rejects, tagged."""
    return df.filter(~scores.above(F.col(score), cut) & (md5_share(F.col(key), "nominal") < share)).withColumn("tag", F.lit("nominal"))


def validate_feedback(df: DataFrame, verdict_column: str, score: str) -> DataFrame:
    """df with polarity (1, 0 or null) and reject_reason (null if usable)."""
    polarity = verdict(F.col(verdict_column))
    p = F.col(score)
    reason = F.when(polarity.isNull(), "unusable verdict").when(p.isNull() | F.isnan(p) | (p < 0) | (p > 1), "score outside [0, 1]")
    return df.withColumn("polarity", polarity).withColumn("reject_reason", reason)


def alert_rollup(alerts: DataFrame, keys: list[str], dst: str, order: str, confidence: str, time: str, most: int = 10) -> DataFrame:
    """One row per key: flow_count, dst_count (all distinct), dsts (the first `most` seen, in order), first_seen, last_seen, and
    the strongest row's destination and confidence.

    Destinations are reduced per (key, destination) before they meet, and null or non-numeric confidence counts as 0."""
    conf = F.coalesce(F.when(~F.isnan(F.col(confidence).try_cast("double")), F.col(confidence).try_cast("double")), F.lit(0.0))
    by_dst = alerts.groupBy(*keys, F.col(dst).alias("_dst")).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("first"), F.min(time).alias("t0"), F.max(time).alias("t1"), F.max(F.struct(conf.alias("c"), (-F.col(order)).alias("o"))).alias("best")
    )
    plain = by_dst.groupBy(*keys).agg(
        F.sum("n").alias("flow_count"), F.count("_dst").alias("dst_count"), F.min("t0").alias("first_seen"), F.max("t1").alias("last_seen"), F.max_by("_dst", "best").alias("top_dst"), F.max("best.c").alias("max_confidence"),
    )
    # ranks are cut to `most` in every part of a key's destinations, then over its parts
    part = F.pmod(F.xxhash64("_dst"), F.lit(64))
    top = lambda df, *by: df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, *by).orderBy("first", "_dst"))).filter(F.col("_rank") <= most)
    heads = top(top(by_dst.filter(F.col("_dst").isNotNull()).select(*keys, "_dst", "first").withColumn("_part", part), "_part"))
    seen = heads.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.transform(F.sort_array(F.collect_list(F.struct("first", "_dst"))), lambda x: x["_dst"]).alias("dsts"))
    both = plain.join(seen, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)], "left")
    return both.select(*keys, "flow_count", "dst_count", F.coalesce("dsts", F.array().cast(f"array<{dict(alerts.dtypes)[dst]}>")).alias("dsts"), "first_seen", "last_seen", "top_dst", "max_confidence")


def rules_infiltration(duration: Column, rate: Column, port: Column, fwd: Column, bwd: Column) -> Column:
    """1 where one of three rules on log-scaled flows holds. 17.92, 6.21, 3.0 and the ports."""
    long = duration >= 17.92
    slow, known, lopsided = rate <= 6.21, port.cast("int").isin(80, 443, 8080, 8443, 3389, 22, 21, 25, 53), bwd / F.greatest(fwd, F.lit(1.0)) >= 3.0
    return F.when(long & (slow | known | lopsided), 1).otherwise(0)


def rule_override(label: Column, rule: Column, benign: str = "BENIGN", target: str = "Infiltration") -> Column:
    return F.when((label == benign) & (rule == 1), target).otherwise(label)


def tiered(p_class: Column, name: Column, p_bot: Column, rule: Column, cluster_label: Column, cluster_purity: Column) -> Column:
    """The first tier that is sure: the classifier above .80, the bot specialist above .50, the rules, a pure cluster; else Unknown."""
    return F.coalesce(F.when(p_class > 0.8, name), F.when(p_bot > 0.5, "Bot"), F.when(rule == 1, "Infiltration"), F.when(cluster_purity > 0.8, cluster_label), F.lit("Unknown"))


def ip_reputation(keys: DataFrame, key: str, listed: DataFrame, attackers: DataFrame) -> DataFrame:
    """For all keys at once: whether listed, whether an attacker in the graph (with its danger), and the verdict."""
    l = listed.select(key).distinct().withColumn("listed", F.lit(True))
    a = attackers.select(key, "danger").groupBy(key).agg(F.max("danger").alias("danger"))
    out = keys.select(key).distinct().join(l, key, "left").join(a, key, "left")
    return out.select(key, F.coalesce("listed", F.lit(False)).alias("listed"), F.col("danger").isNotNull().alias("attacker"), F.coalesce("danger", F.lit(0.0)).alias("danger")).withColumn(
        "verdict", F.when(F.col("listed") | F.col("attacker"), "malicious").otherwise("unknown")
    )
