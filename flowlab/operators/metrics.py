"""Evaluation of scored rows: confusion, sweeps, cuts at target rates, rank AUC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions.scores import above
from flowlab.operators.quantiles import exact_quantiles, pivoted, range_parts


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_cells(df: DataFrame, **flags: Column) -> DataFrame:
    """Counts by every combination of boolean flags, one job."""
    return df.groupBy(*[c.alias(n) for n, c in flags.items()]).agg(F.count(F.lit(1)).alias("n"))


def miss_breakdown(df: DataFrame, label: str, prediction: str, target: str, k: int = 5) -> DataFrame:
    """What rows of one class were taken for instead, with their share of the misses."""
    missed = df.filter((F.col(label) == target) & (F.col(prediction) != target)).groupBy(F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    return missed.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6)).orderBy(F.desc("n"), "prediction").limit(k)


def per_class_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("support"), F.count_if(F.col(label) == F.col(prediction)).alias("correct")).withColumn("recall", F.round(F.col("correct") / F.col("support"), 6))


def per_class_score(df: DataFrame, label: str, score: str, cut: float) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(score), 6).alias("mean_score"), F.round(F.avg(above(F.col(score), cut).cast("double")), 6).alias("flagged"))


def per_class_prf(confusion: DataFrame) -> DataFrame:
    """precision, recall, F1 and support of each class from its confusion counts."""
    long = confusion.select(
        F.explode(F.array(F.struct(F.col("label").alias("c"), F.col("n").alias("s"), F.lit(0).alias("p")), F.struct(F.col("prediction").alias("c"), F.lit(0).alias("s"), F.col("n").alias("p")))).alias("x"),
        (F.col("label") == F.col("prediction")).alias("hit"),
    )
    per = long.groupBy(F.col("x.c").alias("label")).agg(F.sum("x.s").alias("support"), F.sum("x.p").alias("predicted"), F.sum(F.when(F.col("hit"), F.col("x.s")).otherwise(0)).alias("correct"))
    p, r = F.col("correct") / F.nullif(F.col("predicted"), F.lit(0)), F.col("correct") / F.nullif(F.col("support"), F.lit(0))
    zero = F.lit(0.0)
    f1 = 2 * F.col("correct") / F.nullif(F.col("predicted") + F.col("support"), F.lit(0))
    return per.select("label", "support", F.round(F.coalesce(p, zero), 6).alias("precision"), F.round(F.coalesce(r, zero), 6).alias("recall"), F.round(F.coalesce(f1, zero), 6).alias("f1"))


EVALUATION = "n bigint, accuracy double, classes array<struct<label:string,support:bigint,precision:double,recall:double,f1:double,predicted:map<string,bigint>>>"


def evaluation(confusion: DataFrame) -> DataFrame:
    """One nested row from confusion counts: n, accuracy, and the classes by name, each with its metrics and a map of what it was predicted as. As many
    entries as there are classes, squared at most."""
    total = confusion.agg(F.sum("n").alias("n"), F.round(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("accuracy"))
    said = confusion.filter(F.col("prediction").isNotNull()).groupBy(F.col("label").alias("c_label")).agg(F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("predicted"))
    rows = per_class_prf(confusion).join(said, F.col("label") == F.col("c_label"), "left")
    fields = F.struct("label", "support", "precision", "recall", "f1", "predicted")
    classes = rows.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("label").alias("by"), fields.alias("c"))), lambda a, b: F.when(a["by"] < b["by"], -1).when(a["by"] > b["by"], 1).otherwise(0)), lambda x: x["c"]).alias("classes"))
    return total.join(F.broadcast(classes), how="cross")  # one row each


def multiclass_metrics(confusion: DataFrame) -> DataFrame:
    """One row from confusion counts (label, prediction, n): accuracy, macro F1, and precision, recall and F1 weighted by support."""
    total = confusion.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("correct"))
    prf = per_class_prf(confusion)
    weighted = lambda c: F.round(F.sum(F.col(c) * F.col("support")) / F.nullif(F.sum("support"), F.lit(0)), 6).alias(f"weighted_{c}")
    classes = prf.filter("support > 0").agg(F.count(F.lit(1)).alias("classes"), F.round(F.avg("f1"), 6).alias("macro_f1"), weighted("precision"), weighted("recall"), weighted("f1"))
    # each side is one row
    return total.join(classes, how="cross").withColumn("accuracy", F.round(F.col("correct") / F.nullif(F.col("n"), F.lit(0)), 6))


def macro_scores(prf: DataFrame) -> DataFrame:
    return prf.agg(F.round(F.avg("f1"), 6).alias("macro_f1"), F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), 6).alias("weighted_f1"))


def score_counts(df: DataFrame, score: str, truth: Column) -> DataFrame:
    """(score, pos, neg) of each distinct score: all that sweeps, cuts and AUC need."""
    return df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score))).groupBy(F.col(score).alias("score")).agg(F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg"))


def threshold_sweep(df: DataFrame, score: str, truth: Column, cuts: list[float]) -> DataFrame:
    """Per cut: alerts, tp, fp, fpr, recall, precision. One pass: each row adds to the steps that its score reaches."""
    rows = df.select(F.col(score).alias("s"), truth.alias("t"))
    counts = [F.count_if(above(F.col("s"), c) & F.col("t")).alias(f"tp{i}") for i, c in enumerate(cuts)] + [F.count_if(above(F.col("s"), c) & ~F.col("t")).alias(f"fp{i}") for i, c in enumerate(cuts)]
    one = rows.agg(*counts, F.count_if("t").alias("p"), F.count_if(~F.col("t")).alias("n"))
    steps = F.array(*[F.struct(F.lit(float(c)).alias("cut"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp")) for i, c in enumerate(cuts)])
    alerts = F.col("tp") + F.col("fp")
    return one.select(F.inline(steps), "p", "n").select(
        "cut", alerts.alias("alerts"), "tp", "fp", F.round(F.col("fp") / F.nullif(F.col("n"), F.lit(0)), 6).alias("fpr"), F.round(F.col("tp") / F.nullif(F.col("p"), F.lit(0)), 6).alias("recall"), F.round(F.col("tp") / F.nullif(alerts, F.lit(0)), 6).alias("precision")
    )


def cut_for_fpr(benign: DataFrame, score: str, rates: list[float]) -> DataFrame:
    """(fpr, cut): the exact quantile of benign scores at 1 - fpr, interpolated."""
    cuts = exact_quantiles(benign, [], score, [1 - r for r in rates])
    return cuts.select(F.element_at(F.array(*[F.lit(float(r)) for r in rates]), F.col("i") + 1).alias("fpr"), F.round("quantile", 6).alias("cut"))


def severity_ladder(benign: DataFrame, score: str, fpr: float) -> DataFrame:
    """One row: the cuts at fpr, fpr / 2 and fpr / 10."""
    names = ["medium", "high", "critical"]
    return pivoted(exact_quantiles(benign, [], score, [1 - fpr, 1 - fpr / 2, 1 - fpr / 10]), [], names).select(*[F.round(n, 6).alias(n) for n in names])


def matched_fpr_compare(df: DataFrame, scores: list[str], label: str, benign: str, fpr: float) -> DataFrame:
    """(version, cut, label, n, flagged, rate): versions compared at the same benign false-positive rate."""
    long = df.filter(F.col(label) == benign).select(*[F.col(s).cast("double").alias(s) for s in scores]).unpivot([], scores, "version", "score")
    cuts = dict.fromkeys(scores) | {r["version"]: r["quantile"] for r in exact_quantiles(long, ["version"], "score", [1 - fpr]).collect()}  # a row for each version
    per = [F.count_if(above(F.col(s), cuts[s])).alias(s) for s in scores if cuts[s] is not None]
    one = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), *per)
    rows = F.array(*[F.struct(F.lit(s).alias("version"), F.round(F.lit(cuts[s]), 6).alias("cut"), F.col(s).alias("flagged")) for s in scores if cuts[s] is not None])
    return one.select("label", "n", F.inline(rows)).withColumn("rate", F.round(F.col("flagged") / F.col("n"), 6))


def compare_at_cut(df: DataFrame, left: str, right: str, label: str, cut: float) -> DataFrame:
    """Flagged rate of two versions per label at a fixed cut, the difference and which is higher."""
    rate = lambda s: F.round(F.avg(above(F.col(s), cut).cast("double")), 6)
    out = df.groupBy(F.col(label).alias("label")).agg(rate(left).alias("left_rate"), rate(right).alias("right_rate"))
    delta = F.round(F.col("right_rate") - F.col("left_rate"), 6)
    return out.withColumn("delta", delta).withColumn("mark", F.when(delta > 0, "up").when(delta < 0, "down").otherwise("same"))


def best_cut(sweep: DataFrame, least_precision: float, least_recall: float, default: float) -> DataFrame:
    """One row: the cut with the greatest F1 among those above both floors (ties to the lower cut), else the default."""
    f1 = 2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))
    fit = sweep.filter((F.col("precision") >= least_precision) & (F.col("recall") >= least_recall)).agg(F.max(F.struct(f1.alias("f"), (-F.col("cut")).alias("c"))).alias("m"))
    return fit.select(F.coalesce(-F.col("m.c"), F.lit(float(default))).alias("cut"), F.round("m.f", 6).alias("f1"), F.col("m").isNotNull().alias("met"))


def gated_recall(df: DataFrame, gate: Column, specialist: Column, truth: Column) -> DataFrame:
    """How many true rows pass the gate, the specialist, and both; and what both let through wrongly."""
    return df.agg(
        F.count_if(truth).alias("positives"), F.count_if(truth & gate).alias("gate"), F.count_if(truth & specialist).alias("specialist"), F.count_if(truth & gate & specialist).alias("both"),
        F.count_if(~truth & gate & specialist).alias("false_both"), F.count_if(~truth).alias("negatives"),
    ).withColumn("recall", F.round(F.col("both") / F.nullif(F.col("positives"), F.lit(0)), 6)).withColumn("fpr", F.round(F.col("false_both") / F.nullif(F.col("negatives"), F.lit(0)), 6))


def open_set_reject(df: DataFrame, probabilities: Column, label: str, cuts: list[float]) -> DataFrame:
    """Per cut and label: rows whose best class reaches the cut (kept) or not (unknown)."""
    top = F.array_max(probabilities)
    one = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(above(top, c)).alias(f"k{i}") for i, c in enumerate(cuts)])
    rows = F.array(*[F.struct(F.lit(float(c)).alias("cut"), F.col(f"k{i}").alias("kept")) for i, c in enumerate(cuts)])
    return one.select("label", "n", F.inline(rows)).withColumn("coverage", F.round(F.col("kept") / F.col("n"), 6))


def rank_auc(df: DataFrame, features: list[str], truth: Column) -> DataFrame:
    """(feature, auc, flagged): Mann-Whitney AUC of every feature alone, ties at half weight; null without both classes.

    Rows are counted by (feature, value) before anything is ordered, so what is ranked grows with distinct values."""
    long = df.select(truth.alias("t"), *[F.col(f"`{f}`").cast("double").alias(f) for f in features]).unpivot(["t"], features, "feature", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count_if("t").alias("pos"), F.count_if(~F.col("t")).alias("neg"))
    # running sums inside parts of a feature's values, then over its parts
    placed = range_parts(counts, ["feature"], "value", "part")
    ahead = lambda c, *by: F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy("part" if len(by) == 1 else "value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = placed.groupBy("feature", "part").agg(F.sum("neg").alias("m")).select("feature", "part", ahead("m", "feature").alias("base"))
    inside = placed.withColumn("within", ahead("neg", "feature", "part"))
    wins = inside.join(bases, ["feature", "part"]).withColumn("w", F.col("pos") * (F.col("base") + F.col("within") + F.col("neg") / 2))
    auc = F.sum("w") / F.nullif(F.sum("pos").cast("double") * F.sum("neg"), F.lit(0.0))
    return wins.groupBy("feature").agg(F.round(auc, 6).alias("auc")).withColumn("flagged", F.greatest(F.col("auc"), 1 - F.col("auc")) > 0.8)


def binary_metrics(df: DataFrame, score: str, truth: Column, cut: float) -> DataFrame:
    """Accuracy, precision, recall, F1 at the cut from one aggregation."""
    hit = above(F.col(score), cut)
    one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit & truth).alias("tp"), F.count_if(hit & ~truth).alias("fp"), F.count_if(~hit & truth).alias("fn"), F.count_if(~hit & ~truth).alias("tn"))
    return one.withColumns({
        "accuracy": F.round((F.col("tp") + F.col("tn")) / F.nullif(F.col("n"), F.lit(0)), 6), "precision": F.round(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), 6),
        "recall": F.round(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)), 6), "f1": F.round(2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), 6),
    })


def outcome_feature_means(df: DataFrame, features: list[str], score: str, truth: Column, cut: float) -> DataFrame:
    """Means of each feature over false positives and true negatives, their ratio, and whether it is beyond 3 or 1/3."""
    fp, tn = above(F.col(score), cut) & ~truth, ~above(F.col(score), cut) & ~truth
    one = df.agg(*[F.avg(F.when(c, F.col(f"`{f}`"))).alias(f"{k}|{f}") for f in features for k, c in (("fp", fp), ("tn", tn))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`fp|{f}`").alias("fp_mean"), F.col(f"`tn|{f}`").alias("tn_mean")) for f in features])
    ratio = F.col("fp_mean") / F.nullif(F.col("tn_mean"), F.lit(0.0))
    return one.select(F.inline(rows)).select("feature", F.round("fp_mean", 6).alias("fp_mean"), F.round("tn_mean", 6).alias("tn_mean"), F.round(ratio, 6).alias("ratio"), F.coalesce((ratio > 3) | (ratio < 0.33), F.lit(False)).alias("flagged"))


def hourly_fpr(df: DataFrame, ts: str, score: str, truth: Column, cut: float) -> DataFrame:
    hit = above(F.col(score), cut)
    return df.filter(~truth).groupBy(F.hour(F.col(ts)).alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("fp")).withColumn("fpr", F.round(F.col("fp") / F.col("n"), 6))


def fp_cost(sweep: DataFrame, minutes_each: float = 10.0, cost_per_hour: float = 50.0) -> DataFrame:
    hours = F.col("fp") * minutes_each / 60
    return sweep.select("cut", "fp", F.round(hours, 6).alias("hours"), F.round(hours * cost_per_hour, 6).alias("cost"))


def cluster_composition(df: DataFrame, cluster: str, label: str, benign: str) -> DataFrame:
    """Per cluster: size, dominant label (ties to the smaller), purity, share of attacks, number of labels."""
    counts = df.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("cluster").agg(
        F.sum("n").alias("size"), F.min_by("label", F.struct((-F.col("n")).alias("n"), F.col("label"))).alias("dominant"), F.round(F.max("n") / F.sum("n"), 6).alias("purity"),
        F.round(F.sum(F.when(F.col("label") != benign, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("attack_share"), F.count(F.lit(1)).alias("labels"),
    )


def cluster_purity(composition: DataFrame) -> DataFrame:
    """Mean purity of clusters, plain and weighted by size."""
    return composition.agg(F.round(F.avg("purity"), 6).alias("mean_purity"), F.round(F.sum(F.col("purity") * F.col("size")) / F.sum("size"), 6).alias("weighted_purity"))
