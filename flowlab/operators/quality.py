"""Audits of labelled tables. Every audit is one wide aggregation or one shuffle, and its report is a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions.fingerprint import fingerprint_hash
from flowlab.operators import heavy
from flowlab.operators.joins import sized
from flowlab.operators.quantiles import exact_quantiles, pivoted


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """label, n, pct. The total is a window over as many rows as there are labels."""
    counts = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def imbalance_summary(df: DataFrame, label: str, benign: str) -> DataFrame:
    return df.agg(F.count_if(col(label) == benign).alias("benign"), F.count_if(~col(label).eqNullSafe(F.lit(benign))).alias("attack")).withColumn(
        "ratio", F.when(F.col("attack") > 0, F.round(F.col("benign") / F.col("attack"), 6))
    )


def rarest(df: DataFrame, label: str, k: int) -> DataFrame:
    return df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy("n", "label").limit(k)


def file_label_frequency(df: DataFrame, source: str, label: str) -> DataFrame:
    """(source, label, n) with totals: label null sums a source, both null sum the table."""
    return df.rollup(col(source).alias("source"), col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def label_scan_many(parts: dict[str, DataFrame], label: str, marker: str) -> DataFrame:
    """Label counts of several datasets, with whether the label matches a pattern."""
    frames = [p.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).withColumn("dataset", F.lit(n)) for n, p in parts.items()]
    return reduce(DataFrame.unionByName, frames).withColumn("marked", F.coalesce(F.col("label").rlike(marker), F.lit(False)))


def feature_summary(df: DataFrame, features: list[str], by: str) -> DataFrame:
    """n, mean, population deviation, min, quartiles, p95 and max of each feature and group; exact interpolated quantiles."""
    long = df.select(col(by).alias("source"), *[col(f).cast("double").alias(f) for f in features]).unpivot(["source"], features, "feature", "value").filter(F.col("value").isNotNull())
    by, names = ["source", "feature"], ["p25", "median", "p75", "p95"]
    plain = long.groupBy(*by).agg(F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 6).alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    ranked = pivoted(exact_quantiles(long, by, "value", [0.25, 0.5, 0.75, 0.95]), by, names).withColumnsRenamed({c: f"_{c}" for c in by})
    both = plain.join(ranked, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return both.select(*by, "n", "mean", "std", "min", *[F.round(c, 6).alias(c) for c in names], "max")


def ratio_tag(ratio: Column) -> Column:
    size = F.abs(ratio)
    worst = F.when(size > 1000, ">1000x").when(size > 100, ">100x").when(size > 10, ">10x")
    small = F.when((size < 0.001) & (size > 0), ">1000x").when((size < 0.01) & (size > 0), ">100x").when((size < 0.1) & (size > 0), ">10x")
    return F.coalesce(worst, small, F.lit("ok"))


def scale_ratio_report(df: DataFrame, features: list[str], by: str, left: str, right: str) -> DataFrame:
    """Ratio of a feature's means between two sources, with a tag for its size."""
    means = df.agg(*[F.avg(F.when(col(by) == s, col(f))).alias(f"{side}|{f}") for f in features for side, s in (("l", left), ("r", right))])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`l|{f}`").alias("left_mean"), F.col(f"`r|{f}`").alias("right_mean")) for f in features])
    ratio = F.when(F.col("right_mean") != 0, F.col("left_mean") / F.col("right_mean"))
    return means.select(F.inline(rows)).select(
        "feature", F.round("left_mean", 6).alias("left_mean"), F.round("right_mean", 6).alias("right_mean"), F.round(ratio, 6).alias("ratio"), F.when(ratio.isNull(), "no base").otherwise(ratio_tag(ratio)).alias("tag")
    )


def zero_variance_scan(df: DataFrame, features: list[str], by: str, tolerance: float = 1e-9, ddof: int = 0) -> DataFrame:
    """Per group and feature: deviation, mean, share of zeros, and whether the feature is constant there."""
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    long = df.select(col(by).alias("label"), *[col(f).cast("double").alias(f) for f in features]).unpivot(["label"], features, "feature", "value")
    out = long.groupBy("label", "feature").agg(
        F.round(spread("value"), 6).alias("std"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.count_if(F.col("value") == 0) / F.count(F.lit(1)), 6).alias("zero_share")
    )
    return out.withColumn("constant", F.coalesce(F.col("std") <= tolerance, F.lit(True)))


def constant_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """(feature, verdict) of two scans' constant features: shared, left only, right only."""
    l = left.filter("constant").select("feature").distinct().withColumn("l", F.lit(True))
    r = right.filter("constant").select("feature").distinct().withColumn("r", F.lit(True))
    verdict = F.when(F.col("l") & F.col("r"), "shared").when(F.col("l"), "left only").otherwise("right only")
    return l.join(r, "feature", "full_outer").select("feature", verdict.alias("verdict"))


def negative_value_audit(df: DataFrame, features: list[str], by: str, exempt: tuple[str, ...] = ()) -> DataFrame:
    """Per label and feature the count and share of negative values. Exempt features use negatives as sentinels."""
    looked = [f for f in features if f not in exempt]
    long = df.select(col(by).alias("label"), *[col(f).cast("double").alias(f) for f in looked]).unpivot(["label"], looked, "feature", "value")
    return long.groupBy("label", "feature").agg(F.count_if(F.col("value") < 0).alias("negatives"), F.count(F.lit(1)).alias("n")).withColumn("pct", F.round(100 * F.col("negatives") / F.col("n"), 6))


def any_negative(features: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(col(f) < 0, F.lit(False)) for f in features])


def all_negative(features: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(col(f) < 0, F.lit(False)) for f in features])


def recomputable(duration: str, counts: list[str]) -> Column:
    """Duration is negative but every count it would be divided into is valid."""
    return reduce(lambda a, b: a & b, [F.coalesce(col(duration) < 0, F.lit(False)), *[F.coalesce(col(c) >= 0, F.lit(False)) for c in counts]])


def negative_summary(df: DataFrame, features: list[str], duration: str, counts: list[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(any_negative(features)).alias("any_negative"), F.count_if(all_negative(features)).alias("all_negative"), F.count_if(recomputable(duration, counts)).alias("recomputable")
    )


def duplicate_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows, distinct vectors, rows in groups of copies, largest group, excess rows. Only fingerprints are shuffled."""
    groups = df.groupBy(fingerprint_hash(features).alias("fp")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    return groups.agg(
        F.coalesce(F.sum("n"), zero).alias("total_rows"), F.count(F.lit(1)).alias("distinct_vectors"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero).alias("rows_in_groups"),
        F.coalesce(F.max("n"), zero).alias("largest_group"), F.coalesce(F.sum(F.col("n") - 1), zero).alias("excess"),
    )


def duplicate_rate_per_label(df: DataFrame, features: list[str], label: str) -> DataFrame:
    groups = df.groupBy(col(label).alias("label"), fingerprint_hash(features).alias("fp")).agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("label").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_vectors")).withColumn("duplicate_rate", F.round(1 - F.col("distinct_vectors") / F.col("n"), 6))


def top_duplicate_groups(df: DataFrame, features: list[str], label: str, k: int = 10) -> DataFrame:
    """The k largest groups of equal vectors: size, the vector and the label mix (label:count, by label). Only rows of vectors that are frequent
    enough, by a summary of their MD5, are grouped."""
    marked = df.select(*[col(f) for f in features], col(label).alias("label"), F.md5(F.to_json(F.struct(*[col(f) for f in features]))).alias("_fp"))
    often = heavy.frequent(marked, "_fp", k)
    rows = marked.join(sized(often.select(F.col("value").alias("_often"))), F.col("_fp") == F.col("_often"), "left_semi")
    by_label = rows.groupBy(*[col(f) for f in features], "label").agg(F.count(F.lit(1)).alias("c"))
    mix = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("label", "c"))), lambda x: F.concat_ws(":", x["label"], x["c"])), ",")
    groups = by_label.groupBy(*[col(f) for f in features]).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_labels"), mix.alias("labels"))
    return groups.orderBy(F.desc("n"), *features).limit(k)


def conflicting_groups(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Fingerprints that carry more than one label."""
    return df.groupBy(fingerprint_hash(features).alias("fp")).agg(F.min(col(label)).alias("lo"), F.max(col(label)).alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi")


def class_weights(df: DataFrame, label: str, most: float = 50.0) -> DataFrame:
    """Inverse frequency N / (K n), at most `most`."""
    counts = df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    return counts.withColumn("weight", F.round(F.least(F.lit(most), F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))), 6))


def source_share_proxy(df: DataFrame, label: str, constants: dict[str, float]) -> DataFrame:
    """Share of a label's rows that hold the imputed constants: how much of it stems from a source without the columns."""
    on = reduce(lambda a, b: a & b, [col(c) == v for c, v in constants.items()])
    return df.groupBy(col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_if(on).alias("on_constants")).withColumn("share", F.round(F.col("on_constants") / F.col("n"), 6))


def group_size_stats(df: DataFrame, key: str, large: int = 100) -> DataFrame:
    """Sizes of groups. They are counted by size first: what meets in one task grows with the number of different sizes."""
    sizes = df.groupBy(col(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("g"))
    zero = F.lit(0).cast("long")
    return sizes.agg(
        F.coalesce(F.sum("g"), zero).alias("groups"), F.min("n").alias("smallest"), F.percentile("n", F.lit(0.5), F.col("g")).alias("median"), F.round(F.sum(F.col("n") * F.col("g")) / F.sum("g"), 6).alias("mean"), F.max("n").alias("largest"),
        F.coalesce(F.sum(F.when(F.col("n") >= large, F.col("g")).otherwise(0)), zero).alias("large_groups"), F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("g")).otherwise(0)), zero).alias("singletons"),
    )


def value_counts_topk(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, exactly; see `heavy`."""
    return heavy.top_values(df, column, k)


def key_profile_per_label(df: DataFrame, key: str, label: str, usual: tuple) -> DataFrame:
    """Per label: n, median key, distinct keys, share of usual keys (such as ports 80 and 443)."""
    pairs = df.select(col(label).alias("label"), col(key).alias("key"))
    keys = pairs.groupBy("label", "key").agg(F.count(F.lit(1)).alias("c"))
    plain = keys.groupBy("label").agg(F.sum("c").alias("n"), F.count("key").alias("distinct_keys"), F.round(F.sum(F.when(F.col("key").isin(*usual), F.col("c")).otherwise(0)) / F.sum("c"), 6).alias("usual_share"))
    median = pivoted(exact_quantiles(pairs, ["label"], "key", [0.5]), ["label"], ["median_key"]).withColumnRenamed("label", "_label")
    return plain.join(median, F.col("label").eqNullSafe(F.col("_label")), "left").select("label", "n", "median_key", "distinct_keys", "usual_share")


def feature_stats_per_label(df: DataFrame, features: list[str], label: str) -> DataFrame:
    long = df.select(col(label).alias("label"), *[col(f).cast("double").alias(f) for f in features]).unpivot(["label"], features, "feature", "value")
    return long.groupBy("label", "feature").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev("value"), 6).alias("std"))


def rows_per_day(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def label_consistency(df: DataFrame, flag: Column, derived: Column) -> DataFrame:
    """How often a stored flag disagrees with the one derived from the label."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~flag.eqNullSafe(derived)).alias("mismatches"))


def expect(df: DataFrame, rules: dict[str, tuple[Column, object]]) -> DataFrame:
    """(rule, expected, actual, pass) for aggregates with expected values, in one pass."""
    row = df.agg(*[c.cast("double").alias(n) for n, (c, _) in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(float(v)).alias("expected"), F.col(f"`{n}`").alias("actual")) for n, (_, v) in rules.items()])
    return row.select(F.inline(rows)).withColumn("passed", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))
