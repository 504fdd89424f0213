"""Leakage-free splits, samples and dedup. Everything is decided by hashes of keys, so it repeats on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions.fingerprint import fingerprint_hash, md5_bucket, md5_share
from flowlab.operators.quality import conflicting_groups
from flowlab.operators.quantiles import exact_quantiles


def dedup_exact(df: DataFrame, features: list[str], order: str) -> DataFrame:
    """One row per feature vector: the one with the smallest `order`."""
    row = F.struct(F.col(f"`{order}`").alias("_o"), *[F.col(f"`{c}`") for c in df.columns if c not in features])
    kept = df.groupBy(*[F.col(f"`{f}`") for f in features]).agg(F.min(row).alias("_row"))
    return kept.select(*[F.col(f"`{c}`") if c in features else F.col(f"_row.`{c}`") for c in df.columns])


def dedup_any(df: DataFrame, features: list[str]) -> DataFrame:
    return df.dropDuplicates(features)


def group_key_sharded(df: DataFrame, key: str, row_key: str, limit: int, shards: int) -> DataFrame:
    """df with group_id: the key itself, or for keys of more than `limit` rows one of `shards` shards by a hash of the row."""
    busy = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("_k")
    shard = F.concat(F.lit("hv_"), F.col(key).cast("string"), F.lit("_s"), md5_bucket(F.col(row_key), shards).cast("string"))
    return df.join(busy, F.col(key) == F.col("_k"), "left").withColumn("group_id", F.when(F.col("_k").isNotNull(), shard).otherwise(F.concat(F.lit("g_"), F.col(key).cast("string")))).drop("_k")


def split_grouped(df: DataFrame, group: str, share: float = 0.8, salt: str = "42") -> DataFrame:
    """df with split: whole groups, in order of a hash of their name, go to train while train has less than `share` of all
    rows before them. Groups are counted in hash buckets first, so the running sum passes over at most 4096 buckets
    and, inside the one bucket where the share is reached, over its groups."""
    g = F.col(f"`{group}`")
    sizes = df.groupBy(g.cast("string").alias("_g")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", F.md5(F.concat(F.lit(salt), F.col("_g"))))
    sizes = sizes.withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    buckets = sizes.groupBy("_b").agg(F.sum("_n").alias("_bn"))
    ahead = F.coalesce(F.sum("_bn").over(Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = buckets.select("_b", ahead.alias("_base"), F.sum("_bn").over(Window.partitionBy(F.lit(0))).alias("_all"))
    inside = F.coalesce(F.sum("_n").over(Window.partitionBy("_b").orderBy("_h", "_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    assigned = sizes.withColumn("_in", inside).join(bases, "_b").select("_g", F.when(F.col("_base") + F.col("_in") < share * F.col("_all"), "train").otherwise("test").alias("split"))
    return df.join(assigned, g.cast("string").eqNullSafe(F.col("_g"))).drop("_g")


def split_bucket(df: DataFrame, key: str, buckets: int = 20, train: int = 14) -> DataFrame:
    return df.withColumn("split", F.when(md5_bucket(F.col(key), buckets) < train, "train").otherwise("test"))


def split_random(df: DataFrame, key: str, share: float = 0.7, salt: str = "42") -> DataFrame:
    """By a hash threshold of a row key: the same rows on every run and partitioning."""
    return df.withColumn("split", F.when(md5_share(F.col(key), salt) < share, "train").otherwise("test"))


def split_stratified(df: DataFrame, label: str, key: str, share: float = 0.2, salt: str = "42", buckets: int = 256) -> DataFrame:
    """Exactly ceil(share * n) rows of every label to test, in order of a hash of the row key. Labels are ranked in hash
    buckets, and only rows of the bucket in which the share is reached are ordered."""
    h = F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))
    rows = df.withColumn("_h", h).withColumn("_b", F.pmod(F.conv(F.substring("_h", 1, 2), 16, 10).cast("int"), F.lit(buckets)))
    sizes = rows.groupBy(F.col(label).alias("_l"), F.col("_b").alias("_sb")).agg(F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy("_l")
    bases = sizes.select("_l", "_sb", "_n", F.coalesce(F.sum("_n").over(by.orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_n").over(by).alias("_all"))
    joined = rows.join(bases, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_sb"))).withColumn("_left", F.ceil(share * F.col("_all")) - F.col("_base"))
    # only the bucket in which the share is reached is ordered
    open_ = (F.col("_left") > 0) & (F.col("_left") < F.col("_n"))
    ranked = joined.filter(open_).withColumn("_r", F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key)))
    cut = ranked.withColumn("split", F.when(F.col("_r") <= F.col("_left"), "test").otherwise("train")).drop("_r")
    whole = joined.filter(~open_).withColumn("split", F.when(F.col("_left") > 0, "test").otherwise("train"))
    return whole.unionByName(cut).drop("_h", "_b", "_l", "_sb", "_base", "_all", "_n", "_left")


def split_temporal_median(df: DataFrame, ts: str, features: list[str] | None = None) -> DataFrame:
    """df with split early or late at the median time; with features, late rows whose vector occurs early are dropped."""
    middle = exact_quantiles(df.select((F.unix_micros(F.col(ts)) / 1_000_000).alias("t")), [], "t", [0.5]).first()
    cut = middle["quantile"] if middle else None
    out = df.withColumn("split", F.when(F.unix_micros(F.col(ts)) / 1_000_000 < F.lit(cut), "early").otherwise("late"))
    if not features:
        return out
    early = out.filter("split = 'early'")
    seen = early.select(fingerprint_hash(features).alias("_fp")).distinct()
    late = out.filter("split = 'late'").withColumn("_fp", fingerprint_hash(features)).join(seen, "_fp", "left_anti").drop("_fp")
    return early.unionByName(late)


def overlap_check(train: DataFrame, test: DataFrame, features: list[str], group: str) -> DataFrame:
    """shared_groups, shared_vectors, leaked_rows (rows of test whose vector is in train) and leaked_pct."""
    fp = fingerprint_hash(features).alias("fp")
    left, right = train.select(fp).distinct(), test.groupBy(fp).agg(F.count(F.lit(1)).alias("n"))
    shared = right.join(left, "fp", "left_semi").agg(F.count(F.lit(1)).alias("shared_vectors"), F.coalesce(F.sum("n"), F.lit(0)).alias("leaked_rows"))
    groups = test.select(group).distinct().join(train.select(group).distinct(), group, "left_semi").agg(F.count(F.lit(1)).alias("shared_groups"))
    total = test.agg(F.count(F.lit(1)).alias("n_test"))
    # each side is one row
    return groups.join(shared, how="cross").join(total, how="cross").withColumn("leaked_pct", F.round(100 * F.col("leaked_rows") / F.col("n_test"), 6))


def cross_set_overlap(holdout: DataFrame, trained: DataFrame, features: list[str], label: str) -> DataFrame:
    """Per label: rows of holdout, and those whose vector is in the training set."""
    seen = trained.select(fingerprint_hash(features).alias("_fp")).distinct().withColumn("_seen", F.lit(True))
    marked = holdout.withColumn("_fp", fingerprint_hash(features)).join(seen, "_fp", "left")
    return marked.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_if("_seen").alias("contaminated")).withColumn("pct", F.round(100 * F.col("contaminated") / F.col("n"), 6))


def sample_fraction(df: DataFrame, key: str, share: float, salt: str = "7") -> DataFrame:
    return df.filter(md5_share(F.col(key), salt) < share)


def sample_balanced(df: DataFrame, label: str, target: str, key: str, salt: str = "7") -> DataFrame:
    """All rows of the target class and about as many others, chosen by hash; the share follows from one count."""
    n = df.agg(F.count_if(F.col(label) == target).alias("t"), F.count(F.lit(1)).alias("n")).first()
    share = min(1.0, n["t"] / max(1, n["n"] - n["t"]))
    return df.filter((F.col(label) == target) | (md5_share(F.col(key), salt) < share))


def sample_to_targets(df: DataFrame, label: str, key: str, targets: dict[str, int]) -> DataFrame:
    """As many rows of each class as its target says, in expectation: classes that are too small are repeated (true
    upsampling), larger ones thinned by hash. Copies are numbered in column `copy`."""
    counts = {r["l"]: r["n"] for r in df.filter(F.col(label).isin(*targets)).groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    times: Column = F.lit(0.0)
    for name, want in targets.items():
        times = F.when(F.col(label) == name, F.lit(want / counts[name] if counts.get(name) else 0.0)).otherwise(times)
    extra = F.when(md5_share(F.col(key), "copies") < times - F.floor(times), 1).otherwise(0)
    copies = (F.floor(times) + extra).cast("int")
    return df.withColumn("_copies", copies).filter("_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")


def downsample_class(df: DataFrame, label: str, target: str, most: int, key: str) -> DataFrame:
    """Rows of one class kept with probability most / n, by hash."""
    n = df.filter(F.col(label) == target).count()
    return df.filter((F.col(label) != target) | F.col(label).isNull() | (md5_share(F.col(key), "down") < most / max(1, n)))


def denoise_conflicts(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Without any row of a feature vector that carries more than one label."""
    bad = conflicting_groups(df, features, label).select("fp")
    return df.withColumn("_fp", fingerprint_hash(features)).join(bad, F.col("_fp") == F.col("fp"), "left_anti").drop("_fp")


def shuffled(df: DataFrame, key: str, salt: str = "42") -> DataFrame:
    """A repeatable global random order."""
    return df.orderBy(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), key)


def positions(df: DataFrame, key: str, salt: str = "42") -> DataFrame:
    """df with position: the place of each row, from 1, in the order of `shuffled`. Rows are ranked in 4096 hash buckets,
    and the running sum passes over the buckets."""
    rows = df.withColumn("_h", F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    sizes = rows.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select(F.col("_b").alias("_sb"), ahead.alias("_base"))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
    joined = ranked.join(bases, F.col("_b").eqNullSafe(F.col("_sb")))
    return joined.withColumn("position", F.col("_r") + F.col("_base")).drop("_h", "_b", "_sb", "_base", "_r")
