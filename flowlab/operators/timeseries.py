"""Volume series on uniform grids: densify, surge, correlation with lag, shape and short-time spectra."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.operators.joins import sized
from flowlab.operators.quantiles import exact_quantiles, pivoted


def grid(spark: SparkSession, start: str, minutes: int, seconds: int) -> DataFrame:
    """(bucket): minutes * 60 // seconds + 1 instants, aligned on epoch seconds, both ends included."""
    first = f"floor(unix_seconds(timestamp '{start}') / {seconds}) * {seconds}"
    return spark.range(minutes * 60 // seconds + 1).select(F.timestamp_seconds(F.expr(first) + F.col("id") * seconds).alias("bucket"))


def grid_over(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """(bucket): the instants, aligned on epoch seconds, from the bucket of the first to that of the last time of df; none if it has no times."""
    t = F.floor(F.unix_seconds(ts) / seconds)
    ends = df.agg(F.min(t).alias("first"), F.max(t).alias("last")).first()
    first, stop = (0, 0) if ends["first"] is None else (ends["first"], ends["last"] + 1)
    return df.sparkSession.range(first, stop).select(F.timestamp_seconds(F.col("id") * seconds).alias("bucket"))


def bucket_label(bucket: Column, seconds: int) -> Column:
    """Sortable labels; seconds are shown for buckets under a minute."""
    return F.date_format(bucket, "yyyy-MM-dd HH:mm:ss" if seconds < 60 else "yyyy-MM-dd HH:mm")


def first_seen(text: Column) -> Column:
    """A trimmed `yyyy-MM-dd HH:mm:ss` text as timestamp, null if it is none."""
    return F.try_to_timestamp(F.trim(text), F.lit("yyyy-MM-dd HH:mm:ss"))


#: Families in one list.
FAMILIES = 10_000


def densify(volume: DataFrame, buckets: DataFrame, value: str = "n") -> DataFrame:
    """(bucket, family, value): every family on every bucket, zero where there was nothing. Families are dealt by a hash to lists of about
    FAMILIES at most, and every bucket meets every list; few families are one list."""
    families = volume.select("family").distinct()
    lists = max(1, -(-families.count() // FAMILIES))
    dealt = families.groupBy(F.pmod(F.xxhash64("family"), F.lit(lists)).alias("list")).agg(F.sort_array(F.collect_list("family")).alias("f"))
    full = buckets.withColumn("list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lists - 1).cast("bigint")))).join(sized(dealt), "list").select("bucket", F.explode("f").alias("family"))
    return full.join(volume.select("bucket", "family", value), ["bucket", "family"], "left").select("bucket", "family", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value"))


def aggregate_peak(series: DataFrame) -> DataFrame:
    """Sum over families per bucket, the peak bucket (the first of equals), its value and its distance from the last bucket in buckets."""
    total = series.groupBy("bucket").agg(F.sum("value").alias("v"))
    one = total.agg(F.max("v").alias("peak"), F.min_by("bucket", F.struct((-F.col("v")).alias("v"), F.col("bucket"))).alias("peak_bucket"), F.max("bucket").alias("last"), F.count(F.lit(1)).alias("n"), F.min("bucket").alias("first"))
    step = (F.unix_seconds("last") - F.unix_seconds("first")) / F.greatest(F.col("n") - 1, F.lit(1))
    return one.select("peak", "peak_bucket", F.when(step > 0, F.round((F.unix_seconds("last") - F.unix_seconds("peak_bucket")) / step).cast("long")).otherwise(0).cast("long").alias("from_end"))


def surge(series: DataFrame) -> DataFrame:
    """Per family: peak, median, surge = peak / median - 1 (null without a median) and the rank of its volume."""
    per = series.groupBy("family").agg(F.max("value").alias("peak"), F.sum("value").alias("volume"))
    median = pivoted(exact_quantiles(series, ["family"], "value", [0.5]), ["family"], ["median"]).withColumnRenamed("family", "_family")
    per = per.join(median, F.col("family").eqNullSafe(F.col("_family")), "left")
    return per.select("family", "peak", F.round("median", 6).alias("median"), F.round(F.when(F.col("median") > 0, F.col("peak") / F.col("median") - 1), 6).alias("surge"), F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("volume"))).alias("rank"))


def bandwidth(total: Column, seconds: int) -> Column:
    """Bytes in a bucket as a rate with a unit."""
    bps = total * 8 / seconds
    return F.when(bps >= 1e9, F.concat(F.round(bps / 1e9, 2), F.lit(" Gbps"))).when(bps >= 1e6, F.concat(F.round(bps / 1e6, 2), F.lit(" Mbps"))).when(bps >= 1e3, F.concat(F.round(bps / 1e3, 2), F.lit(" Kbps"))).otherwise(F.concat(F.round(bps, 2), F.lit(" bps")))


def _correlation(x: str, y: str) -> Column:
    """0 with fewer than 3 points or no variance (where the built-in one divides by zero)."""
    r = F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    return F.when(F.count(F.lit(1)) >= 3, F.coalesce(r, F.lit(0.0))).otherwise(0.0)


def lag_correlation(series: DataFrame, seconds: int, most: int = 15) -> DataFrame:
    """(x, y, lag, r) for every ordered pair of families and lag: the correlation of x at t with y at t + lag buckets; 0 with
    fewer than 3 common points or no variance. The self-join is an equi-join on the shifted bucket."""
    at = series.select((F.unix_seconds("bucket") / seconds).cast("long").alias("t"), "family", "value")
    left = at.select(F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("lag"), "t", F.col("family").alias("x"), F.col("value").alias("vx")).withColumn("u", F.col("t") + F.col("lag"))
    right = at.select(F.col("t").alias("u"), F.col("family").alias("y"), F.col("value").alias("vy"))
    pairs = left.join(right, "u").filter(F.col("x") < F.col("y")).groupBy("x", "y", "lag")
    return pairs.agg(_correlation("vx", "vy").alias("r"))


def pearson(series: DataFrame) -> DataFrame:
    """(x, y, r) of every pair of families at the same time."""
    left = series.select("bucket", F.col("family").alias("x"), F.col("value").alias("vx"))
    right = series.select("bucket", F.col("family").alias("y"), F.col("value").alias("vy"))
    return left.join(right, "bucket").filter(F.col("x") < F.col("y")).groupBy("x", "y").agg(F.round(_correlation("vx", "vy"), 6).alias("r"))


def best_lag(lagged: DataFrame) -> DataFrame:
    """The lag with the greatest correlation (rounded to 9 digits), ties to the smallest absolute lag, then the smaller lag."""
    r = F.round("r", 9)
    return lagged.groupBy("x", "y").agg(F.min_by(F.struct("lag", r.alias("r")), F.struct((-r).alias("r"), F.abs("lag").alias("a"), F.col("lag").alias("l"))).alias("b")).select("x", "y", "b.lag", F.round("b.r", 6).alias("r"))


def shape(series: DataFrame) -> DataFrame:
    """Per family: coefficient of variation, share of unchanged steps, of active buckets, of the top three buckets, and a
    name for the shape."""
    w = Window.partitionBy("family").orderBy("bucket")
    step = series.withColumn("d", F.abs(F.col("value") - F.lag("value").over(w)))
    top = F.row_number().over(Window.partitionBy("family").orderBy(F.desc("value"), "bucket"))
    per = step.withColumn("k", top).groupBy("family").agg(
        F.avg("value").alias("m"), F.stddev_pop("value").alias("s"), F.avg(F.when(F.col("d").isNotNull(), (F.col("d") == 0).cast("double"))).alias("flat"), F.avg((F.col("value") > 0).cast("double")).alias("active"),
        (F.sum(F.when(F.col("k") <= 3, F.col("value")).otherwise(0.0)) / F.nullif(F.sum("value"), F.lit(0.0))).alias("top3"),
    )
    cv = F.when(F.col("m") > 0, F.col("s") / F.col("m")).otherwise(0.0)
    name = F.when(F.col("m") == 0, "silent").when((F.col("top3") > 0.6) & (F.col("active") < 0.3), "burst").when(cv < 0.35, "steady").when(F.col("flat") > 0.6, "stepped").when(cv > 1.2, "spiky").otherwise("variable")
    return per.select("family", F.round(cv, 6).alias("cv"), F.round("flat", 6).alias("flat"), F.round("active", 6).alias("active"), F.round("top3", 6).alias("top3"), name.alias("shape"))


def stft(series: DataFrame, seconds: int, width: int = 16, hop: int = 8) -> DataFrame:
    """(family, frame, bin, db): magnitudes of a Hann-windowed, mean-removed transform of `width` buckets in decibels relative
    to the family's greatest. Frames meet by a group key, so no series is one task; the sums are plain columns."""
    t = (F.unix_seconds("bucket") / seconds).cast("long")
    first = series.groupBy("family").agg(F.min(t).alias("t0"), F.max(t).alias("t1"))
    at = series.join(first, "family").withColumn("i", t - F.col("t0")).withColumn("n", F.col("t1") - F.col("t0") + 1)
    frames = at.withColumn("frame", F.explode(F.sequence(F.greatest(F.lit(0), F.ceil((F.col("i") - width + 1) / hop)), F.floor(F.col("i") / hop)))).filter(F.col("frame") * hop + width <= F.col("n"))
    k = (F.col("i") - F.col("frame") * hop).cast("double")
    hann = 0.5 - 0.5 * F.cos(2 * math.pi * k / (width - 1))
    w = Window.partitionBy("family", "frame")
    x = (F.col("value") - F.avg("value").over(w)) * hann
    sums = [F.sum(F.col("x") * f(2 * math.pi * b / width * F.col("k"))).alias(f"{n}{b}") for b in range(width // 2 + 1) for n, f in (("c", F.cos), ("s", F.sin))]
    per = frames.withColumn("k", k).withColumn("x", x).groupBy("family", "frame").agg(*sums)
    rows = F.array(*[F.struct(F.lit(b).alias("bin"), F.sqrt(F.col(f"c{b}") ** 2 + F.col(f"s{b}") ** 2).alias("m")) for b in range(width // 2 + 1)])
    long = per.select("family", "frame", F.inline(rows))
    peak = long.groupBy("family").agg(F.max("m").alias("peak"))
    return long.join(peak, "family").select("family", "frame", "bin", F.round(F.when(F.col("peak") > 0, 20 * F.log10(F.greatest(F.col("m"), F.col("peak") * 1e-6) / F.col("peak"))).otherwise(-120.0), 4).alias("db"))


def narrative(lags: DataFrame, seconds: int, least: float = 0.5) -> DataFrame:
    """A sentence for each pair whose best correlation is at least `least` in size."""
    wait = F.abs(F.col("lag")) * seconds
    text = F.when(F.col("lag") > 0, F.format_string("%s leads %s by %d s", "x", "y", wait)).when(F.col("lag") < 0, F.format_string("%s trails %s by %d s", "x", "y", wait)).otherwise(F.format_string("%s and %s move together", "x", "y"))
    return lags.filter(F.abs("r") >= least).select("x", "y", "lag", "r", text.alias("sentence"))
