"""Score drift against a reference: fixed bins, PSI, binned KS, novelty; per key, with a constant key as the global case."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlab.functions.scores import novelty as novelty_of
from flowlab.functions.scores import score_bin
from flowlab.operators import scan

BINS, EPS = 20, 1e-4


def histogram(df: DataFrame, score: str, key: str | None = None, bins: int = BINS) -> DataFrame:
    """(key, bin, n, share) with every bin present for every key."""
    k = F.col(key) if key else F.lit("all")
    counts = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score))).groupBy(k.alias("key"), score_bin(F.col(score), bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    full = counts.select("key").distinct().select("key", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    dense = full.join(counts, ["key", "bin"], "left").fillna(0, ["n"])
    return dense.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("key")))


def drift(observed: DataFrame, reference: DataFrame) -> DataFrame:
    """(key, psi, ks, verdict): severe from PSI .5, shift from .25 or KS .15, else stable."""
    both = observed.select("key", "bin", F.col("share").alias("o")).join(reference.select("bin", F.col("share").alias("r")), "bin")
    o, r = F.greatest("o", F.lit(EPS)), F.greatest("r", F.lit(EPS))
    run = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # twenty rows per key
    gap = F.abs(F.sum("o").over(run) - F.sum("r").over(run))
    out = both.withColumn("gap", gap).withColumn("part", (o - r) * F.log(o / r)).groupBy("key").agg(F.round(F.sum("part"), 6).alias("psi"), F.round(F.max("gap"), 6).alias("ks"))
    return out.withColumn("verdict", F.when(F.col("psi") >= 0.5, "severe").when((F.col("psi") >= 0.25) | (F.col("ks") >= 0.15), "shift").otherwise("stable"))


def novelty(df: DataFrame, score: str, reference: DataFrame, bins: int = BINS) -> DataFrame:
    """df with the novelty of each score: log of one over its bin's share in the reference."""
    share = reference.select(F.col("bin").alias("_bin"), F.col("share").alias("_share"))
    return df.withColumn("_b", score_bin(F.col(score), bins)).join(F.broadcast(share), F.col("_b") == F.col("_bin"), "left").withColumn("novelty", F.round(novelty_of(F.coalesce("_share", F.lit(0.0))), 6)).drop("_b", "_bin", "_share")


def streaks(verdicts: DataFrame, key: str, order: str, patience: int = 5, rows: int | None = None) -> DataFrame:
    """The columns of verdicts with streak, the length of the run of drifted windows that ends here (0 if this one is stable), and act: the run
    is a multiple of `patience` long. A null verdict is stable. A prefix scan: a key of any number of windows is many tasks (of `rows` each)."""
    runs = scan.run_lengths(F.col("verdict") != "stable")
    out = scan.prefix_scan(verdicts, [key], [order], runs, "_run", rows).withColumn("streak", F.col("_run.run")).drop("_run")
    return out.withColumn("act", (F.col("streak") > 0) & (F.col("streak") % patience == 0))


def ema(df: DataFrame, key: str, order: str, value: str, alpha: float, rows: int | None = None) -> DataFrame:
    """(key, ema): exponential mean over the ordered values of each key, null where it has none. A fold of affine maps over many tasks."""
    return scan.fold(df, [key], [order, value], scan.affine(value, alpha), "_run", rows).select(key, F.round(scan.mean_of(F.col("_run")), 6).alias("ema"))


def ema_running(df: DataFrame, key: str, order: str, value: str, alpha: float, rows: int | None = None, digits: int = 6) -> DataFrame:
    """df with the exponential mean of its key up to each row, rounded once, to `digits`: as the plain loop over the rows gives it to the last bit, so that
    means half way between two rounded values fall on its side. They are scaled before they are rounded, as DuckDB does."""
    out = scan.run_exactly(df, [key], [order, value], value, alpha, "_run", rows)
    scaled = F.col("_run") * 10.0**digits
    return out.withColumn("ema", F.when(F.abs(scaled) < 1e15, F.round(scaled) / 10.0**digits).otherwise(F.col("_run"))).drop("_run")


def reanchor(reference: DataFrame, observed: DataFrame, blend: float = 0.25) -> DataFrame:
    """The reference moved toward what is observed."""
    return reference.select("bin", F.col("share").alias("r")).join(observed.select("bin", F.col("share").alias("o")), "bin").select("bin", ((1 - blend) * F.col("r") + blend * F.col("o")).alias("share"))
