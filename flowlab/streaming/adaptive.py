"""Per-key adaptive thresholds: drift against a baseline, a rate controller and a bounded residual calibrator.

A micro-batch advances a policy once. Its rows are first reduced to one summary for each key (counts, the newest scores, sums of gradients at
the policy in force), and the stateful stream of `controller` applies the summaries. Nothing depends on how rows are cut into batches of a
worker or in which order tasks see them. A summary is written once under the number of its micro-batch, and the state remembers
the last one, so a batch that runs again changes nothing. One global policy is the case of a constant key: its rows are reduced before they meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.sources import files
from flowlab.sources.shared import stage, unstage
from flowlab.streaming import controller
from flowlab.streaming.controller import BINS, EDGE, FEATURES, POLICY, Config

#: Parts in which the rows of a key are cut to the newest ones first.
PARTS = 64
STATE = f"key string, {POLICY}"


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(inside / (1 - inside))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _bin(p: Column) -> Column:
    return F.greatest(F.least(F.floor(p * BINS), F.lit(BINS - 1)), F.lit(0)).cast("int")


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def features(p: Column, bot: Column, baseline: Column, drift: Column) -> Column:
    """1, log odds, bot probability around a half (0 if unknown), novelty of the score, drift between 0 and 1."""
    share = F.coalesce(F.get(baseline, _bin(p)), F.lit(1 / BINS))
    rare = F.least(F.greatest(F.log(1 / F.greatest(share, F.lit(1e-3))), F.lit(0.0)), F.lit(5.0))
    return F.array(F.lit(1.0), _logit(p), F.coalesce(bot - 0.5, F.lit(0.0)), rare, F.least(F.greatest(drift, F.lit(0.0)), F.lit(1.0)))


def _dot(x: Column, w: Column) -> Column:
    return _total(F.zip_with(x, w, lambda a, b: a * b))


def adapted(p: Column, x: Column, weights: Column, c: Config) -> Column:
    """Scores with the residual; exactly the scores while nothing has been learned."""
    shift = F.greatest(F.least(_dot(x, weights), F.lit(c.most_shift)), F.lit(-c.most_shift))
    return F.when(shift == 0, p).otherwise(_sigmoid(_logit(p) + shift))


def initial(keys: DataFrame, c: Config) -> DataFrame:
    """STATE of keys(key) that have none yet."""
    zeros = F.array(*[F.lit(0.0)] * FEATURES)
    none = F.array().cast("array<double>")
    values = [
        F.lit(c.anchor), zeros, zeros, none, none, F.lit(0), F.lit(0), F.lit(0), F.lit(0.0), F.lit(0.0), F.lit("unobserved"), F.lit(False), F.lit(0).cast("bigint"),
    ]
    names = [x.split()[0] for x in STATE.split(", ")]
    return keys.select("key", *[v.alias(n) for v, n in zip(values, names[1:], strict=True)])


def summarised(rows: DataFrame, state: DataFrame, c: Config) -> DataFrame:
    """One row for each key of rows(key, p, bot, t, id, y): s_key, n, alerts, recent (the newest scores, oldest first), verdicts
    and nominal (how many rows were learned from), and g, the sum of weighted gradients at the weights in force.

    Rows are judged by the policy that was in force when they came. Verdicts are rows with a y; nominal rows are those clearly
    below the threshold, unless drift is severe. Rows of a key meet as partial sums; its newest rows are cut in PARTS parts first."""
    met = rows.filter(F.col("p").isNotNull() & ~F.isnan("p") & (F.abs("p") < float("inf"))).join(state.withColumnRenamed("key", "s_key"), F.col("key") == F.col("s_key"))
    x = features(F.col("p"), F.col("bot"), F.col("baseline"), F.col("psi"))
    plain = features(F.col("p"), F.lit(None).cast("double"), F.col("baseline"), F.col("psi"))
    low = (F.col("p") <= c.margin * F.col("threshold")) & (F.col("verdict") != "severe")
    error = lambda f, y, w: (_sigmoid(_dot(f, F.col("weights"))) - y) * w
    judged = met.select(
        "key", adapted(F.col("p"), x, F.col("weights"), c).alias("a"), "threshold", F.col("y").isNotNull().alias("v"), low.alias("low"), x.alias("x"), plain.alias("plain"),
        F.when(F.col("y").isNotNull(), error(x, F.col("y").cast("double"), 1.0)).otherwise(0.0).alias("e"), F.when(low, error(plain, F.lit(0.0), c.nominal_weight)).otherwise(0.0).alias("e0"),
    )
    sums = [F.sum(F.col("e") * F.col("x")[i] + F.col("e0") * F.col("plain")[i]).alias(f"g{i}") for i in range(FEATURES)]
    totals = judged.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") >= F.col("threshold")).alias("alerts"), F.count_if("v").alias("verdicts"), F.count_if("low").alias("nominal"), *sums)
    cut = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy("key", *by).orderBy(F.desc("t"), F.desc("id"), F.desc("p")))).filter(F.col("_r") <= c.window)
    newest = cut(cut(met.select("key", "t", "id", "p").withColumn("_part", F.pmod(F.xxhash64("id", "p"), F.lit(PARTS))), "_part"))
    recent = newest.groupBy(F.col("key").alias("r_key")).agg(F.transform(F.sort_array(F.collect_list(F.struct("t", "id", "p"))), lambda r: r["p"]).alias("recent"))
    both = totals.join(recent, F.col("key") == F.col("r_key"))
    return both.select(F.col("key").alias("s_key"), "n", "alerts", "verdicts", "nominal", F.array(*[F.col(f"g{i}") for i in range(FEATURES)]).alias("g"), "recent")


def snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """STATE under root after the last finished batch, or None; a table of it can be saved, and given to `policy_sink` as `saved`."""
    found = controller.stored(spark, root)
    return None if found is None else found.drop("batch")


def restored(saved: DataFrame, c: Config) -> DataFrame:
    """STATE from a table that may lack columns or hold values that no longer fit: what is missing, null or not finite starts
    anew, arrays of another length too, and the threshold is clamped to the present band."""
    low, high = c.band()
    keys = saved.filter(F.col("key").isNotNull()).groupBy(F.col("key").cast("string").alias("key")).agg(*[F.first(x).alias(f"_{x}") for x in saved.columns if x != "key"])
    fresh = initial(keys.select("key"), c)
    names = fresh.columns
    lengths = {"weights": FEATURES, "squares": FEATURES, "baseline": BINS}
    out = keys.join(fresh, "key")
    for n in names[1:]:
        if f"_{n}" not in keys.columns:
            continue
        kind, old = dict(fresh.dtypes)[n], F.col(f"_{n}")
        if kind.startswith("array"):
            value = F.transform(old.cast(kind), lambda v: v)
            fine = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            fine = fine & (F.size(value) == lengths[n]) if n in lengths else fine
        else:
            value = old.cast(kind)
            fine = ~F.isnan(value) & (F.abs(value) < float("inf")) if kind == "double" else value.isNotNull()
        out = out.withColumn(n, F.when(F.coalesce(fine, F.lit(False)), value).otherwise(F.col(n)))
    clamped = F.least(F.greatest(F.col("threshold"), F.lit(low)), F.lit(high))
    return out.withColumn("threshold", clamped).select(*names)


def once(rows: DataFrame, row_id: str, time: str, polarity: str, within: str = "1 hour") -> DataFrame:
    """A stream in which a verdict counts once: a row whose polarity and id are known is dropped if a row of its id came before, as long as both
    lie within the given time of the newest event. State is bounded by that time; nothing reads what was learned earlier. Rows
    without a verdict or an id pass; so do those without a time, which the watermark cannot place. A batch is deduplicated by id alone."""
    known = F.col(polarity).isNotNull() & F.col(row_id).isNotNull() & F.col(time).isNotNull()
    named, rest = rows.filter(known), rows.filter(~known)
    named = named.withWatermark(time, within).dropDuplicatesWithinWatermark([row_id]) if rows.isStreaming else named.dropDuplicates([row_id])
    return rest.unionByName(named)


def policy_sink(root: str, key: str, score: str, time: str, row_id: str, polarity: str, bot: str | None = None, config: Config = Config(), saved: DataFrame | None = None, ttl_ms: int | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch callback that advances the policy by one micro-batch and writes state and telemetry under root. Give it a stream that has
    passed `once`, if verdicts may repeat.

    saved: a `snapshot` of another stream to start from, as `restored` accepts it. ttl_ms: a key that had no rows for so long starts anew."""

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        path = f"{root}/summaries/batch={n}"
        start = restored(saved, config) if saved is not None else None
        if not files.exists(spark, f"{path}/_SUCCESS"):
            old = snapshot(spark, root)
            old = start if old is None else old
            rows = batch.select(
                F.col(key).cast("string").alias("key"), F.col(score).cast("double").alias("p"), (F.col(bot).cast("double") if bot else F.lit(None).cast("double")).alias("bot"), F.col(time).alias("t"),
                F.col(row_id).cast("string").alias("id"), F.col(polarity).cast("int").alias("y"),
            ).filter(F.col("key").isNotNull())
            every = stage(rows, "batch")
            keys = every.select("key").distinct()
            state = initial(keys, config) if old is None else old.unionByName(initial(keys.join(old.select("key"), "key", "left_anti"), config))
            state = stage(state, "policy")
            summary = summarised(every, state, config).withColumnRenamed("s_key", "key").withColumn("batch", F.lit(n).cast("bigint"))
            summary.select(*[c.split()[0] for c in controller.SUMMARY.split(", ")]).write.mode("overwrite").parquet(path)
            unstage(every, state)
        controller.run(spark, f"{root}/summaries", root, config, start, ttl_ms)
        _forget(spark, f"{root}/summaries", n)

    return step


def _forget(spark: SparkSession, path: str, last: int) -> None:
    """Delete the summaries of batches that ended before the last one; only the last can run again."""
    for name in files.names(spark, path):
        if name.startswith("batch=") and int(name.split("=")[1]) < last:
            files.delete(spark, f"{path}/{name}")


def telemetry(spark: SparkSession, root: str) -> DataFrame:
    """A row for each key and micro-batch."""
    return spark.read.schema(controller.RECORD).option("recursiveFileLookup", True).parquet(f"{root}/telemetry")


def apply_policy(df: DataFrame, key: str, score: str, states: DataFrame) -> DataFrame:
    """Scores against each key's threshold: states(key, threshold) is joined, the test is a column."""
    return df.join(states.select(F.col("key").alias("_key"), "threshold"), F.col(key).cast("string") == F.col("_key"), "left").withColumn("alert", F.coalesce(F.col(score) >= F.col("threshold"), F.lit(False))).drop("_key")


def learning_status(telemetry: DataFrame, updated: str, now: str, stale_after: int = 120) -> DataFrame:
    """The newest record of each key with its age in seconds and whether it is stale."""
    last = telemetry.groupBy("key").agg(F.max_by(F.struct("threshold", "verdict", "batches"), updated).alias("s"), F.max(updated).alias("updated_at"))
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("updated_at")
    return last.select("key", "s.*", "updated_at", age.alias("age"), (age > stale_after).alias("stale"))
