"""The state of the adaptive policy in Spark's own state store: transformWithState over one summary for each key and micro-batch.

The value state of a key is its policy. A micro-batch reaches it as one row that Spark has aggregated, so what a task does for a key does not
grow with its rows. Checkpoints, recovery and expiry are the engine's; snapshots are read with the state data source, and a saved
one starts another stream as its initial state.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowlab.sources import files

BINS, EDGE, FEATURES = 20, 1e-9, 5
POLICY = "threshold double, weights array<double>, squares array<double>, baseline array<double>, window array<double>, batches int, streak int, anchors int, psi double, ks double, verdict string, saturated boolean, learned bigint"
FIELDS = [x.split()[0] for x in POLICY.split(", ")]
VALUE = f"{POLICY}, batch bigint"
SUMMARY = "key string, batch bigint, n bigint, alerts bigint, verdicts bigint, nominal bigint, g array<double>, recent array<double>"
RECORD = "key string, batch bigint, batches int, n bigint, alerts bigint, threshold double, psi double, ks double, verdict string, anchors int, saturated boolean, shift double, learned bigint, nominal bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Config:
    """The defaults of the adaptive layer."""

    anchor: float = 0.257502
    ceiling: float = 0.493131
    lower: float = 0.5
    upper: float = 4.0
    budget: float = 0.05
    step: float = 0.25
    window: int = 2000
    least_window: int = 200
    warmup: int = 3
    patience: int = 5
    blend: float = 0.25
    rate: float = 0.08
    l2: float = 2e-3
    decay: float = 0.01
    most_shift: float = 1.5
    margin: float = 0.10
    nominal_weight: float = 0.25

    def band(self) -> tuple[float, float]:
        low = self.anchor * self.lower
        return low, max(low, min(self.anchor * self.upper, self.ceiling))


def fresh(c: Config) -> dict:
    """The policy of a key that was never seen."""
    none = np.zeros(0)
    return dict(zip(FIELDS, (c.anchor, np.zeros(FEATURES), np.zeros(FEATURES), none, none, 0, 0, 0, 0.0, 0.0, "unobserved", False, 0), strict=True))


def _shares(scores: np.ndarray) -> np.ndarray:
    return np.bincount(np.clip((scores * BINS).astype(int), 0, BINS - 1), minlength=BINS) / max(len(scores), 1)


def _adapted(scores: np.ndarray, policy: dict, c: Config) -> np.ndarray:
    """Scores of the window (which have no bot probability) with the residual."""
    p = np.clip(scores, EDGE, 1 - EDGE)
    odds = np.log(p / (1 - p))
    share = policy["baseline"][np.clip((scores * BINS).astype(int), 0, BINS - 1)]
    rare = np.clip(np.log(1 / np.maximum(share, 1e-3)), 0, 5)
    w = policy["weights"]
    shift = np.clip(w[0] + w[1] * odds + w[3] * rare + w[4] * min(max(policy["psi"], 0.0), 1.0), -c.most_shift, c.most_shift)
    return np.where(shift == 0, scores, 1 / (1 + np.exp(-odds - shift)))


def advanced(policy: dict, summary: dict, c: Config) -> dict:
    """The policy after the summary of a micro-batch.

    The window takes the new scores; drift is that of the window against the baseline (the first window). A shift that lasts
    `patience` batches moves the baseline; the threshold takes a step toward the quantile of adapted scores that meets the budget,
    inside the band; the weights take one AdaGrad step on the mean gradient of the batch, and decay."""
    low, high = c.band()
    new = dict(policy)
    new["batches"] = policy["batches"] + 1
    new["window"] = np.concatenate([policy["window"], summary["recent"]])[-c.window :]
    now = _shares(new["window"])
    if not len(policy["baseline"]):
        new["baseline"] = now
    r, o = np.maximum(new["baseline"], 1e-4), np.maximum(now, 1e-4)
    new["psi"], new["ks"] = float(((o - r) * np.log(o / r)).sum()), float(np.abs(np.cumsum(now - new["baseline"])).max())
    new["verdict"] = "severe" if new["psi"] >= 0.5 else "shift" if new["psi"] >= 0.25 or new["ks"] >= 0.15 else "stable"
    new["streak"] = policy["streak"] + 1 if new["verdict"] != "stable" and new["batches"] > c.warmup else 0
    if new["streak"] >= c.patience:
        new["baseline"] = (1 - c.blend) * new["baseline"] + c.blend * now
        new["streak"], new["verdict"], new["anchors"] = 0, "stable", policy["anchors"] + 1
    if len(new["window"]) >= c.least_window and new["batches"] > c.warmup:
        target = float(np.quantile(_adapted(new["window"], new, c), 1 - c.budget))
        held = min(max(target, low), high)
        new["saturated"] = abs(held - target) > 1e-9
        new["threshold"] = min(max(policy["threshold"] + c.step * (held - policy["threshold"]), low), high)
    rows = summary["verdicts"] + summary["nominal"]
    if rows:
        grad = summary["g"] / rows + c.l2 * policy["weights"]
        new["squares"] = policy["squares"] + grad * grad
        new["weights"] = (policy["weights"] - c.rate * grad / (np.sqrt(new["squares"]) + 1e-8)) * (1 - c.decay)
    new["learned"] = policy["learned"] + summary["verdicts"]
    return new


def _plain(value):
    return [float(x) for x in value] if isinstance(value, np.ndarray) else value.item() if isinstance(value, np.generic) else value


def _arrays(policy: dict) -> dict:
    return {k: np.array(v, float) if isinstance(v, (list, tuple, np.ndarray)) else v for k, v in policy.items()}


class Controller(StatefulProcessor):
    """One policy for each key. A summary whose batch was applied before is left out, so a summary that comes again changes nothing."""

    def __init__(self, config: Config, ttl_ms: int | None = None):
        self.config, self.ttl_ms = config, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.policy = handle.getValueState("policy", VALUE, self.ttl_ms)

    def handleInitialState(self, key, initial: pd.DataFrame, timers) -> None:  # noqa: N802
        row = initial.iloc[0]
        self.policy.update((*[_plain(row[f]) for f in FIELDS], -1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:  # noqa: N802
        c = self.config
        found = self.policy.get() if self.policy.exists() else None
        policy, last = (_arrays(dict(zip(FIELDS, found, strict=False))), found[-1]) if found else (fresh(c), -1)
        out = []
        for s in sorted((r for df in rows for r in df.to_dict("records")), key=lambda r: r["batch"]):
            if s["batch"] <= last:
                continue
            policy, last = advanced(policy, _arrays(s), c), s["batch"]
            norm = float(np.sqrt((policy["weights"] ** 2).sum()))
            out.append((key[0], s["batch"], policy["batches"], s["n"], s["alerts"], policy["threshold"], policy["psi"], policy["ks"], policy["verdict"], policy["anchors"], policy["saturated"], norm, s["verdicts"], s["nominal"]))
        self.policy.update((*[_plain(policy[f]) for f in FIELDS], int(last)))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in RECORD.split(", ")])

    def close(self) -> None:
        pass


def run(spark: SparkSession, summaries: str, root: str, config: Config, initial: DataFrame | None = None, ttl_ms: int | None = None) -> None:
    """Take every summary under a folder that was not taken yet; state is kept in root/state, telemetry goes to root/telemetry.
    initial(key, POLICY) is read when the stream starts for the first time."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        source = spark.readStream.schema(SUMMARY).option("recursiveFileLookup", True).parquet(summaries).groupBy("key")
        mode = "ProcessingTime" if ttl_ms else "None"
        start = initial.select("key", *FIELDS).groupBy("key") if initial is not None else None
        records = source.transformWithStateInPandas(Controller(config, ttl_ms), RECORD, "append", mode, start)
        sink = lambda df, n: df.write.mode("overwrite").parquet(f"{root}/telemetry/version={n}")
        records.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER, old) if old else spark.conf.unset(PROVIDER)


def stored(spark: SparkSession, root: str) -> DataFrame | None:
    """(key, POLICY, batch) as the state store holds it after the last finished batch, or None before the first one."""
    if not files.exists(spark, f"{root}/state/commits/0"):
        return None
    return spark.read.format("statestore").option("stateVarName", "policy").load(f"{root}/state").select(F.col("key.key").alias("key"), *[F.col(f"value.{f}").alias(f) for f in [*FIELDS, "batch"]])
