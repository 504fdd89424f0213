import datetime as dt
import json
import math

import numpy as np
import pandas as pd
import pytest
from flowlab.sources import files, sinks, tables
from flowlab.sources.shared import shared_dir
from flowlab.streaming import adaptive, detection
from pyspark.sql import functions as F

SCHEMA = "srcip string, event_time string, bytes double, label string"


def stage(folder, name, rows):
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("srcip", "event_time", "bytes", "label"), r, strict=True))) for r in rows))


def at(second):
    return (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S")


def run(spark, df, folder, mode="append"):
    q = detection.start(df, lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/out/batch_id={n}"), f"{folder}/check", mode)
    q.awaitTermination()
    return q


def spikes(spark, source, least=2):
    df = detection.event_time(tables.scan_stream_json(spark, str(source), SCHEMA, 1))
    return detection.spikes(df, "srcip", "event_ts", "bytes", "label", "60 seconds", least, 4, 6)


def read(spark, folder):
    return spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/out")


def test_stream_equals_batch_and_late_rows_are_dropped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stage(source, "a.json", [("x", at(i), 1.0, "DoS") for i in (1, 2, 3, 4, 70)] + [("y", at(5), 1.0, "b"), ("y", at(6), 1.0, "a")])
    run(spark, spikes(spark, source), tmp_path)
    stage(source, "b.json", [("x", at(200), 1.0, "DoS")])
    run(spark, spikes(spark, source), tmp_path)  # goes on from the checkpoint
    stage(source, "c.json", [("x", at(2), 1.0, "late"), ("z", at(400), 1.0, "q"), ("z", at(401), 1.0, "q")])
    q = run(spark, spikes(spark, source), tmp_path)
    dropped = detection.late_rows(q)
    got = sorted((r["srcip"], r["connection_count"], r["attack_label"], r["severity"]) for r in read(spark, tmp_path).collect())
    assert got == [("x", 4, "DoS", "High"), ("y", 2, "a", "Medium")] and dropped >= 1


def test_restart_gives_no_duplicates(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stage(source, "a.json", [("x", at(i), float(i), "q") for i in range(10)])
    keys = spark.createDataFrame([("x",)], "srcip string")
    for _ in range(2):
        run(spark, detection.membership(tables.scan_stream_json(spark, str(source), SCHEMA), keys, "srcip"), tmp_path)
    assert read(spark, tmp_path).count() == 10


def uniform_mean(rng, n, shift=0.0):
    return np.clip(rng.random((n, 3)).mean(1) + shift, 0, 1)


def logit(p):
    p = min(1 - 1e-9, max(1e-9, p))
    return math.log(p / (1 - p))


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


class Fold:
    """The rules of the adaptive layer over one key, in plain Python, one micro-batch after another."""

    def __init__(self, c):
        self.c, self.t, self.w, self.sq, self.base, self.window = c, c.anchor, [0.0] * 5, [0.0] * 5, None, []
        self.b = self.streak = self.anchors = 0
        self.psi = self.ks = 0.0
        self.verdict, self.saturated, self.ids = "unobserved", False, set()

    def x(self, p, bot, base, psi):
        share = base[max(0, min(19, int(p * 20)))] if base else 1 / 20
        return [1.0, logit(p), 0.0 if bot is None else bot - 0.5, min(5.0, max(0.0, math.log(1 / max(share, 1e-3)))), min(1.0, max(0.0, psi))]

    def adapted(self, p, x):
        shift = max(-self.c.most_shift, min(self.c.most_shift, sum(a * b for a, b in zip(x, self.w))))
        return p if shift == 0 else sigmoid(logit(p) + shift)

    def batch(self, rows):
        """rows: (p, bot, t, id, y)"""
        c, (low, high), g = self.c, self.c.band(), [0.0] * 5
        alerts = verdicts = nominal = 0
        for p, bot, _, i, y in sorted(rows, key=lambda r: (r[2], r[0])):
            x, plain = self.x(p, bot, self.base, self.psi), self.x(p, None, self.base, self.psi)
            alerts += self.adapted(p, x) >= self.t
            if y is not None and i not in self.ids:
                self.ids.add(i)
                verdicts += 1
                e = sigmoid(sum(a * b for a, b in zip(x, self.w))) - y
                g = [a + e * b for a, b in zip(g, x)]
            if p <= c.margin * self.t and self.verdict != "severe":
                nominal += 1
                e = sigmoid(sum(a * b for a, b in zip(plain, self.w))) * c.nominal_weight
                g = [a + e * b for a, b in zip(g, plain)]
        self.window = (self.window + [r[0] for r in sorted(rows, key=lambda r: (r[2], r[3], r[0]))[-c.window :]])[-c.window :]
        now = np.bincount([max(0, min(19, int(p * 20))) for p in self.window], minlength=20) / len(self.window)
        self.base = self.base or list(now)
        r, o = np.maximum(self.base, 1e-4), np.maximum(now, 1e-4)
        self.psi, self.ks, self.b = float(((o - r) * np.log(o / r)).sum()), float(np.abs(np.cumsum(now - np.array(self.base))).max()), self.b + 1
        self.verdict = "severe" if self.psi >= 0.5 else "shift" if self.psi >= 0.25 or self.ks >= 0.15 else "stable"
        self.streak = self.streak + 1 if self.verdict != "stable" and self.b > c.warmup else 0
        if self.streak >= c.patience:
            self.base = list((1 - c.blend) * np.array(self.base) + c.blend * now)
            self.streak, self.verdict, self.anchors = 0, "stable", self.anchors + 1
        if len(self.window) >= c.least_window and self.b > c.warmup:
            target = float(np.quantile([self.adapted(p, self.x(p, None, self.base, self.psi)) for p in self.window], 1 - c.budget))
            held = min(high, max(low, target))
            self.saturated = abs(held - target) > 1e-9
            self.t = min(high, max(low, self.t + c.step * (held - self.t)))
        if verdicts + nominal:
            g = [a / (verdicts + nominal) + c.l2 * w for a, w in zip(g, self.w)]
            self.sq = [s + a * a for s, a in zip(self.sq, g)]
            self.w = [(w - c.rate * a / (math.sqrt(s) + 1e-8)) * (1 - c.decay) for w, a, s in zip(self.w, g, self.sq)]
        return {"n": len(rows), "alerts": alerts, "threshold": self.t, "psi": self.psi, "ks": self.ks, "verdict": self.verdict, "anchors": self.anchors, "saturated": self.saturated, "shift": math.sqrt(sum(w * w for w in self.w)), "learned": verdicts, "nominal": nominal}


ROWS = "k string, p double, bot double, t bigint, id bigint, y int"


def batches(seed, n_batches, shift_from):
    rng, out, i = np.random.default_rng(seed), [], 0
    for n in range(n_batches):
        rows = []
        for k, shift in (("a", 0.0), ("b", 0.35 if n >= shift_from else 0.0)):
            for p in uniform_mean(rng, 120, shift) * (0.05 if k == "a" and n % 2 else 1.0):
                i += 1
                rows.append((k, float(p), float(rng.random()) if i % 3 else None, i, i, int(p > 0.5) if i % 17 == 0 else None))
        rows += [r for r in rows if r[5] is not None][:2]  # a verdict that comes twice
        out.append(rows)
    return out


def deduplicated(given):
    """What `once` leaves of batches."""
    seen, out = set(), []
    for rows in given:
        kept = []
        for r in rows:
            if r[5] is None or r[4] not in seen:
                kept.append(r)
            if r[5] is not None:
                seen.add(r[4])
        out.append(kept)
    return out


def advance(spark, root, given, first=0, config=None):
    sink = adaptive.policy_sink(str(root), "k", "p", "t", "id", "y", "bot", config or adaptive.Config())
    for n, rows in enumerate(given, first):
        sink(spark.createDataFrame(rows, ROWS), n)


def test_policy_against_a_plain_fold(spark, tmp_path):
    """Telemetry of every micro-batch, with verdicts and drift; also where workers get other batches, where a batch runs
    twice, and after a restart."""
    c = adaptive.Config(window=300, least_window=100, warmup=1, patience=2)
    given = deduplicated(batches(1, 20, 8))
    advance(spark, tmp_path / "one", given, config=c)
    got = {(r["key"], r["batch"]): r.asDict() for r in adaptive.telemetry(spark, str(tmp_path / "one")).collect()}
    for k in "ab":
        fold = Fold(c)
        for n, rows in enumerate(given):
            mine = got[k, n]
            for name, want in fold.batch([r[1:] for r in rows if r[0] == k]).items():
                assert mine[name] == (pytest.approx(want, abs=1e-9) if isinstance(want, float) else want), (k, n, name)
    assert not [n for n in files.names(spark, f"{shared_dir(spark)}/flowlab") if n.startswith("batch-")]  # what a batch staged is gone
    assert any(r["anchors"] for r in got.values()) and any(r["nominal"] for r in got.values()) and any(r["learned"] for r in got.values())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    advance(spark, tmp_path / "two", given[:2], config=c)
    advance(spark, tmp_path / "two", given[1:4], 1, config=c)  # batch 1 runs again
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    again = {(r["key"], r["batch"]): r.asDict() for r in adaptive.telemetry(spark, str(tmp_path / "two")).collect()}
    assert again.keys() == {(k, n) for k in "ab" for n in range(4)}
    assert all(again[k][name] == pytest.approx(got[k][name], abs=1e-9) if isinstance(v, float) else again[k][name] == v for k in again for name, v in got[k].items())


def test_snapshot_and_tolerant_restore(spark, tmp_path):
    advance(spark, tmp_path, batches(2, 1, 9))
    state = adaptive.snapshot(spark, str(tmp_path))
    assert sorted(r["key"] for r in state.collect()) == ["a", "b"] and adaptive.snapshot(spark, str(tmp_path / "none")) is None
    same = adaptive.restored(state, adaptive.Config())
    assert sorted(map(repr, same.collect())) == sorted(map(repr, state.select(same.columns).collect()))
    c = adaptive.Config(anchor=0.4, ceiling=0.45)
    old = spark.createDataFrame([("x", 0.9, [1.0], 7), ("y", float("nan"), [0.1] * 5, None), (None, 0.3, [0.0] * 5, 1)], "key string, threshold double, weights array<double>, batches bigint")
    got = {r["key"]: r for r in adaptive.restored(old, c).collect()}
    assert set(got) == {"x", "y"} and got["x"]["threshold"] == 0.45 and got["y"]["threshold"] == 0.4
    assert got["x"]["weights"] == [0.0] * 5 and got["y"]["weights"] == [0.1] * 5 and (got["x"]["batches"], got["y"]["batches"]) == (7, 0)


def test_prefilter_drops_nothing_the_gate_keeps(spark):
    c = adaptive.Config()
    df = spark.range(501).select((F.col("id") / 500).alias("p"))
    w = F.array(*[F.lit(x) for x in (1.0, -0.2, 0.3, 0.4, 0.1)])
    a = adaptive.adapted(F.col("p"), adaptive.features(F.col("p"), F.lit(0.9), F.array().cast("array<double>"), F.lit(0.3)), w, c)
    low = 1 / (1 + math.exp(-(math.log(0.4 / 0.6) - c.most_shift)))
    assert df.filter((a >= 0.4) & (F.col("p") < low - 1e-12)).isEmpty()


def test_no_evidence_no_change_and_band(spark, tmp_path):
    c = adaptive.Config(anchor=0.5, ceiling=0.95, margin=0.0)
    rng = np.random.default_rng(2)
    given = [[("a", float(p), None, 300 * n + i, 300 * n + i, None) for i, p in enumerate(uniform_mean(rng, 300, 0.15))] for n in range(9)]
    advance(spark, tmp_path, given, config=c)
    state = adaptive.snapshot(spark, str(tmp_path)).first()
    assert state["weights"] == [0.0] * 5 and 0.5 < state["threshold"] < 0.95
    low, high = adaptive.Config().band()
    assert low == pytest.approx(0.5 * 0.257502) and high == pytest.approx(0.493131)


def test_policy_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    given = batches(3, 3, 1)
    for rows in given[1:]:
        rows += [r for r in given[0] if r[5] is not None]  # verdicts of the first batch come again
    sink = adaptive.policy_sink(str(tmp_path / "policy"), "k", "p", "t", "id", "y", "bot")
    for n, rows in enumerate(given):
        pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")]).astype({"y": "Int64"}).to_json(tmp_path / "in" / f"{n}.json", orient="records", lines=True)
        source = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")).withColumn("t", F.timestamp_seconds("t"))
        detection.start(adaptive.once(source, "id", "t", "y"), sink, f"{tmp_path}/check").awaitTermination()
    got = {(r["key"], r["batch"]): r for r in adaptive.telemetry(spark, str(tmp_path / "policy")).collect()}
    assert set(got) == {(k, n) for k in "ab" for n in range(3)}
    kept = deduplicated(given)
    assert [sum(got[k, n]["n"] for k in "ab") for n in range(3)] == list(map(len, kept))
    assert [sum(got[k, n]["learned"] for k in "ab") for n in range(3)] == [sum(r[5] is not None for r in rows) for rows in kept]
    # what was read and is done with is deleted
    assert [p.name for p in (tmp_path / "policy" / "summaries").iterdir()] == ["batch=2"]



def test_sink_callback_tags_rows(spark, tmp_path):
    sinks.alert_sink(str(tmp_path / "t"), "bloom", lambda b: b.filter("id < 2"))(spark.range(5), 7)
    rows = spark.read.parquet(str(tmp_path / "t")).select("id", "type", "created_at", F.col("batch_id")).collect()
    assert sorted(r["id"] for r in rows) == [0, 1] and {r["type"] for r in rows} == {"bloom"} and {r["batch_id"] for r in rows} == {7}
