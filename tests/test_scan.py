"""Prefix scans against plain loops, with keys that reach over many parts."""

import math
import random

import pytest
from flowlab.operators import drift, scan
from pyspark.sql import functions as F


def plain_ema(values, alpha):
    m = None
    for x in values:
        if x is not None and x == x:
            m = x if m is None else m + alpha * (x - m)
        yield None if m is None else round(m, 6)


@pytest.fixture
def rows():
    rng = random.Random(2)
    out = [("long", i, rng.choice([None, float("nan"), rng.random(), rng.random()])) for i in range(3000)]
    out += [("short", i, rng.random()) for i in range(3)] + [(None, i, rng.random()) for i in range(40)] + [("none", 0, None), ("one", None, 2.0)]
    rng.shuffle(out)
    return out


def test_means_of_long_keys(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, x double")
    got = {(r["k"], r["t"]): r["ema"] for r in drift.ema_running(df, "k", "t", "x", 0.1, rows=150).collect()}
    last = {r["k"]: r["ema"] for r in drift.ema(df, "k", "t", "x", 0.1, rows=150).collect()}
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: -1 if r[1] is None else r[1])
        want = list(plain_ema([r[2] for r in own], 0.1))
        assert [got[k, r[1]] for r in own] == pytest.approx(want, abs=2e-6, nan_ok=True) or all((a is None) == (b is None) and (a is None or abs(a - b) < 2e-6) for a, b in zip([got[k, r[1]] for r in own], want, strict=True))
        assert (last[k] is None) == (want[-1] is None) and (last[k] is None or abs(last[k] - want[-1]) < 2e-6)


def test_streaks_across_parts(spark):
    rng = random.Random(4)
    verdicts = [rng.choice(["stable", "shift"]) if i % 500 < 100 else "severe" for i in range(2500)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(verdicts)], "k string, w int, verdict string")
    run = 0
    got = {r["w"]: (r["streak"], r["act"]) for r in drift.streaks(df, "k", "w", 5, rows=130).collect()}
    for i, v in enumerate(verdicts):
        run = run + 1 if v != "stable" else 0
        assert got[i] == (run, run > 0 and run % 5 == 0)
    assert max(r for r, _ in got.values()) > 400


def test_one_key_is_many_tasks_and_nothing_stays_nothing(spark):
    df = spark.range(2000).select(F.lit("k").alias("k"), F.col("id").alias("t"), F.col("id").cast("double").alias("x"))
    out = scan.prefix_scan(df, ["k"], ["t"], scan.run_lengths(F.lit(True)), "r", rows=100)
    assert [r["n"] for r in out.agg(F.max("r.run").alias("n")).collect()] == [2000]
    parts = df.repartitionByRange(20, "k", "t").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 300
    assert drift.streaks(spark.createDataFrame([], "k string, w int, verdict string"), "k", "w").count() == 0


def test_means_are_those_of_a_loop_to_the_last_bit(spark):
    rng = random.Random(7)
    rows = [("prices", i, rng.choice([None, float("nan"), round(rng.expovariate(0.02), 2)]) if i % 9 == 0 else round(rng.expovariate(0.02), 2)) for i in range(4000)]
    rows += [("constant", i, 8.35215) for i in range(1000)] + [(None, i, float(i)) for i in range(300)] + [("none", i, None) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, x double")
    got = {(r["k"], r["t"]): r["m"] for r in scan.run_exactly(df, ["k"], ["t"], "x", 0.05, "m", rows=130).collect()}
    assert len(got) == len(rows)
    last = {}
    for k, t, x in rows:
        if x is not None and x == x:
            last[k] = last[k] + 0.05 * (x - last[k]) if k in last else x
        assert got[k, t] == last.get(k)


def test_means_are_rounded_once(spark):
    rows = [("k", 0, 6.55), ("k", 1, 12.31), ("k", 2, 36.29), ("twice", 0, 0.1234499)]  # 0.12345 when rounded to 6 digits
    df = spark.createDataFrame(rows, "k string, t int, x double")
    m = 6.55 + 0.05 * (12.31 - 6.55)
    m = m + 0.05 * (36.29 - m)
    got = {(r["k"], r["t"]): r["ema"] for r in drift.ema_running(df, "k", "t", "x", 0.05, digits=4).collect()}
    assert got["twice", 0] == 0.1234 and got["k", 2] == math.floor(m * 10_000 + 0.5) / 10_000
