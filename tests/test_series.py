import datetime as dt

import numpy as np
import pytest
from flowlab.operators import feeds, timeseries
from pyspark.sql import functions as F


def test_grid_sizes_and_alignment(spark):
    for minutes, seconds, n in ((60, 10, 361), (60, 60, 61), (5, 10, 31), (5, 60, 6), (0, 10, 1)):
        g = [r["bucket"] for r in timeseries.grid(spark, "2024-01-01 00:00:07", minutes, seconds).collect()]
        assert len(g) == n and g[0] == dt.datetime(2024, 1, 1)
    labels = [r["l"] for r in timeseries.grid(spark, "2024-01-01 00:00:00", 60, 10).select(timeseries.bucket_label(F.col("bucket"), 10).alias("l")).collect()]
    assert len(set(labels)) == len(labels) and sorted(labels) == labels and labels[1].endswith(":10")


def test_first_seen(spark):
    df = spark.createDataFrame([(" 2024-01-01 10:00:00 ",), ("garbage",), (None,)], "t string")
    assert [r["x"] for r in df.select(timeseries.first_seen(F.col("t")).alias("x")).collect()] == [dt.datetime(2024, 1, 1, 10), None, None]


def series(spark, values):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(start + dt.timedelta(seconds=10 * i), f, float(v)) for f, vs in values.items() for i, v in enumerate(vs)], "bucket timestamp, family string, value double")


def test_lag_of_a_shifted_series(spark):
    x = np.random.default_rng(1).random(80)
    s = series(spark, {"a": x, "b": np.concatenate([[0, 0, 0], x[:-3]])})
    r = timeseries.best_lag(timeseries.lag_correlation(s, 10)).first()
    assert (r["x"], r["y"], r["lag"]) == ("a", "b", 3) and r["r"] > 0.99
    assert "a leads b by 30 s" in timeseries.narrative(timeseries.best_lag(timeseries.lag_correlation(s, 10)), 10).first()["sentence"]
    flat = timeseries.pearson(series(spark, {"a": [1] * 5, "b": [1, 2, 3, 4, 5]})).first()
    assert flat["r"] == 0


def test_stft_against_numpy(spark):
    x = np.sin(2 * np.pi * 3 * np.arange(48) / 16) + 0.1 * np.arange(48)
    got = {(r["frame"], r["bin"]): r["db"] for r in timeseries.stft(series(spark, {"a": x}), 10).collect()}
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(16) / 15)
    mags = np.array([np.abs(np.fft.rfft((x[h : h + 16] - x[h : h + 16].mean()) * hann)) for h in range(0, 33, 8)])
    want = 20 * np.log10(np.maximum(mags, mags.max() * 1e-6) / mags.max())
    assert len(got) == want.size
    for (f, b), db in got.items():
        assert db == pytest.approx(want[f, b], abs=1e-3)


def test_surge_and_shape(spark):
    s = series(spark, {"quiet": [0] * 20, "burst": [0] * 18 + [50, 60], "steady": [10, 11] * 10})
    shapes = {r["family"]: r["shape"] for r in timeseries.shape(s).collect()}
    assert shapes == {"quiet": "silent", "burst": "burst", "steady": "steady"}
    assert {r["family"]: r["surge"] for r in timeseries.surge(s).collect()}["burst"] is None
    p = timeseries.aggregate_peak(s).first()
    assert (p["peak"], p["from_end"]) == (71.0, 0)


def radar(spark, rows):
    return spark.createDataFrame([(i, b, ip, dt.datetime(2024, 1, 1, 12) - dt.timedelta(minutes=m)) for i, (b, ip, m) in enumerate(rows)], "id bigint, severity string, src_ip string, created_at timestamp")


def test_banded_sample(spark):
    bands = ["Critical", "High", "Medium"]
    full = radar(spark, [(b, f"10.0.0.{i}", 1) for b in bands for i in range(9)])
    got = feeds.banded_sample(full, "severity", bands, "created_at", "src_ip", 9, 30).collect()
    assert sorted(r["severity"] for r in got) == sorted(bands * 3)
    assert {r["src_ip"] for r in got} == {"10.0.0.0", "10.0.0.1", "10.0.0.2"} and {r["window_minutes"] for r in got} == {30}
    missing = radar(spark, [("High", f"10.0.0.{i}", 1) for i in range(5)])
    assert feeds.banded_sample(missing, "severity", bands, "created_at", "src_ip", 9, 30).count() == 3
    stale = radar(spark, [("Low", "x", 0), ("High", "y", 500)])
    assert [(r["src_ip"], r["window_minutes"]) for r in feeds.banded_sample(stale, "severity", bands, "created_at", "src_ip", 9, 30).collect()] == [("y", None)]


def test_quotas():
    assert feeds.feed_quotas(30) == {"nominal": 10, "spike": 5, "bloom": 2, "ml": 13}
