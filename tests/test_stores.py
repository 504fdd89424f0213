"""Stores that change in part: keyed buckets, dated tables, zone maps, the ledger of files, late rows; and summaries of frequent values."""

import collections
import datetime as dt
import os
import random
import time

import pytest
from flowlab.operators import heavy
from flowlab.sources import alerts, files, keyed, ledger, sinks
from flowlab.streaming import late
from pyspark.sql import functions as F

KV = "k int, v int, x string"


def mtimes(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path, rng, want = str(tmp_path / "s"), random.Random(1), {}
    for n in range(6):
        rows = [(k, rng.randint(0, 99), f"b{n}") for k in (range(200) if n == 0 else rng.sample(range(200), 3))] + [(None, n, "null key")]
        before = keyed.manifest(spark, path)
        touched = keyed.upsert_state(spark.createDataFrame(rows, KV), path, ["k"], "v", n, 16)
        after = keyed.manifest(spark, path)
        for k, v, x in rows:
            want[k] = max(want.get(k, (-1, "")), (v, x))
        if before:
            assert len(touched) <= 4
            assert {b for b in after["folders"] if before["folders"].get(b) != after["folders"][b]} == set(map(str, touched))
        got = keyed.latest_state(spark, path, ["k"], "v")
        assert {r["k"]: (r["v"], r["x"]) for r in got.collect()} == want
    now = keyed.manifest(spark, path)
    assert keyed.upsert_state(spark.createDataFrame([(1, 10**6, "again")], KV), path, ["k"], "v", 5) == [] and keyed.manifest(spark, path) == now
    assert keyed.upsert_state(spark.createDataFrame([], KV), path, ["k"], "v", 6) == []
    # a new column is null in older rows; old folders and manifests are gone
    keyed.upsert_state(spark.createDataFrame([(1, 10**6, "new", 2.5)], KV + ", y double"), path, ["k"], "v", 7)
    got = {r["k"]: r["y"] for r in keyed.latest_state(spark, path, ["k"], "v").collect()}
    assert got[1] == 2.5 and got[2] is None and len(got) == 201
    assert len(files.names(spark, f"{path}/manifests")) == keyed.KEPT
    used = {f for n in files.names(spark, f"{path}/manifests") for f in __import__("json").loads(files.read_text(spark, f"{path}/manifests/{n}"))["folders"].values()}
    stored = {f"{g}/{b}" for g in files.names(spark, f"{path}/data") for b in files.names(spark, f"{path}/data/{g}") if b.startswith("bucket=")}
    assert stored == used


def test_two_writers_one_fails(spark, tmp_path):
    files.create_text(spark, f"{tmp_path}/m/0.json", "a")
    with pytest.raises(FileExistsError):
        files.create_text(spark, f"{tmp_path}/m/0.json", "b")
    assert files.read_text(spark, f"{tmp_path}/m/0.json") == "a"


def test_expiry_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=i)) for i in range(24 * 6)] + [(999, None)]
    sinks.write_dated(spark.createDataFrame(rows, "id int, ts timestamp"), path, "ts")
    before = mtimes(path)
    done = sinks.expire(spark, path, "ts", "2024-01-05 12:00:00", 48)
    assert done == {"dropped": ["day=2024-01-01", "day=2024-01-02"], "rewritten": ["day=2024-01-03"]}
    after = mtimes(path)
    assert all(after[f] == t for f, t in before.items() if any(d in f for d in ("01-04", "01-05", "01-06", "HIVE")))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [*range(60, 144), 999]
    again = sinks.expire(spark, path, "ts", "2024-01-05 12:00:00", 48)
    assert again == {"dropped": [], "rewritten": []}
    assert sinks.expire(spark, path, "ts", "2024-02-01 00:00:00", 1)["dropped"] == ["day=2024-01-03", "day=2024-01-04", "day=2024-01-05", "day=2024-01-06"]
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [999]


def test_newest_rows_open_few_files(spark, tmp_path):
    rng, path, every = random.Random(3), str(tmp_path / "a"), []
    for n in range(12):
        rows = [(n * 100 + i, dt.datetime(2024, 1, 1 + n) + dt.timedelta(hours=rng.randint(-6, 23))) for i in range(20)] + [(n * 100 + 50, None)]
        every += rows
        alerts.append(spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1), path, "ts", n)
    alerts.append(spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1), path, "ts", 11)  # a batch that runs again
    timed = sorted((r for r in every if r[1]), key=lambda r: (-r[1].timestamp(), r[0]))
    for k, most in ((1, 2), (15, 2), (30, 6), (1000, 12)):
        got, opened = alerts.recent(spark, path, "ts", "id", k)
        assert [(r["id"], r["ts"]) for r in got.orderBy(F.desc("ts"), "id").collect()] == timed[:k]
        assert opened <= most
    assert alerts.rows(spark, path).count() == len(every)
    for after, most in ((None, 12), (dt.datetime(2024, 1, 11, 12), 3), (dt.datetime(2025, 1, 1), 0)):
        got, opened = alerts.since(spark, path, "ts", after)
        assert sorted(r["id"] for r in got.collect()) == sorted(i for i, t in every if t and (after is None or t > after)) and opened <= most


def test_graph_versions(spark, tmp_path):
    for n in range(4):
        sinks.write_graph({"nodes": spark.range(n + 1), "edges": spark.range(n)}, str(tmp_path))
        assert sinks.read_graph(spark, str(tmp_path), "nodes").count() == n + 1
    assert len(list(tmp_path.iterdir())) == 3  # two versions and their list


def test_ledger_resumes_and_replaces(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(5):
        (source / f"{i}.csv").write_text(f"{i}\n{i}\n")
    read = lambda s, paths: s.read.schema("x int").csv(paths)

    def crash(n):
        if n == 1:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        ledger.append_new(spark, str(source), out, read, "*.csv", 2, crash)
    assert ledger.entered(spark, out).count() == 2  # the second step was written, not entered
    assert ledger.append_new(spark, str(source), out, read, "*.csv", 2) == 3
    assert sorted(r["x"] for r in ledger.corpus(spark, out).collect()) == sorted([*range(5)] * 2)
    assert ledger.append_new(spark, str(source), out, read, "*.csv") == 0
    time.sleep(0.01)
    (source / "3.csv").write_text("33\n")
    (source / "5.csv").write_text("5\n")
    assert ledger.append_new(spark, str(source), out, read, "*.csv") == 2
    assert sorted(r["x"] for r in ledger.corpus(spark, out).collect()) == [0, 0, 1, 1, 2, 2, 4, 4, 5, 33]


def test_late_rows_are_kept(spark, tmp_path):
    root, schema = str(tmp_path), "id int, ts timestamp"
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    given = [[(1, at(0)), (2, at(500))], [(3, at(10)), (4, at(395)), (5, at(405)), (6, None)], [(7, at(100)), (8, at(900))], [(9, at(700))]]
    split = late.part(root, "ts", 100, 60)
    for n, rows in enumerate(given):
        split(spark.createDataFrame(rows, schema), n)
    split(spark.createDataFrame(given[3], schema), 3)  # runs again
    kept, gone = late.both(spark, root, schema)
    # watermarks: none, 400, 400, 800; 395 and 405 lie in windows that end at 420
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 4, 5, 6, 8] and {r["id"]: r["late_seconds"] for r in gone.collect()} == {3: 390.0, 7: 300.0, 9: 100.0}


@pytest.mark.parametrize("counters", [4, 50, 10_000])
def test_frequent_values(spark, counters):
    rng = random.Random(counters)
    values = [int(rng.paretovariate(0.7)) % 5000 for _ in range(20_000)] + [None] * 100
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    n = collections.Counter(v for v in values if v is not None)
    for k in (1, 7, 40):
        kth = sorted(n.values())[-k]
        assert {r["value"]: r["n"] for r in heavy.frequent(df, "v", k, counters).collect()} == {v: c for v, c in n.items() if c >= kth}
        assert [(r["value"], r["n"]) for r in heavy.top_values(df, "v", k, counters).collect()] == sorted(n.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_frequent_values_of_flat_and_empty_tables(spark):
    flat = spark.range(3000).select(F.col("id").cast("string").alias("v"))
    assert heavy.frequent(flat, "v", 3, 8).count() == 3000 and heavy.top_values(flat, "v", 3, 8).count() == 3
    assert heavy.top_values(flat.limit(0), "v", 3).count() == 0
