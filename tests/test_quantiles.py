import random

import numpy as np
import pytest
from flowlab.operators import metrics, quantiles
from pyspark.sql import functions as F


def test_exact_quantiles_against_numpy(spark, monkeypatch):
    """Small accuracy and few parts, so that brackets hold part of the values; ties, signs, nulls and groups of any size."""
    monkeypatch.setattr(quantiles, "ACCURACY", 100)  # groups of over 1,000 values are bracketed
    monkeypatch.setattr(quantiles, "PARTS", 8)
    rng = random.Random(1)
    make = {"a": lambda: rng.gauss(0, 1), "b": lambda: float(rng.randint(0, 3)), "c": lambda: 10 ** rng.uniform(-9, 9), None: lambda: -5.0, "one": lambda: 7.0}
    rows = [(g, f()) for g, f in make.items() for _ in range(1 if g == "one" else 3000)] + [("a", None), ("none", None)]
    shares = [0.0, 0.001, 0.25, 0.5, 0.777, 0.95, 1.0]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["i"]): r["quantile"] for r in quantiles.exact_quantiles(df, ["g"], "v", shares).collect()}
    for g in make:
        v = [x for k, x in rows if k == g and x is not None]
        for i, q in enumerate(shares):
            assert got.pop((g, i)) == pytest.approx(np.quantile(v, q), rel=1e-12), (g, q)
    assert not got
    every = [x for _, x in rows if x is not None]
    assert [r["quantile"] for r in quantiles.exact_quantiles(df, [], "v", [0.5]).collect()] == [pytest.approx(np.quantile(every, 0.5), rel=1e-12)]
    assert quantiles.exact_quantiles(df.limit(0), [], "v", [0.5]).collect() == []


def test_rank_auc_over_many_values(spark):
    rng = random.Random(2)
    rows = [(rng.random() < 0.3, rng.gauss(0, 1), float(rng.randint(0, 5))) for _ in range(2000)]
    rows = [(t, x + 0.5 * t, y) for t, x, y in rows]
    got = {r["feature"]: r["auc"] for r in metrics.rank_auc(spark.createDataFrame(rows, "t boolean, x double, y double"), ["x", "y"], F.col("t")).collect()}
    for i, f in ((1, "x"), (2, "y")):
        pos, neg = np.array([r[i] for r in rows if r[0]]), np.array([r[i] for r in rows if not r[0]])
        assert got[f] == pytest.approx(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)), abs=1e-6)


def test_rows_do_not_move_by_group(spark):
    """With automatic broadcast off, as the estimate of a great table would have it: rows meet the brackets and cuts of their group where they are."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") % 997).cast("double").alias("v"))
        got = {r["g"]: r["quantile"] for r in quantiles.exact_quantiles(df, ["g"], "v", [0.5]).collect()}
        assert set(got) == {0, 1, 2}
        plan = quantiles.range_parts(df, ["g"], "v", "part")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        met = quantiles.exact_quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" in met
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
