import pytest
from flowlab.functions.fingerprint import fingerprint_hash
from flowlab.operators import clean, joins, metrics, quality, schema, splits
from flowlab.sources import keyed, sinks, tables
from pyspark.sql import functions as F


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Label ", "Fwd Header Length34", "Fwd Header Length55"])
    fixed = schema.fix_positional_duplicate(schema.strip_column_names(df), "Fwd Header Length")
    assert fixed.columns == ["Label", "Fwd Header Length"] and fixed.first()["Fwd Header Length"] == 2
    assert schema.clean_column_names(spark.createDataFrame([(1, 2, 3)], ["a b", " a b", "c"])).columns == ["a_b", "a_b_2", "c"]
    assert len(schema.FEATURES) == 77 and len(set(schema.FEATURES)) == 77


def test_harmonise_drops_header_rows_from_numbers(spark):
    df = spark.createDataFrame([("12", " Benign"), ("dur", "Label"), (None, None), ("7", "DDOS HOIC")], ["dur", " Label"])
    spec = schema.SourceSpec("s", {"dur": "Flow Duration"})
    got = [tuple(r) for r in schema.harmonise(df, spec, ["Flow Duration", "Idle Min"]).collect()]
    assert got == [(12.0, None, "BENIGN", 0, "s"), (None, None, "Label", 1, "s"), (7.0, None, "DDoS", 1, "s")]


def test_cleaning(spark):
    df = spark.createDataFrame([(float("inf"), -5.0), (float("nan"), None), (2.0, 0.0)], "a double, b double")
    assert [r["a"] for r in clean.nullify_nonfinite(df, ["a"]).collect()] == [None, None, 2.0]
    keep = [r["b"] for r in clean.log1p_with_floor(df, {"b": 1.0}).collect()]
    assert keep == [pytest.approx(0.693147, abs=1e-6), None, pytest.approx(0.693147, abs=1e-6)]
    assert clean.log1p_with_floor(df, {"b": 0.0}, "floor").collect()[1]["b"] == 0.0


def frame(spark, n=2000):
    return spark.range(n).select("id", (F.col("id") % 7).alias("f"), (F.col("id") % 60).alias("g"), F.when(F.col("id") % 10 < 8, "big").otherwise("small").alias("label"))


def test_splits_are_whole_and_disjoint(spark):
    df = frame(spark)
    s = splits.split_grouped(df, "g")
    assert s.count() == 2000 and s.groupBy("g").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()
    train = s.filter("split = 'train'").count()
    assert 1600 <= train <= 1600 + 34
    st = splits.split_stratified(df, "label", "id")
    assert {(r["label"], r["n"]) for r in st.filter("split = 'test'").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()} == {("big", 320), ("small", 80)}
    a, b = (sorted(r["id"] for r in splits.split_random(df.repartition(k), "id").filter("split = 'train'").collect()) for k in (1, 7))
    assert a == b


def test_leakage_is_reported(spark):
    train = spark.createDataFrame([(1.0, 2.0, 1), (3.0, None, 2)], "x double, y double, g int")
    test = spark.createDataFrame([(1.0, 2.0, 3), (3.0, None, 1), (9.0, 9.0, 4)], "x double, y double, g int")
    r = splits.overlap_check(train, test, ["x", "y"], "g").first()
    assert (r["shared_groups"], r["shared_vectors"], r["leaked_rows"], r["leaked_pct"]) == (1, 2, 2, 66.666667)
    assert joins.shared_vectors(test, train, ["x", "y"], "left_anti").count() == 1
    assert spark.createDataFrame([(1, None), (None, 1)], "a int, b int").select(fingerprint_hash(["a", "b"])).distinct().count() == 2


def test_constant_and_negative_columns_are_reported(spark):
    df = frame(spark, 50).withColumn("c", F.lit(3.0)).withColumn("neg", -F.col("f").cast("double"))
    z = {(r["label"], r["feature"]): r["constant"] for r in quality.zero_variance_scan(df, ["c", "neg"], "label").collect()}
    assert z["big", "c"] and z["small", "c"] and not z["big", "neg"]
    n = {(r["label"], r["feature"]): r["negatives"] for r in quality.negative_value_audit(df, ["c", "neg"], "label", ("c",)).collect()}
    assert set(f for _, f in n) == {"neg"} and n["big", "neg"] > 0


def test_samples(spark):
    df = frame(spark)
    up = splits.sample_to_targets(df, "label", "id", {"big": 100, "small": 1000})
    n = {r["label"]: r["n"] for r in up.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert 60 < n["big"] < 140 and n["small"] == pytest.approx(1000, abs=80)
    assert splits.dedup_exact(df.select("f", "id"), ["f"], "id").count() == 7


def test_likely_keys_miss_none(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 5 > 0, F.concat(F.lit("key "), F.col("id"))).alias("id"))
    keys = df.filter("id LIKE '%7'")
    for most in (1_000_000, 10):  # sent, and joined by shuffle
        joins.HASHES, before = most, joins.HASHES
        try:
            got = sorted(r["id"] for r in joins.likely_in(df, keys, "id").collect())
        finally:
            joins.HASHES = before
        assert got == sorted(r["id"] for r in keys.collect()) and len(got) == 200


def test_metrics_identities(spark):
    df = spark.createDataFrame([(i / 100, i % 3 == 0) for i in range(100)], "p double, t boolean")
    sweep = metrics.threshold_sweep(df, "p", F.col("t"), [0.0, 0.5, 1.0]).collect()
    assert [r["alerts"] for r in sweep] == [100, 50, 0] and sweep[0]["recall"] == 1.0 and sweep[2]["precision"] is None
    best = metrics.best_cut(metrics.threshold_sweep(df, "p", F.col("t"), [0.2, 0.5]), 0.99, 0.0, 0.7).first()
    assert (best["cut"], best["met"]) == (0.7, False)
    assert metrics.rank_auc(df.withColumn("x", F.col("t").cast("double")), ["x"], F.col("t")).first()["auc"] == 1.0
    assert metrics.rank_auc(df.filter("t"), ["p"], F.col("t")).first()["auc"] is None


def test_sources_and_sinks(spark, tmp_path):
    fields = ["﻿1.1.1.1", "80", "2.2.2.2", "443", "tcp", "", "", "10", "20"] + [""] * 38 + ["DoS", "1"]
    (tmp_path / "conn.csv").write_text(",".join(fields) + "\nshort,row\n", encoding="utf-8")
    rows = tables.scan_csv_positional(spark, str(tmp_path / "conn.csv")).collect()
    assert [(r["src"], r["dst"], r["attack_cat"], r["label"]) for r in rows] == [("1.1.1.1", "2.2.2.2", "DoS", "1")]
    (tmp_path / "block.txt").write_text("# list\n10.0.0.1\n\n 10.0.0.2 \n10.0.0.1\n")
    assert sorted(r["key"] for r in tables.scan_blocklist(spark, str(tmp_path / "block.txt")).collect()) == ["10.0.0.1", "10.0.0.2"]
    assert sinks.write_counted(frame(spark, 9), str(tmp_path / "out")) == 9
    write = sinks.alert_sink(str(tmp_path / "alerts"), "ml")
    for _ in range(2):  # a batch that runs again replaces itself
        write(frame(spark, 5), 0)
    write(frame(spark, 3), 1)
    assert spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "alerts")).count() == 8
    assert tables.with_source_file(spark.read.parquet(str(tmp_path / "out"))).first()["source_file"].endswith(".parquet")
    keyed.upsert_state(spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.1)], "key string, v int, t double"), str(tmp_path / "state"), ["key"], "v")
    keyed.upsert_state(spark.createDataFrame([("a", 2, 0.7)], "key string, v int, t double"), str(tmp_path / "state"), ["key"], "v")
    assert {r["key"]: r["t"] for r in keyed.latest_state(spark, str(tmp_path / "state"), ["key"], "v").collect()} == {"a": 0.7, "b": 0.1}
