"""A choice of registered queries against their SQL, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest
from flowlab.plans import registry

DATA = Path("/root/testdata/sf0.001")
CHOICE = [
    "spike_rollup", "harmonise", "clean_features", "feature_summary", "duplicate_stats", "split_grouped", "split_stratified", "join_left_anti_deleak", "threshold_sweep",
    "matched_fpr_compare", "classify_flow", "alert_rollup", "diversified_pick", "drift_psi_ks", "win_ema", "win_ema_running", "win_streak", "win_streak_rows", "ts_best_lag", "graph_build_edges", "graph_collapse_peers", "stream_tumbling_spike",
    "stream_late_drop", "scan_alert_store", "scan_file_glob_incremental", "frequent_values", "value_counts_topk", "top_duplicate_groups", "sink_upsert_state", "sink_upsert_batches",
    "sink_expired_rewrite", "sink_expired_days", "learn_feedback", "state_save_restore", "adaptive_first_batch", "assert_counts", "sink_metrics_json", "feedback_poll", "sink_graph_tables", "clean_column_names", "fix_positional_duplicate", "fit_scaler_train_only", "score_models", "stream_score_tree", "rate_controller", "residual_calibrator",
     "single_feature_auc", "key_profile_per_label",
]


def tidy(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}")
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.fixture(scope="module")
def oracle():
    if not DATA.exists():
        pytest.skip("no test data here")
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", CHOICE)
def test_query_equals_sql(spark, oracle, name):
    df = registry.queries()[name](spark, str(DATA))
    names = sorted(df.columns)
    got = sorted(repr([tidy(r[n]) for n in names]) for r in df.collect())
    want = oracle.sql(registry.oracle_sql()[name])
    at = [want.columns.index(n) for n in names]
    assert got == sorted(repr([tidy(float(r[i]) if type(r[i]).__name__ == "Decimal" else r[i]) for i in at]) for r in want.fetchall())


def test_every_query_but_a_few_has_sql():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert without == {
        "graph_communities", "graph_label_propagation", "train_rf_multiclass", "topn_feature_importance", "train_lr_binary", "train_specialist",
        "train_kmeans", "leakage_causal_test", "scaler_leakage_test", "transform_ablation", "stream_adaptive_policy", "train_rf_binary", "train_lr_multinomial", "stream_score_forest",
    }
