"""Series over the whole range of the events."""

import datetime as dt

import pytest
from flowlab.operators import timeseries
from flowlab.plans import registry

from tests.test_queries import DATA, oracle, test_query_equals_sql as equals_sql  # noqa: F401

NAMES = ["densify", "aggregate_peak", "surge", "pearson", "best_lag", "narrative", "classify_shape", "stft"]


@pytest.mark.parametrize("name", NAMES)
def test_whole_range_equals_sql(spark, oracle, name):  # noqa: F811
    equals_sql(spark, oracle, f"ts_{name}")


def test_every_event_is_in_the_series(spark, oracle):  # noqa: F811
    rows = registry.queries()["ts_densify"](spark, str(DATA)).collect()
    assert sum(r["value"] for r in rows) == oracle.sql("SELECT count(*) FROM events").fetchall()[0][0]


def test_grid_over_spans_first_and_last(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59),), (None,), (dt.datetime(2024, 1, 1, 3, 0),)], "ts timestamp")
    assert [r["bucket"].hour for r in timeseries.grid_over(df, "ts", 3600).orderBy("bucket").collect()] == [0, 1, 2, 3]
    assert timeseries.grid_over(df.filter("ts IS NULL"), "ts", 3600).collect() == []
