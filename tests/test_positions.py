"""The global random order as positions of every row."""

import hashlib

from flowlab.operators import splits

from tests.test_queries import oracle, test_query_equals_sql as equals_sql  # noqa: F401


def test_every_row_has_its_place_in_the_order(spark):
    keys = [*range(1500), 7, 7, None, None]
    got = splits.positions(spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5), "k").collect()
    digest = lambda k: "" if k is None else hashlib.md5(f"42{k}".encode()).hexdigest()
    assert sorted(r["position"] for r in got) == list(range(1, len(keys) + 1))
    assert [r["k"] for r in sorted(got, key=lambda r: r["position"])] == sorted(keys, key=lambda k: (digest(k), k or 0))


def test_query_equals_row_numbers_over_the_whole_table(spark, oracle):  # noqa: F811
    equals_sql(spark, oracle, "sort_global_shuffle")
