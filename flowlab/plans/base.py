"""Registration of queries with their SQL, and the roles that the driver's tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

#: lineitem as flows: features, those with repeated vectors, label, group key, time, source.
F4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
F3 = ["l_quantity", "l_discount", "l_tax"]
KEY = "l_rowkey"
#: DuckDB: lineitem with a row key, events with a score in [0, 1].
SQL_L = "(SELECT *, l_orderkey * 10 + l_linenumber AS l_rowkey FROM lineitem)"
SQL_S = "(SELECT *, greatest(0.0, least(1.0, value / 500)) AS p FROM events)"


class Book:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def keep(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(KEY, F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with real timestamps and a score p in [0, 1]."""
    df = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return df.withColumn("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value") / 500)))


def md5_bucket_sql(key: str, n: int, salt: str = "") -> str:
    return f"CAST(CAST('0x' || substr(md5('{salt}' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT) % {n} AS INTEGER)"


def long_sql(columns: list[str], by: str, source: str = "lineitem") -> str:
    """(by, feature, value) rows of several columns."""
    return " UNION ALL ".join(f"SELECT {by} AS k, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {source}" for c in columns)
