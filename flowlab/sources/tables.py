"""Reading flow logs, block lists and alert tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Positions in the headerless connection log.
CONN_POSITIONS = {"src": 0, "sport": 1, "dst": 2, "dport": 3, "proto": 4, "sbytes": 7, "dbytes": 8, "attack_cat": 47, "label": 48}


def scan_csv_dir(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV files of a directory, all columns text unless a schema is given (no inference pass)."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_csv_positional(spark: SparkSession, path: str, positions: dict[str, int] | None = None, width: int = 49) -> DataFrame:
    """Headerless CSV by position; rows too short for the last position are skipped, a byte order mark is stripped."""
    positions = positions or CONN_POSITIONS
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path)
    last = max(positions.values())
    clean = lambda i: F.trim(F.regexp_replace(F.col(f"_c{i}"), "﻿", ""))
    return df.filter(F.col(f"_c{last}").isNotNull()).select(*[clean(i).alias(n) for n, i in positions.items()])


def scan_many(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet corpora one below the other, columns by name, absent ones null. Files of equal schema are one job."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Each row tagged with the base name of its file. Must stand right behind the scan."""
    return df.withColumn(name, F.col("_metadata.file_name"))


def scan_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """(key): one key per line; blank lines and # comments are skipped."""
    return spark.read.text(path).select(F.trim(F.col("value")).alias("key")).filter((F.col("key") != "") & ~F.col("key").startswith("#")).distinct()


def project_for_stream(df: DataFrame, columns: list[str]) -> DataFrame:
    """Only the columns to emit; null and non-finite numbers as 0."""
    kinds = dict(df.dtypes)
    out = []
    for c in columns:
        x = F.col(f"`{c}`")
        out.append((F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), x).otherwise(0.0) if kinds[c] in ("double", "float") else F.coalesce(x, F.lit(0)) if kinds[c] in ("int", "bigint") else x).alias(c))
    return df.select(*out)


def scan_stream_json(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 4) -> DataFrame:
    """Newline-delimited JSON files as a stream, with an explicit schema and a bound on files per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def incremental(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """New rows of a Parquet table as a stream: each restart goes on where the checkpoint ended."""
    return spark.readStream.schema(schema).parquet(path)
