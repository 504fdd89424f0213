"""Joins. Sides are broadcast only behind a check of their size; else Spark chooses by its own threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.functions.fingerprint import fingerprint_hash

#: Rows up to which a dimension is broadcast.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; the count stops one row beyond the bound."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def attach(df: DataFrame, dim: DataFrame, on: list[str], fill: dict | None = None) -> DataFrame:
    """Left join of a small dimension, missing values filled."""
    out = df.join(sized(dim), on, "left")
    return out.fillna(fill) if fill else out


def left_counts(support: DataFrame, correct: DataFrame, names: DataFrame, on: str) -> DataFrame:
    return support.join(correct, on, "left").join(sized(names), on, "left").fillna(0)


def full_outer_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, left_n, right_n): presence of each key in two tables."""
    l = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_n"))
    r = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_n"))
    return l.join(r, key, "full_outer").fillna(0, ["left_n", "right_n"])


def shared_vectors(left: DataFrame, right: DataFrame, features: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of left whose whole feature vector occurs in right (left_semi) or not (left_anti). Fingerprints meet first,
    then the columns themselves are compared, nulls as equal."""
    l = left.withColumn("_fp", fingerprint_hash(features))
    r = right.select(*[F.col(f"`{f}`").alias(f"_r{i}") for i, f in enumerate(features)], fingerprint_hash(features).alias("_rfp")).distinct()
    on: Column = F.col("_fp") == F.col("_rfp")
    for i, f in enumerate(features):
        on = on & F.col(f"`{f}`").eqNullSafe(F.col(f"_r{i}"))
    return l.join(r, on, how).drop("_fp")


def keys_in(df: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    return df.join(keys.select(on).distinct(), on, how)


#: Hashes of keys that may be sent to every task, 8 bytes each.
HASHES = 1_000_000


def likely_in(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is probably listed: those whose key has the 64-bit hash of a listed one. No listed key is missed, and one that is not passes
    with probability (number of keys) / 2^64. It is a small filter for long keys (up to HASHES of them go to every task, more are left to
    the engine's own join and run-time filters), and goes before an exact semi-join (`keys_in`), never instead of it. Null keys are not listed."""
    hashes = keys.filter(F.col(f"`{on}`").isNotNull()).select(F.xxhash64(on).alias("_hash")).distinct()
    return df.filter(F.col(f"`{on}`").isNotNull()).join(sized(hashes, HASHES), F.xxhash64(F.col(f"`{on}`")) == F.col("_hash"), "left_semi")
