"""Set operations on rows, labels and columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """By name, columns absent from some frames as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_positional(left: DataFrame, right: DataFrame) -> DataFrame:
    """By place, under the names of left; both must have as many columns."""
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} columns against {len(right.columns)}")
    return left.unionAll(right.toDF(*left.columns))


def intersect_vectors(left: DataFrame, right: DataFrame, features: list[str]) -> DataFrame:
    columns = [F.col(f"`{f}`") for f in features]
    return left.select(*columns).intersect(right.select(*columns))


def compare_labels(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """(label, status): both, left only or right only."""
    l = left.select(label).distinct().withColumn("l", F.lit(True))
    r = right.select(label).distinct().withColumn("r", F.lit(True))
    return l.join(r, label, "full_outer").select(label, F.when(F.col("l") & F.col("r"), "both").when(F.col("l"), "left only").otherwise("right only").alias("status"))
