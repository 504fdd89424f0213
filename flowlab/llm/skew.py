"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one row in HOT of all, and more than LEAST; so fewer than HOT keys are.
HOT, LEAST = 10_000, 1000


def join_weighted(left: DataFrame, right: DataFrame, on: Column, weight: str, how: str = "inner") -> DataFrame:
    """left joined (inner or left) with right, whose keys are unique and which says in `weight` how many rows of left a
    key may meet. Rows of hot keys stay where they are: fewer than HOT rows of right, all weights being its own sum, are
    broadcast to them. All other keys are small, and shuffled. Both sides are read twice and should be staged."""
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    heavy = F.col(weight) > max(total / HOT, LEAST)
    hot = F.broadcast(right.filter(heavy))
    if right.filter(heavy).isEmpty():
        return left.join(right, on, how)
    cold = left.join(hot, on, "left_anti").join(right.filter(~heavy), on, how)
    return left.join(hot, on, "inner").unionByName(cold)
