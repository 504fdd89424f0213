"""Cleaning wide numeric features: casts, non-finite values, log scale, medians."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each(df: DataFrame, names: Iterable[str], make) -> DataFrame:
    """Replace the named columns in one projection."""
    chosen = set(names)
    return df.select(*[make(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def cast_features_double(df: DataFrame, features: list[str]) -> DataFrame:
    """Text that is no number becomes null instead of an error."""
    return each(df, features, lambda c: c.try_cast("double"))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def nullify_nonfinite(df: DataFrame, features: list[str]) -> DataFrame:
    return each(df, features, finite)


def log1p_with_floor(df: DataFrame, floors: dict[str, float], null_policy: str = "keep") -> DataFrame:
    """log1p of the value, at least the floor. Null values stay null (`keep`) or become the floor (`floor`)."""
    for_one = {
        n: F.log1p(F.greatest(F.col(f"`{n}`"), F.lit(f))) if null_policy == "floor" else F.when(F.col(f"`{n}`").isNotNull(), F.log1p(F.greatest(F.col(f"`{n}`"), F.lit(f))))
        for n, f in floors.items()
    }
    return df.select(*[for_one[c].alias(c) if c in for_one else F.col(f"`{c}`") for c in df.columns])


def median_impute_fit(df: DataFrame, features: list[str], accuracy: int = 1000) -> DataFrame:
    """One row: the approximate median of every feature, from one pass."""
    return df.agg(*[F.percentile_approx(F.col(f"`{f}`"), 0.5, accuracy).alias(f) for f in features])


def median_impute_apply(df: DataFrame, medians: DataFrame, features: list[str]) -> DataFrame:
    """Nulls filled with fitted medians; medians is one row, whatever the size of df."""
    row = medians.first()
    return df.fillna({f: float(row[f]) for f in features if row is not None and row[f] is not None})


def null_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, nulls) of all columns in one pass."""
    row = df.agg(*[F.count_if(F.col(f"`{f}`").isNull()).alias(f) for f in features])
    return row.unpivot([], list(features), "feature", "nulls")
