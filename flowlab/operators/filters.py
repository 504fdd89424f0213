"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_in(df: DataFrame, label: str, wanted: Iterable[str]) -> DataFrame:
    """Case and outer space do not matter."""
    return df.filter(F.upper(F.trim(F.col(f"`{label}`"))).isin(*[w.strip().upper() for w in wanted]))


def nonblank_label(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.coalesce(F.trim(F.col(f"`{label}`")), F.lit("")) != "")


def source_file(df: DataFrame, names: Iterable[str], keep: bool = True) -> DataFrame:
    """Rows of a scan from the named files (or all others); the predicate on file metadata prunes files."""
    hit = F.col("_metadata.file_name").isin(*names)
    return df.filter(hit if keep else ~hit)


def source_path(df: DataFrame, parts: Iterable[str], keep: bool = True) -> DataFrame:
    """Rows of a scan from files whose path holds one of the parts, such as a day's folder (or all others)."""
    hit: Column = F.lit(False)
    for p in parts:
        hit = hit | F.col("_metadata.file_path").contains(p)
    return df.filter(hit if keep else ~hit)


def date_range(df: DataFrame, ts: str, first: str, last: str) -> DataFrame:
    """Whole days, the last one included."""
    t = F.col(f"`{ts}`")
    return df.filter((t >= F.lit(first).cast("timestamp")) & (t < F.lit(last).cast("timestamp") + F.expr("INTERVAL 1 DAY")))


def severity_in(df: DataFrame, wanted: Iterable[str], column: str = "severity") -> DataFrame:
    return df.filter(F.col(column).isin(*wanted))


def text_contains(df: DataFrame, columns: Iterable[str], part: str) -> DataFrame:
    hit: Column = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(f"`{c}`").cast("string")).contains(part.lower()), F.lit(False))
    return df.filter(hit)


def array_overlap(df: DataFrame, column: str, wanted: Iterable[str]) -> DataFrame:
    return df.filter(F.coalesce(F.arrays_overlap(F.col(f"`{column}`"), F.array(*[F.lit(w) for w in wanted])), F.lit(False)))
