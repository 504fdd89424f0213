"""Dashboard reads over alert tables: counts, timelines, quotas and banded samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_by(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    out = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
    return out.limit(k) if k else out


def kpi_summary(df: DataFrame, severity: str, ts: str, minutes: int = 5) -> DataFrame:
    """total, critical, high and active (newer than `minutes` before the newest row)."""
    newest = df.agg(F.max(ts).alias("m")).first()["m"]
    recent = F.col(ts) > F.lit(newest) - F.expr(f"INTERVAL {minutes} MINUTES")
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(severity) == "Critical").alias("critical"), F.count_if(F.col(severity) == "High").alias("high"), F.count_if(recent).alias("active"))


def timeline(df: DataFrame, ts: str, by: str, unit: str = "hour") -> DataFrame:
    return df.groupBy(F.date_trunc(unit, F.col(ts)).alias("bucket"), F.col(by).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def bucketed_volume(df: DataFrame, ts: str, family: Column, seconds: int, size: str) -> DataFrame:
    """Per bucket of `seconds` and family: rows and summed size."""
    start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts)) / seconds) * seconds)
    return df.groupBy(start.alias("bucket"), family.alias("family")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(size), 6).alias("total"))


def top_recent(df: DataFrame, ts: str, key: str, k: int) -> DataFrame:
    """The newest k rows, ties by key."""
    return df.orderBy(F.desc(ts), F.asc(key)).limit(k)


def banded_sample(df: DataFrame, band: str, bands: list[str], ts: str, key: str, limit: int, minutes: int) -> DataFrame:
    """The newest limit // bands rows of each band inside the last `minutes`; if the window is empty, of all time. Column
    window_minutes is null for the fallback. One top-k pass per band, so a common band is not one task."""
    newest = df.agg(F.max(ts).alias("m")).first()["m"]
    inside = df.filter(F.col(ts) > F.lit(newest) - F.expr(f"INTERVAL {minutes} MINUTES")) if newest is not None else df
    fallback = inside.filter(F.col(band).isin(*bands)).isEmpty()
    source = df if fallback else inside
    each = max(1, limit // len(bands))
    picks = [source.filter(F.col(band) == b).orderBy(F.desc(ts), F.asc(key)).limit(each) for b in bands]
    return reduce(DataFrame.unionByName, picks).withColumn("window_minutes", F.lit(None if fallback else minutes).cast("int"))


def quota_union(parts: list[tuple[DataFrame, int]], ts: str, key: str) -> DataFrame:
    """The newest rows of several tables, each up to its quota."""
    return reduce(DataFrame.unionByName, [top_recent(df, ts, key, n) for df, n in parts if n > 0])


def feed_quotas(limit: int) -> dict[str, int]:
    """Nominal rows a third, spikes a quarter of the rest, membership hits half of that, scored alerts what is left."""
    nominal = limit // 3
    rest = limit - nominal
    spike = rest // 4
    bloom = spike // 2
    return {"nominal": nominal, "spike": spike, "bloom": bloom, "ml": rest - spike - bloom}


def diversified_pick(df: DataFrame, band: str, quotas: dict[str, int], family: str, subnet: Column, rank: list[Column], slots: int, key: str) -> DataFrame:
    """Rows for a few slots: per band its quota, first those that repeat no family and subnet of the band, then others,
    then the best of what is left. Column pick numbers them.

    Each band is first cut to the best row of each (family, subnet) and to `slots` further rows, by top-k passes."""
    rows = df.withColumn("_sub", subnet)
    order = [*rank, F.asc(key)]
    # ranks are cut to `slots` in every part of a family and subnet, then over its parts
    cut = lambda df, *by: df.withColumn("_r", F.row_number().over(Window.partitionBy(band, family, "_sub", *by).orderBy(*order))).filter("_r <= " + str(slots))
    leaders = cut(cut(rows.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(64))), "_part").drop("_part"))
    heads = []
    for i, (b, quota) in enumerate(quotas.items()):
        part = leaders.filter(F.col(band) == b).orderBy(F.when(F.col("_r") == 1, 0).otherwise(1), *order).limit(slots)
        numbered = part.withColumn("_n", F.row_number().over(Window.partitionBy(band).orderBy(F.when(F.col("_r") == 1, 0).otherwise(1), *order)))
        heads.append(numbered.withColumn("_band", F.lit(i)).withColumn("_over", F.when(F.col("_n") <= quota, 0).otherwise(1)))
    pool = reduce(DataFrame.unionByName, heads)  # at most slots rows per band
    pick = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_over", "_band", "_n"))
    return pool.withColumn("pick", pick).filter(F.col("pick") <= slots).drop("_sub", "_r", "_n", "_band", "_over")


def subnet24(ip: Column) -> Column:
    return F.substring_index(ip, ".", 3)


def alert_export(df: DataFrame, aliases: dict[str, list[str]], percent: tuple[str, ...] = ()) -> DataFrame:
    """A flat table for CSV: each output column is the first non-null of its source columns; percent columns as text."""
    out = []
    for name, sources in aliases.items():
        have = [F.col(s) for s in sources if s in df.columns]
        value = F.coalesce(*have) if have else F.lit(None).cast("string")
        out.append((F.concat(F.format_number(value * 100, 1), F.lit("%")) if name in percent else value).alias(name))
    return df.select(*out)


def retention(df: DataFrame, ts: str, now: str, hours: int) -> DataFrame:
    """Rows that a time-to-live of `hours` keeps."""
    return df.filter(F.col(ts) >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"))
