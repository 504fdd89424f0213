"""A stored alert table with a zone map: the least and greatest time of every file, kept beside the table as it grows.

The newest rows are found by opening files from the newest on until no unopened file can hold one of them. The map has one row for
each file and is itself a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.sources import files

#: Files that are opened at first; each further step opens twice as many.
FIRST = 2


def append(df: DataFrame, path: str, ts: str, batch: int | None = None) -> None:
    """Add alerts as files of a folder of their own, and the zones of these files. batch: a micro-batch that runs again replaces its own. Rows without a
    time are stored, and are older than all others. Nothing that was stored before is read."""
    spark = df.sparkSession
    name = f"batch={batch if batch is not None else uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(f"{path}/rows/{name}")
    stored = spark.read.schema(df.schema).parquet(f"{path}/rows/{name}")
    zones = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(ts).alias("least"), F.max(ts).alias("greatest"), F.count(F.lit(1)).alias("n"), F.count(ts).alias("n_timed"))
    zones.select(F.concat(F.lit(f"{name}/"), "file").alias("file"), "least", "greatest", "n", "n_timed").coalesce(1).write.mode("overwrite").parquet(f"{path}/zones/{name}")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """(file, least, greatest, n, n_timed), a row for each file."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/zones")


def rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/rows")


def since(spark: SparkSession, path: str, ts: str, after, least_overlap: int = 0) -> tuple[DataFrame, int]:
    """(rows later than a time, how many files were opened): a poll that goes on where the last one ended opens only files that reach beyond it. after: a
    timestamp, or None for all rows with a time. least_overlap: seconds before it that are read again, for rows that were stored late."""
    every = zones(spark, path).filter("n_timed > 0")
    schema = rows(spark, path).schema
    if after is not None:
        cut = F.lit(after) - F.make_dt_interval(secs=F.lit(least_overlap))
        every = every.filter(F.col("greatest") > cut)
    opened = [r["file"] for r in every.select("file").collect()]  # what is new since the last poll
    if not opened:
        return spark.createDataFrame([], schema), 0
    found = spark.read.schema(schema).parquet(*[f"{path}/rows/{f}" for f in opened]).filter(F.col(ts).isNotNull())
    return (found if after is None else found.filter(F.col(ts) > cut)), len(opened)


def recent(spark: SparkSession, path: str, ts: str, key: str, k: int) -> tuple[DataFrame, int]:
    """(the newest k rows with a time, ties by key; how many files were opened).

    Files whose rows are all at least as new as some time t hold k rows between them: the k-th newest row is no older than t. Of the files
    that reach t the newest are opened first, and reading ends when the k-th row is newer than all that unopened files hold."""
    if k < 1 or not files.exists(spark, f"{path}/rows"):
        raise ValueError("k must be positive and the table must exist")
    every = zones(spark, path).filter("n_timed > 0")
    # each file has a row at least, so k files are enough to bound the k-th row
    bound, met = None, 0
    for z in every.orderBy(F.desc("least")).limit(k).collect():
        bound, met = z["least"], met + z["n_timed"]
        if met >= k:
            break
    reach = every if met < k else every.filter(F.col("greatest") >= F.lit(bound))
    opened, step, best, kth = 0, FIRST, None, None
    schema = rows(spark, path).schema
    while True:
        ordered = reach.orderBy(F.desc("greatest"), "file")
        chunk = [r["file"] for r in ordered.offset(opened).limit(step).collect()]
        if not chunk:
            break
        opened += len(chunk)
        part = spark.read.schema(schema).parquet(*[f"{path}/rows/{f}" for f in chunk]).filter(F.col(ts).isNotNull())
        best = (part if best is None else best.unionByName(part)).orderBy(F.desc(ts), F.asc(key)).limit(k)
        best = spark.createDataFrame(best.collect(), schema)  # k rows
        kth = best.agg(F.min(ts)).first()[0] if best.count() == k else None
        following = ordered.offset(opened).limit(1).collect()
        if not following or (kth is not None and following[0]["greatest"] < kth):
            break
        step *= 2
    return best if best is not None else spark.createDataFrame([], schema), opened
