"""Append loop over source files with a ledger: every file is taken once, also after a crash between any two steps.

A file is known by path, size and time of change. Each step takes some new files in one job, which writes a folder for each (named by
its path, so that a repetition or a changed file replaces what was there), and then enters them in the ledger. What was written but
not entered is written again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.sources import files
from flowlab.sources.shared import stage, unstage

ENTRY = "path string, length bigint, modificationTime timestamp"
#: Source files in one step.
FILES = 64


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files under a folder; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def entered(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(ENTRY).parquet(f"{out}/ledger") if files.exists(spark, f"{out}/ledger") else spark.createDataFrame([], ENTRY)


def pending(spark: SparkSession, source: str, out: str, pattern: str = "*") -> DataFrame:
    """Files that are new, or have changed since they were entered."""
    return listed(spark, source, pattern).join(entered(spark, out), ["path", "length", "modificationTime"], "left_anti")


def append_new(spark: SparkSession, source: str, out: str, read: Callable[[SparkSession, list[str]], DataFrame], pattern: str = "*", step: int = FILES, before_entry: Callable[[int], None] | None = None) -> int:
    """Take all pending files, `step` at a time in order of path, and return how many were taken. read makes rows of some paths; it must
    read files (so that each row knows its own). before_entry is called with the number of the step between writing and entering, for tests.

    Rows of a changed file replace its former ones. Files that are gone keep their rows. No pending file changes nothing."""
    todo = stage(pending(spark, source, out, pattern), "pending-files")
    taken, number = 0, 0
    while True:
        some = [r.asDict() for r in todo.orderBy("path").offset(taken).limit(step).collect()]
        if not some:
            unstage(todo)
            return taken
        rows = read(spark, [r["path"] for r in some]).withColumn("file_id", F.md5(F.col("_metadata.file_path")))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_id").parquet(f"{out}/rows")
        if before_entry:
            before_entry(number)
        spark.createDataFrame(some, ENTRY).coalesce(1).write.mode("append").parquet(f"{out}/ledger")
        taken, number = taken + len(some), number + 1


def corpus(spark: SparkSession, out: str) -> DataFrame:
    """All rows taken so far."""
    return spark.read.parquet(f"{out}/rows").drop("file_id")


