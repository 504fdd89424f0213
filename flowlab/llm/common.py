"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.llm.skew import join_weighted
from flowlab.sources.shared import stage, unstage

__all__ = ["bounded_batches", "exclusive_sums", "frugal", "others", "read_bytes", "shelved", "stage", "table", "unstage", "whole_key"]

#: Elements per block in `exclusive_sums`; within a block the cost is quadratic, so it stays small.
BLOCK = 256
BATCH_BYTES = 4 << 20


def others(df: DataFrame, taken: Iterable[str]) -> list[Column]:
    """Columns of df whose names (without regard to case) are not taken by the operator's own output."""
    names = {t.lower() for t in taken}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]


def shelved(df: DataFrame, taken: Iterable[str]) -> tuple[list[Column], list[Column]]:
    """`others` under names that no operator uses, and the columns that give them their names back."""
    names = {t.lower() for t in taken}
    kept = [c for c in df.columns if c.lower() not in names]
    return [F.col(f"`{c}`").alias(f"__shelf_{i}") for i, c in enumerate(kept)], [F.col(f"__shelf_{i}").alias(c) for i, c in enumerate(kept)]


def whole_key(docs: DataFrame, key: str, out: str) -> DataFrame:
    """docs with a bigint `out` that orders rows like their key: an integer key itself; a key of another sortable type by its place
    among the distinct keys, which a global sort of the keys alone gives. Null stays null."""
    k = F.col(f"`{key}`")
    if isinstance(docs.schema[key].dataType, T.IntegralType):
        return docs.withColumn(out, k.cast("bigint"))
    counts = docs.filter(k.isNotNull()).groupBy(k.alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    places = stage(counts.orderBy("__key").withColumn(out, F.monotonically_increasing_id()), "key-places")
    return join_weighted(docs, places, k == F.col("__key"), "__rows", "left").drop("__key", "__rows")


def exclusive_sums(lengths: Column) -> Column:
    """[0, a1, a1+a2, ...] of an array<int>, one element per input element. Two levels keep arrays of many thousands of
    elements cheap: sums inside blocks of BLOCK, then sums over blocks."""

    def running(values: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")),
            lambda acc: acc["out"],
        )

    def blocks() -> Column:
        last = F.floor((F.greatest(F.size(lengths), F.lit(1)) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))

    base = running(F.transform(blocks(), lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + x)))
    inner = F.transform(blocks(), running)
    return F.flatten(F.zip_with(base, inner, lambda start, part: F.transform(part, lambda x: x + start)))


def frugal(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A generator over batches that hands freed memory back to the system when it ends: workers outlive their tasks, and
    what one stage leaves in them would add to what the next one needs."""

    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return run


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of at most BATCH_BYTES, so that a worker's memory does not follow the length of
    texts (one longer text is a batch of its own). The session's setting is only ever lowered; it stays lowered, as plans
    run after the operator that asked for it has returned."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if _bytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def _bytes(size: str) -> int:
    """The bytes that a size in Spark's notation means, such as 4m, 1g or 1048576b."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit[:1] or "b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_bytes(path: str) -> bytes:
    return Path(path).read_bytes()
