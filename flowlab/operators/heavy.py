"""Exactly the most frequent values, without a shuffle of all distinct ones.

Every task keeps a bounded summary of its rows (the counters of Misra and Gries, trimmed as summaries are merged): a value's count in it
is too low by at most what the summary has trimmed. Summed over tasks these are bounds on every value's count; only values whose upper
bound reaches the k-th lower bound are counted exactly, in one more pass. If the k-th exact count does not exceed what an unseen value could
have, the summaries grow and the passes run again; with room for all values they are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from flowlab.sources.shared import stage, unstage

#: Counters of a task at first; each repetition has GROWTH times as many. With more than MOST the values are simply counted.
COUNTERS, GROWTH, MOST = 4096, 16, 1_000_000
#: Candidates that may be sent to every task.
BROADCAST = 100_000


def summaries(df: DataFrame, column: str, counters: int) -> DataFrame:
    """(value, n, trimmed): the counters of every task, and a row with a null value for what each has trimmed (n is 0). Nulls are not values."""
    kind = df.schema[column].dataType.simpleString()
    ddl = f"value {kind}, n bigint, trimmed bigint"
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, trimmed = pa.table({"value": pa.array([], schema[0].type), "n": pa.array([], pa.int64())}), 0
        for batch in batches:
            fresh = pc.value_counts(batch[0].drop_null())
            fresh = pa.table({"value": fresh.field(0), "n": fresh.field(1)})
            kept = pa.concat_tables([kept, fresh]).group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
            if len(kept) > counters:
                # the first counter beyond the room is taken from all: what is left is too low by no more than that
                least = kept["n"].take(pc.sort_indices(kept, [("n", "descending")])[counters : counters + 1])[0].as_py()
                kept = kept.filter(pc.greater(kept["n"], least))
                kept = kept.set_column(1, "n", pc.subtract(kept["n"], least))
                trimmed += least
        zero = pa.array([0] * len(kept), pa.int64())
        yield from pa.table([kept["value"].combine_chunks(), kept["n"].combine_chunks(), zero], schema=schema).to_batches()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, schema[0].type), pa.array([0], pa.int64()), pa.array([trimmed], pa.int64())], schema=schema)

    return df.select(F.col(f"`{column}`")).mapInArrow(count, ddl)


def frequent(df: DataFrame, column: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """(value, n) of every value that occurs at least as often as the k-th most frequent one, exactly; so ties at the k-th place are complete. All
    values, if there are fewer than k. Nulls are not values; an empty table has none.

    df is read twice for each try, and should be a stored table. A table whose values are about equally frequent ends in plain counting."""
    key = F.col(f"`{column}`")
    while counters <= MOST:
        found = stage(summaries(df, column, counters), "heavy")
        unseen = found.agg(F.coalesce(F.sum("trimmed"), F.lit(0))).first()[0]
        merged = found.filter(F.col("value").isNotNull()).groupBy("value").agg(F.sum("n").alias("n"))
        lower = [r["n"] for r in merged.orderBy(F.desc("n")).limit(k).collect()]
        if unseen == 0:  # nothing was trimmed: the summaries are the counts
            return merged.filter(F.col("n") >= lower[-1]) if len(lower) == k else merged
        if len(lower) == k:
            # a value that a summary lacks counts up to what was trimmed there; all candidates are counted again
            candidates = stage(merged.filter(F.col("n") + unseen >= lower[-1]).select("value"), "candidates")
            if candidates.limit(BROADCAST + 1).count() <= BROADCAST:  # checked before they are sent to every task
                exact = stage(df.join(F.broadcast(candidates), key == F.col("value"), "left_semi").groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("n")), "counted")
                kth = exact.orderBy(F.desc("n")).limit(k).agg(F.min("n")).first()[0]
                if kth > unseen:
                    unstage(found, candidates)
                    return exact.filter(F.col("n") >= kth)
                unstage(exact)
            unstage(candidates)
        unstage(found)
        counters *= GROWTH
    counted = stage(df.filter(key.isNotNull()).groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("n")), "counted")
    last = [r["n"] for r in counted.orderBy(F.desc("n")).limit(k).collect()]
    return counted.filter(F.col("n") >= last[-1]) if len(last) == k else counted


def top_values(df: DataFrame, column: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """(value, n) of the k most frequent values, exactly; of equally frequent ones those that come first."""
    return frequent(df, column, k, counters).orderBy(F.desc("n"), F.asc("value")).limit(k)
