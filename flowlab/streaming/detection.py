"""Detection on streams. Every function takes a batch or a streaming DataFrame alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlab.functions.scores import above, safe_prefilter, spike_severity


def event_time(df: DataFrame, text: str = "event_time", out: str = "event_ts") -> DataFrame:
    return df.withColumn(out, F.try_to_timestamp(F.trim(F.col(text)), F.lit("yyyy-MM-dd HH:mm:ss")))


def watermarked(df: DataFrame, ts: str, late: str = "30 seconds") -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming else df


def spikes(df: DataFrame, key: str, ts: str, size: str, label: str, window: str = "60 seconds", least: int = 50, high: int = 200, critical: int = 500, late: str = "30 seconds") -> DataFrame:
    """Per key and tumbling window: count, summed size, most frequent label (the smallest of equals) and severity."""
    rows = watermarked(df, ts, late).groupBy(F.col(key), F.window(F.col(ts), window).alias("w"))
    counted = rows.agg(F.count(F.lit(1)).alias("connection_count"), F.round(F.sum(size), 6).alias("total_size"), F.expr(f"mode({label}, true)").alias("attack_label"))
    n = F.col("connection_count")
    return counted.filter(n >= least).select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), n, "total_size", "attack_label", spike_severity(n, critical, high).alias("severity"))


def membership(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is listed: a stream-static semi-join."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def gated(df: DataFrame, score: str, cut: float, most_shift: float = 0.0) -> DataFrame:
    """Rows that can become alerts: at the cut, or at the loosest cut an adapted policy could lower it to."""
    p = F.col(score)
    return df.filter(above(p, cut) if not most_shift else F.coalesce(~F.isnan(p) & (p >= safe_prefilter(cut, most_shift)), F.lit(False)))


def nominal(df: DataFrame, score: str, cut: float, keep: Column) -> DataFrame:
    return df.filter(~above(F.col(score), cut) & keep)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in the batches that the query still reports."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])


def run_all(parts: dict[str, tuple[DataFrame, Callable[[DataFrame, int], None]]], checkpoints: str, mode: str = "append") -> None:
    """Several queries together, each with a checkpoint of its own; returns when all have read what is there. The first error is raised
    after the others have ended."""
    queries = [start(df, sink, f"{checkpoints}/{name}", mode) for name, (df, sink) in parts.items()]
    errors = []
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    if errors:
        raise errors[0]


def start(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run on what is there and stop; each query has its own checkpoint. Errors fail the query, so no batch is lost."""
    return df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
