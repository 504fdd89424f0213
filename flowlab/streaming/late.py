"""Late rows: written instead of lost, and counted for the life of a query.

A watermark drops rows silently inside the engine. Here a stream is parted before it meets a windowed operator: rows whose window has closed go
to a side table, all others on. The watermark is the engine's rule (greatest event time of all earlier micro-batches, less a delay),
kept as one small file for each micro-batch, so a batch that runs again parts its rows in the same way and replaces its own output.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from flowlab.sources import files
from flowlab.sources.shared import stage, unstage


class DropCounter(StreamingQueryListener):
    """Rows that the engine's watermark dropped, by query, from the first to the last progress that a query ever reports (a query itself
    keeps only the newest hundred). A batch that is reported twice counts once."""

    def __init__(self):
        self._dropped: dict[str, dict[int, int]] = defaultdict(dict)
        self._read: dict[str, dict[int, int]] = defaultdict(dict)
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self._lock:
            self._dropped[str(p.id)][p.batchId] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            self._read[str(p.id)][p.batchId] = p.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def dropped(self, query_id: str) -> int:
        with self._lock:
            return sum(self._dropped[str(query_id)].values())

    def read(self, query_id: str) -> int:
        with self._lock:
            return sum(self._read[str(query_id)].values())


def watermark(spark: SparkSession, root: str, batch: int, delay: int) -> int | None:
    """Microseconds since 1970 of the watermark in force in a micro-batch, None in the first one."""
    last = [n for n in files.names(spark, f"{root}/newest") if int(n.split(".")[0]) < batch]
    seen = json.loads(files.read_text(spark, f"{root}/newest/{max(last)}"))["newest"] if last else None
    return None if seen is None else seen - delay * 1_000_000


def part(root: str, ts: str, delay: int, window: int) -> Callable[[DataFrame, int], None]:
    """A foreachBatch callback that writes root/on_time/batch=n and root/late/batch=n. A row is late if its tumbling window of `window` seconds
    ended at or before the watermark, `delay` seconds behind the newest event of earlier batches; window 0 compares the row's own
    time. Rows without a time are on time: no window can hold them, and none has closed. Late rows have their lateness in seconds."""

    def split(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch, "arrived")
        closed = watermark(spark, root, n, delay)
        late, behind = _late(F.unix_micros(F.col(ts).cast("timestamp")), closed, window)
        rows.filter(~late).write.mode("overwrite").parquet(f"{root}/on_time/batch={n}")
        rows.filter(late).withColumn("late_seconds", behind).write.mode("overwrite").parquet(f"{root}/late/batch={n}")
        newest = rows.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()[0]
        before = None if closed is None else closed + delay * 1_000_000
        name = f"{root}/newest/{n:012d}.json"
        files.delete(spark, name)
        files.create_text(spark, name, json.dumps({"newest": max((x for x in (newest, before) if x is not None), default=None)}))
        for old in files.names(spark, f"{root}/newest")[:-2]:  # only the last batch can run again
            files.delete(spark, f"{root}/newest/{old}")
        unstage(rows)

    return split


def _late(at: Column, closed: int | None, window: int) -> tuple[Column, Column]:
    if closed is None:
        return F.lit(False), F.lit(None).cast("double")
    size = window * 1_000_000
    end = F.floor(at / size) * size + size if size else at + 1
    return F.coalesce(end <= closed, F.lit(False)), (F.lit(closed) - at) / 1e6


def both(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(on time, late) of all batches so far."""
    read = lambda kind, s: spark.read.schema(s).option("recursiveFileLookup", True).parquet(f"{root}/{kind}")
    return read("on_time", schema), read("late", f"{schema}, late_seconds double")
