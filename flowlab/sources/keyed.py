"""Keyed state as hash buckets with copy-on-write: a batch rewrites only the buckets of its keys.

Rows lie in folders `data/<generation>/bucket=<b>`. A manifest names the folder of every bucket; a batch writes new folders
for the buckets it touches and then one new manifest, which is what makes it visible. A manifest also remembers the last batch that it holds,
so a batch that comes again changes nothing. Folders that no kept manifest names are deleted.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.sources import files
from flowlab.sources.shared import stage, unstage

#: Buckets of a new table (its own number holds from then on), and manifests that readers may still be using.
BUCKETS, KEPT = 64, 2


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest: number, buckets, batch, keys and folders (bucket to folder), or None."""
    found = [n for n in files.names(spark, f"{path}/manifests") if n.endswith(".json") and not n.startswith(".")]
    return json.loads(files.read_text(spark, f"{path}/manifests/{max(found)}")) if found else None


def upsert_state(state: DataFrame, path: str, keys: list[str], version: str, batch: int | None = None, buckets: int = BUCKETS) -> list[int]:
    """Merge rows into keyed state: of the rows so far and the new ones that with the greatest version of each key stays (of equal versions that with the greatest
    other columns). Returns the buckets that were rewritten: those of the keys in state, at most `buckets` numbers.

    batch: the number of a micro-batch; one that is not above the last is left out. Null keys are a key. Columns that are new are null in older
    rows. An empty state changes nothing. Two writers at once: one of them fails, and may be run again."""
    spark = state.sparkSession
    old = manifest(spark, path)
    if old and batch is not None and old["batch"] is not None and batch <= old["batch"]:
        return []
    n_buckets = old["buckets"] if old else buckets
    rows = stage(state.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(n_buckets)).cast("int")), "upsert")
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
    folders = dict(old["folders"]) if old else {}
    before = [folders[str(b)] for b in touched if str(b) in folders]
    if before:
        stored = spark.read.option("mergeSchema", True).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in before]).drop("generation")
        rows = rows.unionByName(stored, allowMissingColumns=True)
    values = [c for c in rows.columns if c not in (*keys, "bucket", version)]
    newest = rows.groupBy("bucket", *keys).agg(F.max(F.struct(version, *values)).alias("s")).select("bucket", *keys, "s.*")
    generation = f"generation={uuid.uuid4().hex}"
    newest.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/data/{generation}")
    folders |= {str(b): f"{generation}/bucket={b}" for b in touched}
    number = old["number"] + 1 if old else 0
    last = batch if batch is not None else old["batch"] if old else None
    files.create_text(spark, f"{path}/manifests/{number:012d}.json", json.dumps({"number": number, "buckets": n_buckets, "batch": last, "keys": keys, "folders": folders}))
    unstage(rows)
    vacuum(spark, path)
    return touched


def latest_state(spark: SparkSession, path: str, keys: list[str], version: str) -> DataFrame:
    """The state as the newest manifest has it, keys and version first. There must be one."""
    now = manifest(spark, path)
    df = spark.read.option("mergeSchema", True).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in now["folders"].values()]).drop("generation", "bucket")
    first = [*keys, version]
    return df.select(*first, *[c for c in df.columns if c not in first])


def vacuum(spark: SparkSession, path: str, kept: int = KEPT) -> list[str]:
    """Delete manifests but the newest ones, and folders that none of those names. Returns the deleted folders."""
    found = sorted(n for n in files.names(spark, f"{path}/manifests") if n.endswith(".json") and not n.startswith("."))
    used: set[str] = set()
    for n in found[-kept:]:
        used |= set(json.loads(files.read_text(spark, f"{path}/manifests/{n}"))["folders"].values())
    for n in found[:-kept]:
        files.delete(spark, f"{path}/manifests/{n}")
    gone = []
    for generation in files.names(spark, f"{path}/data"):
        inside = [f"{generation}/{b}" for b in files.names(spark, f"{path}/data/{generation}") if b.startswith("bucket=")]
        dead = [f for f in inside if f not in used]
        for f in [generation] if len(dead) == len(inside) else dead:
            files.delete(spark, f"{path}/data/{f}")
        gone += dead
    return gone
