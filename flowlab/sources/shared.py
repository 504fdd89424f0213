"""Tables in the folder that the driver and all executors share, to cut the plan of iterative jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset a folder of the warehouse serves on one machine; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/flowlab-stages"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df as Parquet and read it again: a lost executor costs nothing that is already written."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/flowlab/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, such as those of a round that a later one has replaced."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/flowlab/" in f}:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
