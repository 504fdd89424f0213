"""Small operations on the shared file system, through Hadoop's own client, so that any store that Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies right under a folder; nothing if there is none."""
    fs, at = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file under another name and give it its own; an existing file is an error, so of two writers one fails."""
    fs, at = _at(spark, path)
    hidden, name = path.rsplit("/", 1)
    _, temporary = _at(spark, f"{hidden}/.{name}.tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(at) or not fs.rename(temporary, at):
        raise FileExistsError(path)
