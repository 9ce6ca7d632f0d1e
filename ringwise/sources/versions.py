"""A table in versions: each write is a folder of its own, and readers see the newest finished one.

A version is a folder ``v=<number>`` under the table's path. It counts once Spark's commit marker
``_SUCCESS`` is in it, which the write leaves last, so a reader never sees half a table, and a task that was lost
while writing leaves nothing that counts. Versions that a reader has begun stay until ``drop_before`` takes them away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished versions, ascending."""
    jvm, at, fs = _folder(spark, path)
    if not fs.exists(at):
        return []
    found = []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def write_version(df: DataFrame, path: str) -> int:
    """Writes ``df`` as the next version; one writer at a time, as ``errorifexists`` makes a second one fail."""
    spark = df.sparkSession
    _, at, fs = _folder(spark, path)
    begun = [int(s.getPath().getName()[2:]) for s in (fs.listStatus(at) if fs.exists(at) else []) if s.getPath().getName().startswith("v=")]
    number = max(begun, default=0) + 1
    df.write.mode("errorifexists").parquet(f"{path}/v={number}")
    return number


def read_version(spark: SparkSession, path: str, schema, number: int | None = None) -> DataFrame:
    """A version, the newest one by default; without any, an empty table."""
    number = number if number is not None else next(reversed(versions(spark, path)), None)
    if number is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/v={number}")


def drop_before(spark: SparkSession, path: str, number: int) -> None:
    """Deletes all older versions, finished or not."""
    jvm, at, fs = _folder(spark, path)
    for status in fs.listStatus(at) if fs.exists(at) else []:
        name = status.getPath().getName()
        if name.startswith("v=") and int(name[2:]) < number:
            fs.delete(status.getPath(), True)
