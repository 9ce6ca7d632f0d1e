"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwise.session import scratch_path

#: Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the session's workers this library, where they may not find it by their own paths: once a session."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ringwise-")) / "ringwise.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; a null text has none."""
    blanked = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(blanked, " "), "")


def others(df: DataFrame, *taken: str) -> list[str]:
    """Columns of ``df`` whose names an operator's own columns don't take."""
    own = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in own]


class Scratch:
    """One folder under ``spark.checkpoint.dir`` for the written steps of one operator call.

    A written step cuts the lineage: a lost executor repeats work back to the last step at
    most. ``drop`` deletes steps that no later plan reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = scratch_path(spark, label)

    def save(self, df: DataFrame, step: str) -> DataFrame:
        path = f"{self.base}/{step}"
        schema = df.schema
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def rows(self, step: str) -> int:
        return self.spark.read.parquet(f"{self.base}/{step}").count()

    def drop(self, *steps: str) -> None:
        jvm = self.spark._jvm
        for step in steps:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{step}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()  # lets Spark's cleaner remove the shuffle files of finished steps


#: Bits of the filter that ``split`` sends to all tasks: 8 MB, whatever the input.
BITS = 1 << 26


def split(rows: DataFrame, key: str, keys: DataFrame, scratch: Scratch, step: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key``, a 64-bit hash, may be among ``keys`` (one column), and those whose key is not.

    So a join that concerns some of the rows doesn't have to shuffle the texts of all. A bitmap of the keys
    decides; with more keys than bits most rows may be among them, which costs the shuffle but no row.
    """
    place = lambda c: (F.bitmap_bucket_number(F.pmod(c, F.lit(BITS))), F.bitmap_bit_position(F.pmod(c, F.lit(BITS))))
    bucket, bit = place(F.col(keys.columns[0]))
    placed = keys.select(bucket.alias("__bucket"), bit.alias("__bit")).repartition("__bucket")
    bits = scratch.save(placed.groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits")), step)
    bucket, bit = place(F.col(key))
    tested = rows.join(F.broadcast(bits), bucket == F.col("__bucket"), "left")
    byte = F.conv(F.hex(F.substr("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return tested.where(maybe).select(*rows.columns), tested.where(~maybe).select(*rows.columns)


#: What a worker keeps from task to task, as long as it runs tasks that use it; see ``lean``.
held: dict = {}


def let_go(holds: bool) -> None:
    """Frees ``held`` unless the task that begins uses it."""
    if not holds:
        held.clear()


def give_back() -> None:
    """The system gets back what was freed: Arrow's pool, and with the C library of Linux also what numpy and other libraries used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable, holds: bool = False) -> Callable:
    """A function for ``mapInArrow`` that gives back what Arrow has freed; its pool would keep some 100 MB a worker after a batch of texts.

    A worker goes on to tasks of other stages: what earlier ones left in ``held`` goes first, unless ``run`` ``holds`` on to it.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(holds)
        pool = pa.default_memory_pool()
        try:
            for out in run(batches):
                yield out
                pool.release_unused()
        finally:
            give_back()

    return wrapped


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Arrow batches of about ``most`` bytes for a session that sets none itself: 10,000 texts may be any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(most))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column of an Arrow batch, null rows empty, without copying."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, starts


def chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes together, or of one longer row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end
