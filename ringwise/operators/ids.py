"""Order-preserving bigint vertex ids for the iterative operators.

min()/max() over string columns plans as a sort-based aggregate, and string
join keys are wider than longs; the graph loops therefore run on ``vid``
numbers. ``index_ids`` sorts the distinct ids with Spark's range partitioning
and numbers them with ``monotonically_increasing_id`` (partition index in the
high bits, position in the low bits), so ``vid`` order equals ``id`` order and
"smallest id" results are unchanged. The index is written to the checkpoint
folder once, so every later join (and every retried task) sees the same numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.operators.iterate import materialize


def index_ids(ids: DataFrame, column: str = "id") -> DataFrame:
    """(id, vid) for the distinct non-null values of ``column``."""
    ordered = ids.select(F.col(column).alias("id")).where(F.col("id").isNotNull()).distinct().orderBy("id")
    index, _ = materialize(ordered.select("id", F.monotonically_increasing_id().alias("vid")), "vid-index")
    return index


def encode_edges(edges: DataFrame, index: DataFrame, *extra: str) -> DataFrame:
    """(src, dst, *extra) with src/dst replaced by their vids (rows with unknown ends dropped)."""
    s = index.select(F.col("id").alias("src"), F.col("vid").alias("_s"))
    d = index.select(F.col("id").alias("dst"), F.col("vid").alias("_d"))
    return edges.join(s, "src").join(d, "dst").select(F.col("_s").alias("src"), F.col("_d").alias("dst"), *extra)


def decode(df: DataFrame, index: DataFrame, vid_col: str, id_col: str) -> DataFrame:
    """Replace ``vid_col`` by the original id under the name ``id_col``."""
    return df.join(index.select(F.col("vid").alias(vid_col), F.col("id").alias(id_col)), vid_col).drop(vid_col)
