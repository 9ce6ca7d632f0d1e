"""Lineage cuts for iterative operators.

Each round's result is written as parquet under the session's checkpoint folder
(``spark.checkpoint.dir``) and read back, so a lost executor recomputes at most
one round and every round starts from a short plan with exact file statistics.
Convergence is decided on what was written, by a small aggregate over the files.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import Column, DataFrame

from ringwise.session import scratch_path


def materialize(
    df: DataFrame, label: str, metrics: dict[str, Column] | None = None, path: str | None = None
) -> tuple[DataFrame, dict]:
    """Write ``df`` to the checkpoint folder, return (re-read frame, metrics of what was written).

    Metrics are aggregates over the written files, so none can be lost: a count
    reads the files' footers, others the columns that they name. ``path``
    overrides the fresh sub-folder (see ``Rounds``); the write replaces whatever
    that folder held.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    t0 = time.perf_counter()
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    values = {}
    if metrics:
        values = out.agg(*[c.alias(n) for n, c in metrics.items()]).first().asDict()
    if os.environ.get("RINGWISE_TRACE"):
        print(f"[materialize] {label}: {time.perf_counter() - t0:.2f}s {values}", file=sys.stderr)
    return out, values


class Rounds:
    """Two alternating folders for a loop whose round r only reads round r - 1.

    Round r overwrites slot r % 2, i.e. round r - 2, which no plan reads any
    more: a loop keeps at most two rounds on disk however long it runs, and a
    task lost in round r is recomputed from round r - 1, which is intact.
    """

    def __init__(self, spark, label: str):
        self.label = label
        self.base = scratch_path(spark, label)

    def write(self, df: DataFrame, rnd: int, metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
        return materialize(df, f"{self.label}-{rnd}", metrics, path=f"{self.base}/slot-{rnd % 2}")


class NoConvergence(RuntimeError):
    pass
