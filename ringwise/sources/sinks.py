"""Table sinks and catalog housekeeping (write modes, drop-before-rebuild, namespaces)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, name: str | None = None, path: str | None = None, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write ``df`` as a catalog table (``name``) or to ``path``; ``mode`` is overwrite or append."""
    if mode not in ("overwrite", "append", "error", "ignore"):
        raise ValueError(f"unsupported write mode {mode!r}")
    writer = df.write.mode(mode).format(fmt)
    if name is not None:
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    elif path is not None:
        writer.save(path)
    else:
        raise ValueError("give a table name or a path")


def drop_tables(spark: SparkSession, names: Iterable[str]) -> dict[str, str | None]:
    """DROP TABLE IF EXISTS for each name; errors are reported per table, not raised."""
    out: dict[str, str | None] = {}
    for n in names:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
            out[n] = None
        except Exception as e:  # noqa: BLE001 - reported to the caller
            out[n] = str(e)
    return out


def use_namespace(spark: SparkSession, schema: str) -> None:
    """CREATE SCHEMA IF NOT EXISTS, then make it current."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.sql(f"USE {schema}")
