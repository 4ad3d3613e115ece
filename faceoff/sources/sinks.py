"""Writers for result tables.

Output goes under a folder of the shared checkpoint location named by
``spark.checkpoint.dir`` unless a target is given; contest tables are
partitioned by ``season`` so later readers prune partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faceoff.session import ensure_checkpoint_dir
from faceoff.sources import conform


def output_root(spark: SparkSession, root: str | None = None) -> str:
    return root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-out-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    parts = [c for c in (partition_by or []) if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def write_profiled(spark: SparkSession, tables: dict[str, DataFrame], root: str | None = None) -> tuple[dict[str, str], DataFrame]:
    """S4 + S10: write each table; its path, and a profile (table, rows, columns) of what was written. The
    profile reads no column, only the row counts in the footers of the files. (Counting by an
    ``Observation`` of the write would save that too, but a session that has used one can't run the
    forests of Spark ML any more: their tasks are then not serializable.)"""
    paths = write_tables(spark, tables, root)
    return paths, conform.table_profile({name: spark.read.parquet(path) for name, path in paths.items()})


def write_tables(spark: SparkSession, tables: dict[str, DataFrame], root: str | None = None,
                 fmt: str = "parquet") -> dict[str, str]:
    """Write each table (``season``-partitioned when it has that column)."""
    base = output_root(spark, root)
    return {name: write_table(df, f"{base}/{name}", fmt, ["season"]) for name, df in tables.items()}
