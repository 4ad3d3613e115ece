"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession

from faceoff.session import ensure_checkpoint_dir

#: Shuffle files of a query go as soon as it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared checkpoint folder (``spark.checkpoint.dir``).

    Model fitting reads its input many times (indexers, imputers, each CV fold);
    without this every pass would recompute the whole feature plan. The table is Parquet,
    so later passes read only the columns they need, and it survives the loss of the
    executors that computed it. What was shuffled for it is given up at once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-table-{uuid.uuid4().hex}"
    append(df, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def append(df: DataFrame, path: str) -> None:
    """Add the rows of ``df`` to a Parquet folder; what was shuffled for them is given up at once."""
    with _cleaning(df.sparkSession):
        df.write.mode("append").parquet(path)


def gathered(df: DataFrame) -> list[Row]:
    """The few rows of ``df``; what was shuffled for them is given up at once."""
    with _cleaning(df.sparkSession):
        return df.collect()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` whose last reader is done."""
    for t in tables:
        path = t.__dict__.pop("_scratch", None)
        if path:
            folder = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
