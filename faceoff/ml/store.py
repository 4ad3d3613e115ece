"""Stored models: fitted once, found again by later sessions (S6, M17, M19, ST1).

A model is kept under the fingerprint of what it was fitted from: the rows of its training
table in any order, the parameters of the job, and the source of this subpackage. Another table, grid or
code has another fingerprint, so a stored model is never out of date and never overwritten.
A model is named in the index only after all of it has been written; two sessions that fit at once
both write whole models, and either may be read.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.session import ensure_checkpoint_dir

#: Session setting that names the folder of stored models; all executors must see it.
ROOT_SETTING = "spark.faceoff.models"


def root(spark: SparkSession) -> str:
    """The folder of stored models: as set, else below the shared checkpoint folder. A local
    session without either keeps them in one folder of this machine."""
    named = spark.conf.get(ROOT_SETTING, None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.getConf().get("spark.checkpoint.dir") or not spark.sparkContext.master.startswith("local"):
        return f"{ensure_checkpoint_dir(spark).rstrip('/')}/faceoff-models"
    return f"{tempfile.gettempdir()}/faceoff-models"


def code_version() -> str:
    sources = sorted(Path(__file__).parent.glob("*.py"))
    return hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()


def fingerprint(table: DataFrame, *parameters) -> str:
    """Of the rows (their order doesn't matter, repeated ones count), the columns, the parameters and the code.

    One aggregate: the sums of two halves of a hash of each row.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]), {"ignoreNullFields": "false"}), 256)
    half = lambda a: F.sum(F.conv(F.substring(row, a, 15), 16, 10).cast("decimal(20,0)"))
    sums = table.agg(F.count(F.lit(1)), half(1), half(16), half(31)).first()
    said = [table.schema.json(), [str(x) for x in sums], [repr(p) for p in parameters], code_version()]
    return hashlib.sha256(repr(said).encode()).hexdigest()[:32]


def stored(spark: SparkSession, key: str) -> str | None:
    """The folder of a whole model of this fingerprint, if there is one."""
    try:
        rows = spark.read.schema("path string").json(f"{root(spark)}/{key}/index").collect()  # a row a session that fitted it
    except AnalysisException:
        return None
    return min((r["path"] for r in rows), default=None)


def keep(spark: SparkSession, key: str, model: PipelineModel) -> str:
    path = f"{root(spark)}/{key}/{uuid.uuid4().hex}"
    model.write().save(path)
    spark.createDataFrame([(path,)], "path string").coalesce(1).write.mode("append").json(f"{root(spark)}/{key}/index")
    return path


def obtain(spark: SparkSession, key: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The stored model of this fingerprint; it is fitted and stored if there is none."""
    return PipelineModel.load(stored(spark, key) or keep(spark, key, fit()))
