"""Feature tables with the schema and fill values they were made with.

A feature table is a folder with ``data`` (Parquet) and ``spec``, one JSON line: the version
of the layout, the schema, and what a missing value of a column is filled with. A reader
asks for the columns it needs and gets them in its order and with its types, or an error
that names what doesn't fit; the data itself is not looked at for that.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from faceoff.sources import sinks

VERSION = 1


class SpecError(ValueError):
    """A stored feature table doesn't fit what its reader asks for."""


def write_features(df: DataFrame, path: str, fill: dict[str, float] | None = None, partition_by: list[str] | None = None) -> str:
    """Write a feature table; the spec comes last, so a table without one is not whole."""
    fill = fill or {}
    unknown = sorted(set(fill) - set(df.columns))
    if unknown:
        raise SpecError(f"fill values for absent columns: {', '.join(unknown)}")
    sinks.write_table(df, f"{path}/data", partition_by=partition_by)
    spec = json.dumps({"version": VERSION, "schema": json.loads(df.schema.json()), "fill": fill})
    df.sparkSession.createDataFrame([(spec,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")
    return path


def read_spec(spark: SparkSession, path: str) -> tuple[StructType, dict[str, float]]:
    """(schema, fill values) of a stored feature table."""
    line = spark.read.text(f"{path}/spec").first()
    if line is None:
        raise SpecError(f"{path}: no spec")
    spec = json.loads(line["value"])
    if spec.get("version") != VERSION:
        raise SpecError(f"{path}: layout {spec.get('version')}, this reader knows {VERSION}")
    return StructType.fromJson(spec["schema"]), spec["fill"]


def read_features(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None, filled: bool = False) -> DataFrame:
    """S3: a stored feature table, all columns or those named, in that order. ``types`` names types (as Spark
    writes them) that columns must have; ``filled`` puts the stored fill values for NULLs."""
    schema, fill = read_spec(spark, path)
    have = {f.name: f.dataType.simpleString() for f in schema.fields}
    wanted = columns or list(have)
    absent = [c for c in wanted if c not in have]
    other = [f"{c} is {have[c]}, not {t}" for c, t in (types or {}).items() if c in have and have[c] != t]
    if absent or other:
        raise SpecError(f"{path}: " + "; ".join([f"no column {c}" for c in absent] + other))
    df = spark.read.schema(schema).parquet(f"{path}/data").select(*wanted)
    known = {c: v for c, v in fill.items() if c in wanted}
    return df.fillna(known) if filled and known else df
