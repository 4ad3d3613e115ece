"""Schema conformance and table profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conform_schema(df: DataFrame, columns: list[str], defaults: dict | None = None,
                   default=0, types: dict[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """Keep ``columns`` in that order; missing ones are added with their default.

    Returns the conformed DataFrame and the list of columns that were missing
    (known at plan time, no job runs).
    """
    defaults = defaults or {}
    types = types or {}
    missing = [c for c in columns if c not in df.columns]
    out = []
    for c in columns:
        e = F.col(c) if c in df.columns else F.lit(defaults.get(c, default))
        if c in types:
            e = e.cast(types[c])
        out.append(e.alias(c))
    return df.select(out), missing


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table, one aggregate job per table, unioned."""
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                     .select(F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
