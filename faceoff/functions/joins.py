"""Joins of tables that both grow with the input."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_key(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled by its key and never broadcast.

    The planner takes the size of a file for that of the rows in it. Contests compress well: millions of
    (id, date) seem to fit a broadcast, which then passes through the driver whole.
    """
    return df.hint("merge")
