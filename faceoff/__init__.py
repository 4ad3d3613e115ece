"""faceoff — contest analytics on Spark DataFrames.

Two-sided contests (two teams per row) and the plays inside them are cleaned,
aggregated and turned into time-correct features with DataFrame operations only.
Per-entity history is computed through :mod:`faceoff.operators.timeline`, which
never puts a whole entity's raw history into one task.
"""

__all__ = ["session", "schemas"]
