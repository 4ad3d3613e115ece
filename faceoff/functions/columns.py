"""Column-level helpers (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int, NULL counts as false (pandas ``NaN == x`` is False)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def eq_flag(a, b) -> Column:
    """1 when both sides are equal and non-null, else 0."""
    return flag(col(a) == col(b))


def safe_ratio(num, den, default=None) -> Column:
    """num / den; NULL (or ``default``) when den is 0 or NULL. Never raises under ANSI."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def finite(c) -> Column:
    """NaN and ±inf -> NULL."""
    x = col(c)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def pair_low(a, b) -> Column:
    return F.least(col(a), col(b))


def pair_high(a, b) -> Column:
    return F.greatest(col(a), col(b))


def season_from_date(c="date") -> Column:
    return F.year(col(c))


def signed_margin(won: Column, margin) -> Column:
    """Margin with NULL -> 0, negated when the side did not win."""
    m = F.coalesce(col(margin), F.lit(0.0))
    return F.when(won == 1, m).otherwise(-m)
