"""Row filters, renames, null and infinity handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.functions.columns import finite

TEAM_COLUMNS = ["team1", "team2", "winner", "toss_winner"]
PLAY_TEAM_COLUMNS = ["batting_team", "bowling_team"]


def drop_no_result(contests: DataFrame) -> DataFrame:
    """Drop contests whose result is 'no result'; a NULL result is kept."""
    return contests.filter(~F.col("result").eqNullSafe(schemas.NO_RESULT))


def canonical_names(df: DataFrame, mapping: dict[str, str] | None = None,
                    columns: list[str] | None = None) -> DataFrame:
    """Rename values through a fixed mapping in the given string columns.

    Default columns: every team column present (contests and plays alike), so
    both tables use the same names.
    """
    mapping = schemas.TEAM_NAME_MAPPING if mapping is None else mapping
    cols = [c for c in (columns or TEAM_COLUMNS + PLAY_TEAM_COLUMNS) if c in df.columns]
    strings = [c for c in cols if df.schema[c].dataType.simpleString() == "string"]
    if not strings or not mapping:
        return df
    return df.replace(mapping, subset=strings)


def replace_everywhere(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Replace values in every string column."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.replace(mapping, subset=strings) if strings else df


def _known(df: DataFrame, columns) -> None:
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}; there are: {', '.join(df.columns)}")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``columns``; an unknown column is an error."""
    _known(df, columns)
    return df.dropna(subset=list(columns))


def positive_exposure(df: DataFrame, columns=("balls_faced", "overs_bowled")) -> DataFrame:
    """Keep rows with a positive exposure column (each one that exists)."""
    for c in columns:
        if c in df.columns:
            df = df.filter(F.col(c) > 0)
    return df


def finite_only(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN and ±inf in float columns become NULL."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    return df.withColumns({c: finite(c) for c in cols}) if cols else df


def fill_defaults(df: DataFrame, values: dict | None = None, patterns: dict[str, object] | None = None,
                  categorical: bool = False) -> DataFrame:
    """Fill NULLs by column map, by column-name pattern, and/or strings with 'Unknown'."""
    fill = dict(values or {})
    _known(df, fill)
    for pat, v in (patterns or {}).items():
        for c in df.columns:
            if pat in c and c not in fill:
                fill[c] = v
    if categorical:
        for f in df.schema.fields:
            if f.dataType.simpleString() == "string" and f.name not in fill:
                fill[f.name] = schemas.UNKNOWN_LABEL
    return df.fillna(fill) if fill else df
