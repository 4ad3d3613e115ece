"""Training-data preparation.

Splits are functions of a hash of (seed, id): they do not change when the data
is repartitioned or a task is retried, unlike ``randomSplit``.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faceoff import schemas
from faceoff.operators import clean, explore
from faceoff.scratch import discard, materialize  # noqa: F401

# Columns the classifier must not see (identifiers, date, leaking scores, label).
NON_FEATURES = ["id", "date", "winner", "inning1_score", "inning2_score", "winning_score", "losing_score", "team1_won"]
HASH_BITS = 32
BUCKETS = 1 << 16


def hash_unit(key, seed: int) -> F.Column:
    """Deterministic number in [0, 2^32) from md5(seed:key) (first 8 hex digits)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def codes(values: DataFrame) -> DataFrame:
    """(column, value, code) for the distinct (column, value) of a table: the 0-based rank of the value in its column.

    The values are dealt into ranges of (column, value); a prefix sum over the sizes of the ranges and a
    window inside each number them, so no column's vocabulary is in one task or in the driver.
    """
    d = values.select("column", "value").distinct().repartitionByRange("column", "value")
    d = materialize(d.withColumn("_part", F.spark_partition_id()))
    sizes = d.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("column", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("column", "_part").orderBy("value")
    d = d.join(sizes, ["column", "_part"]).withColumn("code", F.col("_before") + F.row_number().over(inside) - 1)
    return d.select("column", "value", F.col("code").cast("int").alias("code"))


def label_encode(df: DataFrame, columns: list[str] | None = None, exclude=("winner",),
                 fill: str = schemas.UNKNOWN_LABEL) -> DataFrame:
    """M1: replace string columns by the 0-based rank of their value among the column's
    distinct values (lexicographic), NULL filled with 'Unknown' first.

    The vocabulary (:func:`codes`) is a table; each column is joined with its part, which
    the planner broadcasts only as long as it is small.
    """
    cols = columns or explore.string_columns(df, exclude=exclude)
    if not cols:
        return df
    filled = df.fillna({c: fill for c in cols})
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in cols]))
    known = materialize(codes(filled.select(pairs.alias("p")).select("p.*")))
    out = filled
    for k, c in enumerate(cols):
        part = known.where(F.col("column") == c).select(F.col("value").alias(f"_v{k}"), F.col("code").alias(f"_c{k}"))
        out = out.join(part, F.col(f"`{c}`") == F.col(f"_v{k}"), "left")
    at = {c: k for k, c in enumerate(cols)}
    return out.select(*[F.col(f"_c{at[c]}").alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])


def training_set(form: DataFrame) -> DataFrame:
    """M2 (+A17, P8, M1): classifier training table from the form dataset.

    ±inf -> NULL, recent economy NULLs -> global median, rows without scores
    dropped, the five categorical columns label-encoded. Keeps ``id``, the
    features in training order, ``team1_won`` and both score labels.
    """
    f = materialize(clean.finite_only(form))  # read for medians, vocabularies and output
    f = explore.median_impute(f, explore.with_gaps(f, ["team1_avg_economy_rate_last_5", "team2_avg_economy_rate_last_5"]))
    f = clean.require_columns(f, ["winning_score", "losing_score"])
    f = label_encode(f, columns=[c for c in schemas.CATEGORICAL if c in f.columns])
    feats = [c for c in f.columns if c not in NON_FEATURES]
    return f.select("id", *feats, "team1_won", "winning_score", "losing_score")


def feature_columns(df: DataFrame, extra_drop=()) -> list[str]:
    drop = set(NON_FEATURES) | set(extra_drop) | {"split", "label", "features", "weight", "fold"}
    return [c for c in df.columns if c not in drop]


def impute_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Exact global median for NULL/NaN features before fitting (Spark trees reject NaN)."""
    from faceoff.operators import clean
    d = materialize(clean.finite_only(df, [c for c in features if df.schema[c].dataType.simpleString() in ("double", "float")]))
    return explore.median_impute(d, explore.with_gaps(d, features))


def assemble(df: DataFrame, features: list[str], label: str | None = None, out: str = "features") -> DataFrame:
    """Feature vector (+ ``label`` as double) for Spark ML."""
    v = VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)
    return v.withColumn("label", F.col(label).cast("double")) if label else v


def split_random(df: DataFrame, key: str = "id", test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """M4: ``split`` = 'test' for rows whose hash falls below ``test_fraction``, else 'train'."""
    u = hash_unit(key, seed)
    return df.withColumn("split", F.when(u < F.lit(int(test_fraction * (1 << HASH_BITS))), "test").otherwise("train"))


def split_stratified(df: DataFrame, label: str, key: str = "id", test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """M3: exact per-class split: in each class the round(test_fraction·n_c) rows with the
    smallest hash (ties by key) are 'test'.

    A window over the label alone would put a whole class in one task. Instead
    rows are put in 2^16 hash buckets per class; a prefix count over the small
    (class, bucket) table gives each bucket's offset, and only ranks inside a
    bucket need a window — buckets are uniform because the hash is.
    """
    u = hash_unit(key, seed)
    d = df.withColumns({"_h": u, "_b": (u / F.lit((1 << HASH_BITS) // BUCKETS)).cast("int")})
    cnt = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(label).orderBy("_b")
    cnt = cnt.select(label, "_b",
                     F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                     F.sum("_n").over(Window.partitionBy(label)).alias("_nc"))
    c2 = cnt.withColumnsRenamed({label: "_lbl", "_b": "_bb"})
    j = d.join(c2, [F.col(label).eqNullSafe(F.col("_lbl")), F.col("_b") == F.col("_bb")], "inner")
    rank = F.col("_off") + F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    n_test = F.round(F.col("_nc") * F.lit(test_fraction))
    out = j.withColumn("split", F.when(rank <= n_test, "test").otherwise("train"))
    return out.drop("_h", "_b", "_bb", "_lbl", "_off", "_nc")


def impute_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean imputation then standard scaling with the population std (std 0 -> 1).

    One aggregate computes all means and stds; the single row of statistics is
    turned into literal expressions.
    """
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns]).first()
    exprs = {}
    for c in columns:
        m = stats[f"m_{c}"]
        s = stats[f"s_{c}"]
        if m is None:
            continue
        scale = s if (s is not None and s > 0) else 1.0
        exprs[c] = (F.coalesce(F.col(c).cast("double"), F.lit(m)) - F.lit(m)) / F.lit(scale)
    return df.withColumns(exprs) if exprs else df
