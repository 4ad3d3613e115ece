"""Dataset exploration statistics.

Everything is a grouped aggregate; scalar results (one row) are the only thing
that ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faceoff.scratch import materialize


def _all_classes():
    """Window over an already grouped per-class table (k rows, k = number of labels)."""
    return Window.partitionBy()


NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of numeric type."""
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in NUMERIC and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in exclude]


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Count and share of each label value (NULL labels excluded)."""
    g = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return g.select(label, "n", (F.col("n") / F.sum("n").over(_all_classes())).alias("share"))


def _stack(pairs: list[tuple[str, object]], key: str, value: str) -> str:
    parts = ", ".join(f"'{name}', {expr}" for name, expr in pairs)
    return f"stack({len(pairs)}, {parts}) AS ({key}, {value})"


def target_correlation(df: DataFrame, target: str, features: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with ``target`` (pairwise non-null).

    One aggregate with one ``corr`` per column, then a ``stack`` to long form.
    Undefined correlations (constant column) are NULL.
    """
    feats = features or numeric_columns(df, exclude=(target,))
    aggs = [F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}") for i, c in enumerate(feats)]
    one = df.agg(*aggs)
    long = one.selectExpr(_stack([(c, f"c{i}") for i, c in enumerate(feats)], "feature", "correlation"))
    return long.withColumn("correlation", F.when(~F.isnan("correlation"), F.col("correlation")))


def top_correlated(corr: DataFrame, k: int = 10) -> DataFrame:
    """O3: top ``k`` and bottom ``k`` features by correlation (ties by name)."""
    c = corr.filter(F.col("correlation").isNotNull())
    top = c.orderBy(F.col("correlation").desc(), F.col("feature")).limit(k).withColumn("end", F.lit("top"))
    bottom = c.orderBy(F.col("correlation").asc(), F.col("feature")).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def category_by_target(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Counts per (category, target)."""
    return df.groupBy(feature, target).agg(F.count(F.lit(1)).alias("n"))


def quantiles(values: DataFrame, groups: list[str], probabilities: list[float], value: str = "value") -> DataFrame:
    """Exact quantiles of each group, interpolated between neighbouring ranks: ``groups``, ``n`` and ``q``, an
    array in the order of ``probabilities``. NULL values don't count; groups may be NULL.

    No task holds a group: equal values are counted, the counts are dealt into ranges of
    (group, value), a prefix sum over the ranges and one inside each gives every value its ranks, and
    the values at the wanted ranks are looked up.
    """
    keys = [f"_g{k}" for k in range(2 * len(groups))]
    # two columns for each group, never null, so that all steps are plain equalities
    named = [x for k, g in enumerate(groups) for x in (F.col(g).isNull().alias(keys[2 * k]), F.coalesce(F.col(g).cast("string"), F.lit("")).alias(keys[2 * k + 1]))]
    kinds = {g: values.schema[g].dataType for g in groups}
    counts = values.where(F.col(value).isNotNull()).select(*named, F.col(value).cast("double").alias("_x")).groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    ranges = materialize(counts.repartitionByRange(*[F.col(k) for k in keys], F.col("_x")).withColumn("_part", F.spark_partition_id()))
    sums = ranges.groupBy(*keys, "_part").agg(F.sum("_c").alias("_s"))
    order = Window.partitionBy(*keys).orderBy("_part")
    sums = sums.withColumn("_before", F.sum("_s").over(order) - F.col("_s")).withColumn("_n", F.sum("_s").over(Window.partitionBy(*keys))).drop("_s")
    inside = Window.partitionBy(*keys, "_part").orderBy("_x")
    ranked = ranges.join(sums, [*keys, "_part"]).withColumn("_end", F.col("_before") + F.sum("_c").over(inside))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("at")) for i, p in enumerate(probabilities)])
    ranked = ranked.withColumn("_w", F.explode(wanted)).withColumn("_low", F.floor("_w.at")).withColumn("_high", F.ceil("_w.at"))
    here = lambda rank: (F.col(rank) < F.col("_end")) & (F.col(rank) >= F.col("_end") - F.col("_c"))
    found = ranked.where(here("_low") | here("_high")).groupBy(*keys, "_n", F.col("_w.i").alias("_i"), F.col("_w.at").alias("_at")).agg(
        F.max(F.when(here("_low"), F.col("_x"))).alias("_a"), F.max(F.when(here("_high"), F.col("_x"))).alias("_b"))
    share = F.col("_at") - F.floor("_at")
    between = F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") * (1 - share) + F.col("_b") * share)
    out = found.groupBy(*keys, "_n").agg(F.sort_array(F.collect_list(F.struct("_i", between.alias("q")))).alias("_q"))
    back = [F.when(~F.col(keys[2 * k]), F.col(keys[2 * k + 1]).cast(kinds[g])).alias(g) for k, g in enumerate(groups)]
    return out.select(*back, F.col("_n").alias("n"), F.transform("_q", lambda x: x["q"]).alias("q"))


def box_stats(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per (feature, target class).

    Whiskers are the most extreme values inside the fences. Quartiles are exact (:func:`quantiles`).
    """
    long = df.selectExpr(target, _stack([(c, f"CAST({c} AS DOUBLE)") for c in features], "feature", "value"))
    long = long.filter(F.col("value").isNotNull())
    q = quantiles(long, ["feature", target], [0.25, 0.5, 0.75])
    q = q.select(F.col("feature").alias("_f"), F.col(target).alias("_t"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    # q has one row per (feature, class): a bounded table; a shuffle join on so few keys would skew
    j = long.join(F.broadcast(q), (F.col("feature") == F.col("_f")) & F.col(target).eqNullSafe(F.col("_t")))
    lo, hi = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    v = F.col("value")
    return j.groupBy("feature", target, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo, v)).alias("whisker_low"),
        F.max(F.when(v <= hi, v)).alias("whisker_high"),
        F.count_if((v < lo) | (v > hi)).alias("outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact global medians, None for a column without values (a row a column comes to the driver)."""
    if not columns:
        return {}
    long = df.selectExpr(_stack([(c, f"CAST({c} AS DOUBLE)") for c in columns], "feature", "value"))
    found = {r["feature"]: r["q"][0] for r in quantiles(long, ["feature"], [0.5]).collect()}
    return {c: found.get(c) for c in columns}


def with_gaps(df: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` that have a NULL or NaN anywhere: the others need no median (one aggregate)."""
    if not columns:
        return []
    gap = {c: F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double")) for c in columns}
    found = df.agg(*[F.max(F.coalesce(g, F.lit(True))).alias(str(k)) for k, g in enumerate(gap.values())]).first()
    return [c for k, c in enumerate(columns) if found[k]]


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULLs of each column with the column's global median."""
    med = medians(df, columns)
    fill = {c: float(v) for c, v in med.items() if v is not None}
    return df.fillna(fill) if fill else df


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: count, 'balanced' weight n/(k·n_c), and scale_pos_weight = neg/pos (1 if no pos)."""
    g = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    j = g.select(label, "n", F.sum("n").over(_all_classes()).alias("_t"),
                 F.count(F.lit(1)).over(_all_classes()).alias("_k"),
                 F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).over(_all_classes()).alias("_pos"))
    return j.select(
        label, "n",
        (F.col("_t") / (F.col("_k") * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("_pos") > 0, (F.col("_t") - F.col("_pos")) / F.col("_pos")).otherwise(F.lit(1.0))
         .alias("scale_pos_weight"),
    )
