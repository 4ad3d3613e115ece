"""Per-entity history in time order, computed without one task per entity.

A ``Window.partitionBy(entity)`` over raw rows sends an entity's whole history
to a single task; with a few hot entities (25 teams, one of them with a third of
all rows) that task is the job. Every operator here works in two levels instead:

1. rows are first reduced to one row per cell, a range of ``tie`` within an ``(entity, day)`` (partial
   aggregates, map-side combined; top-n tails bounded by ``n``);
2. the per-entity scan runs over that table of cells, whose size per entity is at most the
   number of distinct days in its history and of cuts (below), not its number of rows;
3. its result is joined back on the cell and the remaining
   part is a window partitioned by the cell. Both are one column, ``CELL``, so the
   rows are shuffled once for all three steps.

A day is cut into ranges where a thin sample of all rows, drawn by the hash of ``tie``, says so (:func:`cuts`): a
range has ``1 / RANGES`` of all rows (``LEAST`` in a small table), so a third of all rows on
one entity and day are some thousand cells. Which cell a row is in depends on its values and on the cuts alone,
hence is the same when a lost task runs again.

The order inside an entity is ``(time, tie)``; ``tie`` must be unique per entity
and time (the contest id). ``time`` should be a date (the day is the unit of
"strictly before"). A NULL venue or team is a group like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNB = Window.unboundedPreceding
#: The column that all steps on a cell share: a struct of the entity's keys, the time and the range of the tie.
CELL = "_cell"
#: About the most ranges that days are cut into, over all entities, and the least rows of a range.
RANGES = 8_192
LEAST = 10_000
#: Rows of the sample in each range.
SAMPLE = 32


def _keys(entity) -> list[str]:
    return [entity] if isinstance(entity, str) else list(entity)


def cuts(cells: DataFrame, tie: str) -> list[Row]:
    """Where the days of ``cells`` are cut: ``(cell, list of ties that start a range)``.

    A row in ``LEAST / SAMPLE`` (in a large table: in ``n / RANGES / SAMPLE``) is drawn, by the hash of its
    tie; of the ties drawn from a day, in order, every one that completes a range is a cut. The driver
    gets about ``RANGES`` ties at most, and none of a day that fits one range.
    """
    size = max(LEAST, cells.count() // RANGES)
    one_in = max(1, size // SAMPLE)
    step = max(1, size // one_in)
    drawn = (cells.where(F.pmod(F.xxhash64(tie), F.lit(one_in)) == 0)
             .groupBy(CELL).agg(F.sort_array(F.collect_list(tie)).alias("_t")).where(F.size("_t") >= step))
    starts = F.array_distinct(F.filter("_t", lambda x, i: (i + 1) % step == 0))
    return drawn.select(CELL, starts.alias("_cuts")).collect()


def with_cell(df: DataFrame, entity, time: str, tie: str) -> DataFrame:
    """``df`` with ``CELL``, counted and sampled in two jobs. A struct is never NULL and equal to another if its fields
    are, NULL ones too: grouping, windows and joins on it need one shuffle of the rows between them."""
    if CELL in df.columns:
        return df
    fields = [F.col(k).alias(f"k{i}") for i, k in enumerate(_keys(entity))]
    day = F.struct(F.struct(*fields).alias("entity"), F.col(time).alias("time"))
    found = cuts(df.select(day.alias(CELL), tie), tie)
    if not found:
        return df.withColumn(CELL, day.withField("part", F.lit(0)))
    base = df.withColumn(CELL, day)
    kinds = T.StructType([T.StructField("_cc", base.schema[CELL].dataType), T.StructField("_cuts", T.ArrayType(df.schema[tie].dataType))])
    # about RANGES ties in all, however large the table is
    base = base.join(F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in found], kinds)), F.col(CELL) == F.col("_cc"), "left")
    # binary search: the number of cuts at or before the tie, from its highest bit to its lowest
    bits = max(len(r["_cuts"]) for r in found).bit_length()
    part = F.aggregate(F.array(*[F.lit(1 << b) for b in reversed(range(bits))]), F.lit(0),
                       lambda at, bit: F.when(F.get("_cuts", at + bit - 1) <= F.col(tie), at + bit).otherwise(at))
    return base.withColumn(CELL, F.col(CELL).withField("part", part)).drop("_cc", "_cuts")


def _by_day(day: DataFrame) -> DataFrame:
    """The table of cells with the fields of ``CELL`` as columns, which all windows over an entity's cells share."""
    return day.withColumns({"_entity": F.col(f"{CELL}.entity"), "_day": F.col(f"{CELL}.time"), "_part": F.col(f"{CELL}.part")})


def _days():
    """The cells of one entity in order: a window over the table of cells."""
    return Window.partitionBy("_entity").orderBy("_day", "_part")


def _in_day(tie):
    return Window.partitionBy(CELL).orderBy(tie)


def _attach(rows: DataFrame, day: DataFrame) -> DataFrame:
    """The table of cells joined back onto the rows."""
    return rows.join(day.withColumnRenamed(CELL, "_jc"), F.col(CELL) == F.col("_jc"), "left").drop("_jc")


def last_n(arr: Column, n: int) -> Column:
    """The last ``n`` elements of an array (all of them when shorter)."""
    return F.slice(arr, F.greatest(F.size(arr) - F.lit(n - 1), F.lit(1)), n)


def running(df: DataFrame, entity, time: str, tie: str, sums: dict[str, Column],
            inclusive: bool = False) -> DataFrame:
    """Running sums in entity order: over all earlier rows (or up to and including the row).

    Rows of earlier cells come in through partial sums of each and a prefix scan
    over the table of cells; earlier rows of the same cell through a window on it.
    """
    vals = {f"_v_{k}": e for k, e in sums.items()}
    base = with_cell(df, entity, time, tie).withColumns(vals)
    day = _by_day(base.groupBy(CELL).agg(*[F.sum(v).alias(f"_d{v}") for v in vals]))
    wd = _days().rowsBetween(UNB, -1)
    day = day.select(CELL, *[F.sum(f"_d{v}").over(wd).alias(f"_p{v}") for v in vals])
    out = _attach(base, day)
    wi = _in_day(tie).rowsBetween(UNB, 0 if inclusive else -1)
    res = {}
    for k in sums:
        v = f"_v_{k}"
        res[k] = F.coalesce(F.col(f"_p{v}"), F.lit(0)) + F.coalesce(F.sum(v).over(wi), F.lit(0))
    out = out.withColumns(res)
    return out.drop(CELL, *vals, *[f"_p{v}" for v in vals])


def prior_rows(df: DataFrame, entity, time: str, tie: str, n: int, fields: dict[str, Column],
               strict_time: bool = True, out: str = "_prior", values: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``out``: array of the last ``n`` earlier rows as structs ``(t, k, *fields)``, oldest first.

    ``strict_time=True``: rows of strictly earlier days only (all rows of a day see
    the same history). ``False``: all rows before this one in ``(time, tie)`` order.
    Each cell contributes at most its last ``n`` rows and a cell looks back at most
    ``n`` non-empty cells, so arrays never exceed ``n*n`` elements. With ``strict_time`` all
    cells of a day take what the first of them sees.

    With ``values``, these columns, expressions of ``out``, are added instead of it. With ``strict_time`` all rows of a cell
    have the same: they are computed once a cell, and no array is joined onto the rows.
    """
    rec = F.struct(F.col(time).alias("t"), F.col(tie).alias("k"), *[e.alias(f) for f, e in fields.items()])
    # one windowed base for both branches: its shuffle is planned once and reused
    rd = F.row_number().over(Window.partitionBy(CELL).orderBy(F.col(tie).desc()))
    base = with_cell(df, entity, time, tie).withColumn("_rec", rec).withColumn("_rd", rd)
    tails = _by_day(base.filter(F.col("_rd") <= n).groupBy(CELL).agg(F.collect_list("_rec").alias("_tail")))
    prev = tails.withColumn("_pp", F.collect_list("_tail").over(_days().rowsBetween(-n, -1)))
    prev = prev.withColumn("_pd", last_n(F.array_sort(F.flatten("_pp")), n))
    if strict_time:
        prev = prev.withColumn("_pd", F.first("_pd").over(Window.partitionBy("_entity", "_day").orderBy("_part")))
    if strict_time and values is not None:
        none = F.array().cast(prev.schema["_pd"].dataType)
        prev = prev.withColumn(out, F.coalesce(F.col("_pd"), none)).withColumns(values).select(CELL, *values)
        return _attach(base.drop(*values), prev).drop(CELL, "_rec", "_rd")
    prev = prev.select(CELL, "_pd")
    res = _attach(base, prev)
    pd_ = F.coalesce(F.col("_pd"), F.array().cast(res.schema["_pd"].dataType))
    if strict_time:
        res = res.withColumn(out, pd_)
    else:
        wi = _in_day(tie).rowsBetween(-n, -1)
        res = res.withColumn(out, last_n(F.concat(pd_, F.collect_list("_rec").over(wi)), n))
    res = res.drop(CELL, "_rec", "_pd", "_rd")
    return res if values is None else res.withColumns(values).drop(out)


def lag_value(df: DataFrame, entity, time: str, tie: str, value: str, out: str, keep_cell: bool = False) -> DataFrame:
    """Value of the previous row of the same entity (NULL for its first row). ``keep_cell`` leaves ``CELL``
    for a further step on the same entity and time."""
    base = with_cell(df, entity, time, tie)
    day = _by_day(base.groupBy(CELL).agg(F.max_by(F.struct(F.col(value).alias("v")), F.col(tie)).alias("_last")))
    day = day.select(CELL, F.lag("_last").over(_days()).alias("_prevday"))
    res = _attach(base, day)
    wi = _in_day(tie)
    res = res.withColumn(out, F.when(F.row_number().over(wi) == 1, F.col("_prevday.v"))
                         .otherwise(F.lag(value).over(wi)))
    return res.drop("_prevday") if keep_cell else res.drop("_prevday", CELL)


def signed_streak(df: DataFrame, entity, time: str, tie: str, outcome: str,
                  out_before: str = "streak_before", out_after: str | None = None) -> DataFrame:
    """Signed run length of equal outcomes: +k after k wins in a row, -k after k losses.

    ``outcome`` must be 1 (win), -1 (loss) or 0 (anything else; resets to 0).
    ``out_before`` is the streak entering the row, ``out_after`` the one leaving it.

    With ``idx`` the 0-based position in entity order, the streak after row i is
    ``i - L(i)`` where ``L(i)`` is the last position <= i whose outcome differs. L is
    a running max, built from maxima of cells and a prefix max over the table of cells.
    """
    wi = _in_day(tie)
    o = F.col(outcome)
    base = with_cell(df, entity, time, tie).withColumn("_pos", F.row_number().over(wi) - 1)
    day = base.groupBy(CELL).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(o != 1, F.col("_pos"))).alias("_mw"),
        F.max(F.when(o != -1, F.col("_pos"))).alias("_ml"),
        F.max_by(o, F.col("_pos")).alias("_lo"),
    )
    day = _by_day(day)
    wd = _days()
    prior = wd.rowsBetween(UNB, -1)
    day = day.withColumn("_start", F.coalesce(F.sum("_n").over(prior), F.lit(0)))
    day = day.select(
        CELL, "_start",
        F.coalesce(F.max(F.col("_start") + F.col("_mw")).over(prior), F.lit(-1)).alias("_lwb"),
        F.coalesce(F.max(F.col("_start") + F.col("_ml")).over(prior), F.lit(-1)).alias("_llb"),
        F.lag("_lo").over(wd).alias("_plo"),
    )
    res = _attach(base, day)
    idx = F.col("_start") + F.col("_pos")
    run = wi.rowsBetween(UNB, 0)
    lw = F.greatest(F.col("_lwb"), F.max(F.when(o != 1, idx)).over(run))
    ll = F.greatest(F.col("_llb"), F.max(F.when(o != -1, idx)).over(run))
    res = res.withColumn("_after", F.when(o == 1, idx - lw).when(o == -1, -(idx - ll)).otherwise(F.lit(0)))
    p = F.col("_start") - 1
    from_prev_day = (F.when(F.col("_plo") == 1, p - F.col("_lwb"))
                     .when(F.col("_plo") == -1, -(p - F.col("_llb"))).otherwise(F.lit(0)))
    res = res.withColumn(out_before, F.when(F.col("_pos") == 0, from_prev_day)
                         .otherwise(F.lag("_after").over(wi)).cast("long"))
    if out_after:
        res = res.withColumn(out_after, F.col("_after").cast("long"))
    return res.drop(CELL, "_pos", "_start", "_lwb", "_llb", "_plo", "_after")


def latest_n(df: DataFrame, entity, order: list[Column], n: int, out: str = "_rank") -> DataFrame:
    """Top ``n`` rows per entity by ``order`` (descending = latest first).

    ``row_number() <= n`` is planned as a window group limit: each map task keeps
    only its top ``n`` per entity before the shuffle, so a hot entity ships n rows.
    """
    ent = _keys(entity)
    w = Window.partitionBy(*ent).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)
