"""Merkle manifest of a dataset: a hash tree for each group of rows and one over the groups.

Method: lag and lead windows. At every level the nodes of a group are numbered; a node's
siblings are the nodes a fixed number of rows before and after it, as far as its slot in
the run of ``FANOUT`` nodes and the length of that run allow. The first child of a run
hashes its siblings' digests and its own into the parent.

Plan: rows are numbered within their group over ranges of (group, order), never a group
in one task. ``LEVELS`` levels are computed at once: a block of ``FANOUT ** LEVELS``
consecutive nodes is a window partition, in which the nodes of level l are
``FANOUT ** l`` rows apart. The roots of the blocks (1 in ``FANOUT ** LEVELS`` rows) are
the nodes of the next round, and are written. On the way back every block gets the path of
its root, by a join on the block, which is the partitioning its rows already have. Only
the number of nodes of the largest group reaches the driver.

Cases: a null group is a group of its own, before all others; a null order key comes
first; equal order keys are ordered by the leaf, and equal leaves are interchangeable, so
repeated rows are leaves of their own and the root does not depend on how rows are dealt.
Columns of a row may be null and texts empty or very long (a leaf reads a text once). A lone
leaf is the root of its group. An empty table gives an empty table. Extra columns are
passed through; those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from faceoff.llm.common import without, written

FANOUT = 8
#: Levels computed in one window partition, which holds FANOUT ** LEVELS nodes.
LEVELS = 3
BITS = FANOUT.bit_length() - 1
BLOCK_BITS = BITS * LEVELS


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*columns: Column) -> Column:
    """The leaf of a row: the digest of its values, each with its length in bytes before it; ``-`` if null."""
    def framed(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(*[framed(c) for c in columns])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path (array of struct left, right) lead to."""
    return F.aggregate(path, leaf, lambda acc, p: digest(p["left"], acc, p["right"]))


def siblings(path: Column) -> Column:
    """All digests on a path in one string, from the leaf's level to the root's."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` (with ``_g``, never null) with ``_i``, the position in the group from 0 on, and ``_n``, its size.

    The rows are written in ranges of (group, order); a range's rows are counted, the
    counts of a group are summed up over the ranges, and a window numbers the rows inside a range.
    """
    spark = rows.sparkSession
    keys = [F.col("_g"), *order, F.col("_copy")]
    d = rows.withColumn("_copy", F.monotonically_increasing_id())  # parts rows that are alike
    d = written(spark, d.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = d.groupBy(F.col("_part").alias("_p"), F.col("_g").alias("_gg")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_gg").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    sizes = sizes.withColumn("_n", F.sum("_size").over(Window.partitionBy("_gg"))).drop("_size")
    d = d.join(sizes, (F.col("_part") == F.col("_p")) & (F.col("_g") == F.col("_gg"))).drop("_p", "_gg")
    within = Window.partitionBy("_part", "_g").orderBy(*order, "_copy")
    d = d.withColumn("_i", F.col("_before") + F.row_number().over(within) - 1)
    return written(spark, d.drop("_part", "_copy", "_before"), "numbered")


def _block() -> WindowSpec:
    return Window.partitionBy("_g", "_block").orderBy("_i")


def _level(level: int) -> tuple[Column, Column, Column, Column]:
    """Of a level: whether the row is a node of it, the node's slot, the length of its run, and
    whether the group has several nodes there."""
    i, n = F.col("_i"), F.col("_n")
    step = FANOUT ** level
    node = i.bitwiseAND(F.lit(step - 1)) == 0
    at = F.shiftright(i, BITS * level)
    slot = at.bitwiseAND(F.lit(FANOUT - 1))
    count = F.shiftright(n + (step - 1), BITS * level)
    return node, slot, F.least(F.lit(FANOUT).cast("long"), count - (at - slot)), n > step


def _following(level: int, slot: Column, run: Column) -> list[Column]:
    step, v = FANOUT ** level, F.col(f"_v{level}")
    return [F.when(slot + k < run, F.lead(v, k * step).over(_block())) for k in range(1, FANOUT)]


def _preceding(level: int, slot: Column) -> list[Column]:
    step, v = FANOUT ** level, F.col(f"_v{level}")
    return [F.when(slot >= k, F.lag(v, k * step).over(_block())) for k in range(FANOUT - 1, 0, -1)]


def _climbed(nodes: DataFrame, paths: bool) -> DataFrame:
    """Nodes (``_g``, ``_i``, ``_n``, ``_v0``) with ``_block`` and ``_v<LEVELS>``, the root of their block,
    on the block's first row; with ``paths`` also ``_path``, the siblings below that root."""
    d = nodes.withColumn("_block", F.shiftright("_i", BLOCK_BITS))
    for level in range(LEVELS):
        node, slot, run, several = _level(level)
        after = F.concat_ws("", *_following(level, slot, run))
        d = d.withColumn("_right", F.when(node, after))
        if paths:
            before = F.concat_ws("", *_preceding(level, slot))
            own = F.when(node & several, F.struct(before.alias("left"), F.col("_right").alias("right")))
            d = d.withColumn("_own", own)
            # rows below a node are the ones from it on: the nearest node before a row is its ancestor
            seen = F.last("_own", ignorenulls=True).over(_block().rowsBetween(Window.unboundedPreceding, 0))
            d = d.withColumn(f"_p{level}", F.col("_own") if level == 0 else seen).drop("_own")
        v = F.col(f"_v{level}")
        first = node & (slot == 0)
        d = d.withColumn(f"_v{level + 1}", F.when(first, F.when(several, digest(v, F.col("_right"))).otherwise(v)))
    if paths:
        d = d.withColumn("_path", F.array_compact(F.array(*[f"_p{level}" for level in range(LEVELS)])))
    return d.drop("_right", *[f"_p{level}" for level in range(LEVELS)], *[f"_v{level}" for level in range(1, LEVELS)])


def _rounds(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The nodes and, round by round, the roots of their blocks, up to one root a group."""
    out = [nodes]
    while largest > 1:
        up = _climbed(out[-1].select("_g", "_i", "_n", "_v0"), False).where(F.col("_i").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) == 0)
        count = F.shiftright(F.col("_n") + ((1 << BLOCK_BITS) - 1), BLOCK_BITS)
        up = up.select("_g", F.col("_block").alias("_i"), count.alias("_n"), F.col(f"_v{LEVELS}").alias("_v0"))
        out.append(written(nodes.sparkSession, up, "blocks"))
        largest = -(-largest >> BLOCK_BITS)
    return out


def _descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first round with ``_path`` and the columns of ``above``, which has a row
    for each root (``_g``, ``_path``)."""
    have = above
    for nodes in reversed(rounds[:-1]):
        low = _climbed(nodes, True).drop(f"_v{LEVELS}")
        key = [F.col("_g") == F.col("_ug"), F.col("_block") == F.col("_ub")]
        got = have.withColumnsRenamed({"_g": "_ug", "_path": "_up"})
        got = got.withColumnRenamed("_i", "_ub") if "_i" in have.columns else got.withColumn("_ub", F.lit(0).cast("long"))
        have = low.join(got.drop("_n", "_v0"), key).withColumn("_path", F.concat("_path", "_up")).drop("_ug", "_ub", "_up", "_block")
    if len(rounds) == 1:  # every group is a lone leaf
        have = rounds[0].join(above.withColumnRenamed("_g", "_ug"), F.col("_g") == F.col("_ug")).drop("_ug")
    return have


def _largest(nodes: DataFrame) -> int:
    return nodes.agg(F.max("_n").alias("n")).first()["n"] or 0


def manifest(rows: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """``rows`` with ``subroot`` (of the row's group), ``root`` and ``path``: an array from the
    leaf's level to the root's of the digests left and right of the node among its run."""
    d = without(rows, "subroot", "root", "path", "_g", "_i", "_n", "_v0", "_path", "_block", "_copy", "_part")
    spark, columns = d.sparkSession, d.columns
    # a marked name is never null, and the empty one of the null group comes first
    d = d.withColumn("_g", F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")))
    d = written(spark, d.withColumn("_v0", F.col(f"`{leaf}`")), "leaves")
    nodes = numbered(d, F.col(f"`{order}`").asc_nulls_first(), F.col("_v0").asc())
    low = _rounds(nodes, _largest(nodes))
    tops = low[-1].select(F.lit("").alias("_g"), F.col("_g").alias("_name"), "_v0")
    tops = numbered(tops, F.col("_name").asc())
    high = _rounds(tops, _largest(tops))
    root = high[-1].select("_g", F.col("_v0").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("_path"))
    above = _descended(high, root)
    above = above.select(F.col("_name").alias("_g"), F.col("_v0").alias("subroot"), "root", "_path")
    out = _descended(low, above)
    return out.select(*[F.col(f"`{c}`") for c in columns], "subroot", "root", F.col("_path").alias("path"))
