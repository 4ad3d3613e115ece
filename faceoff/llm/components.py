"""Connected components of a graph given by its edges, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): for every node of an edge the least node it is connected with.

    In every round each node that has a smaller neighbour hangs itself under the least
    one, the trees are flattened by looking up the parent's parent until nothing
    changes, and the edges are drawn anew between the roots. The edges left at least
    halve in every round; a hub is aggregated before it is shuffled.
    """
    spark = edges.sparkSession
    e = edges.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).where("x <> y").distinct()
    e = written(spark, e, "edges")
    ends = e.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    comp = written(spark, ends.select("node", F.col("node").alias("comp")), "comp")
    while not e.isEmpty():
        up = written(spark, e.groupBy(F.col("y").alias("c")).agg(F.min("x").alias("p")), "up")
        while True:
            higher = up.select(F.col("c").alias("q"), F.col("p").alias("pp"))
            nxt = written(spark, up.join(higher, up.p == higher.q, "left").select("c", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "up")
            discard(up)
            up = nxt
            if nxt.where("moved").isEmpty():
                break
        up = up.drop("moved")
        lower = written(spark, comp.join(up, comp.comp == up.c, "left").select("node", F.coalesce("p", "comp").alias("comp")), "comp")
        ux, uy = up.toDF("cx", "px"), up.toDF("cy", "py")
        between = e.join(ux, e.x == ux.cx, "left").join(uy, e.y == uy.cy, "left")
        between = between.select(F.coalesce("px", "x").alias("x"), F.coalesce("py", "y").alias("y"))
        between = written(spark, between.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct(), "edges")
        discard(comp, e, nxt)
        comp, e = lower, between
    discard(e)
    return comp
