"""Audit of how filters interact: what each filter removes in every order of application.

Method: forward-backward path counting over the lattice of filter subsets. A state is the
set of filters applied so far, an edge adds one filter, an order is a path from the empty
set to the full one. One forward pass counts the orders that reach each state, one
backward pass those that leave it; the product over an edge is the number of orders that
pass it, which weights the edge's removals for the Shapley value. The steps of a single
order are read from the same edges: removals depend on the set applied before, not on its order.

Plan: documents are reduced to counts by (part, set of failed filters) with map-side
combining, at most 2 ** 5 rows a part and kind of label; edges and orders are literal arrays of
80 and 600 entries that are exploded or looked up per part, so nothing is joined there. Exact
copies are found on digests of whole texts: the least id of each digest is aggregated, and
rows meet it by (digest, id), so a large group of copies is in no one task.

Cases: null text counts as empty, and empty texts are copies of each other; a null source
is the part of the empty name; a null id has no smaller id, and is none: it fails no copy filter; rows of
one id and text do not make each other copies; labels are joined by id, an id is marked if any of its label rows
says so, null ids never; an empty table gives an empty table; columns beyond those named
are not looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import text_of, written

FILTERS = "ABCDE"
FEW_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 50, 65, 5
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def paths_through() -> list[tuple[int, int, int]]:
    """All edges (state, filter, number of orders that pass it) of the lattice, by a forward and a backward count."""
    n = len(FILTERS)
    states = sorted(range(1 << n), key=lambda s: s.bit_count())
    reaching, leaving = {0: 1}, {(1 << n) - 1: 1}
    for s in states[1:]:
        reaching[s] = sum(reaching[s ^ (1 << f)] for f in range(n) if s >> f & 1)
    for s in reversed(states[:-1]):
        leaving[s] = sum(leaving[s | (1 << f)] for f in range(n) if not s >> f & 1)
    assert leaving[0] == factorial(n)
    return [(s, f, reaching[s] * leaving[s | (1 << f)]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def orders() -> list[tuple[str, int, int]]:
    """(order, step, number of its edge) for every order and step from 1 on."""
    edge = {(s, f): k for k, (s, f, _) in enumerate(paths_through())}
    out = []
    for p in permutations(range(len(FILTERS))):
        applied = 0
        for step, f in enumerate(p, 1):
            out.append(("".join(FILTERS[x] for x in p), step, edge[applied, f]))
            applied |= 1 << f
    return out


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at a text alone: few words, few distinct words, many capitals, odd symbols."""
    # one separator instead of six makes the split a plain one; empty pieces are no words
    words = F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " ")
    n = F.size(F.array_remove(words, "")).cast("long")
    distinct = F.size(F.array_remove(F.array_distinct(words), "")).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [n < FEW_WORDS, distinct * 100 < n * DISTINCT_PERCENT, capitals * 100 > F.length(text).cast("long") * CAPITALS_PERCENT,
             text.rlike("[#$%&*|]")]
    bits = F.lit(0)
    for k, failed in enumerate(fails):
        bits = bits + F.when(failed, 1 << k).otherwise(0)
    return bits


def failures(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """Counts of alike rows: ``part``, ``fails`` (bits in the order of ``FILTERS``), ``good`` and
    ``toxic`` (labels) and ``n``."""
    t = text_of(docs, text)
    rows = docs.select("doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(t, 256)).alias("copy"), text_failures(t).alias("fails"))
    rows = written(docs.sparkSession, rows, "audit-rows")
    first = rows.groupBy("copy").agg(F.min("doc_id").alias("least")).withColumnRenamed("copy", "_copy")
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id"))
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    # alike rows are one from here on, however often they repeat
    alike = rows.groupBy("copy", "doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    alike = alike.join(first, (F.col("copy") == F.col("_copy")) & (F.col("doc_id") == F.col("least")), "left")
    alike = alike.join(known, F.col("doc_id") == F.col("_id"), "left")
    again = F.col("doc_id").isNotNull() & F.col("least").isNull()
    fails = F.col("fails") + F.when(again, 1 << FILTERS.index("E")).otherwise(0)
    said = lambda c: F.coalesce(F.col(c), F.lit(0))
    return alike.groupBy("part", fails.alias("fails"), said("_good").alias("good"), said("_toxic").alias("toxic")).agg(F.sum("n").alias("n"))


def audit(counts: DataFrame) -> DataFrame:
    """For every part, order and step the counts ``COUNTS`` of the step, from the rows of ``failures``."""
    edges = paths_through()
    n = F.col("n")
    some = lambda condition, of=n: F.sum(F.when(condition, of).otherwise(0))
    literal = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(s).alias("s"), F.lit(f).alias("f"), F.lit(w).cast("long").alias("w"))
                        for k, (s, f, w) in enumerate(edges)])
    each = counts.withColumn("e", F.explode(literal)).select("part", "fails", "good", "toxic", "n", "e.*")
    before = F.col("fails").bitwiseAND(F.col("s"))
    own = F.col("fails").bitwiseAND(_bit(F.col("f"))) != 0
    here = own & (before == 0)
    each = each.groupBy("part", "k", "f", "w").agg(
        some((before == 0) & ~own).alias("kept"), some(here).alias("removed"), some(own & (before != 0)).alias("redundant"),
        some(F.col("fails") == _bit(F.col("f"))).alias("unique_fails"), some(here & (F.col("good") == 1)).alias("good_lost"),
        some(here & (F.col("toxic") == 1)).alias("toxic_lost"))
    # a part's edges in one row: 80 structs, whatever the number of documents
    counted = [c for c in COUNTS if c != "shapley"]
    part = each.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("k", "f", "w", *counted))).alias("edges"))
    share = lambda f: F.aggregate("edges", F.lit(0).cast("long"), lambda a, x: a + F.when(x["f"] == f, x["w"] * x["removed"]).otherwise(0))
    part = part.withColumn("shapleys", F.array(*[share(f) for f in range(len(FILTERS))]))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step"), F.lit(k).alias("k")) for o, i, k in orders()])
    out = part.withColumn("o", F.explode(steps)).select("part", "o.filter_order", "o.step", F.get("edges", F.col("o.k")).alias("e"), "shapleys")
    return out.select("part", "filter_order", "step", *[F.col(f"e.{c}") for c in counted], F.get("shapleys", F.col("e.f")).alias("shapley"))


def _bit(f: Column) -> Column:
    return F.get(F.array(*[F.lit(1 << k) for k in range(len(FILTERS))]), f)
