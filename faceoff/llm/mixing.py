"""Mixing sources to target weights by balanced sampling.

Method: cube method. A source that shall give r times its words gives every document
floor(r) times, and once more with probability r - floor(r). These inclusion
probabilities are moved together through the null space of the balancing constraints
(number of words and number of documents) until almost all are 0 or 1: in every step
three open documents move so that both sums stay the same and one of them is decided.
Each block of documents of a source keeps at most two open ones; they are gathered into
new blocks, level after level, until one block per source is left. Its last two are
decided so that the source's words come nearest to the target (the landing). These two may be
large; then a few documents of the last block change sides, always the one that brings
the words nearest, until none helps any more.

A hot source is many blocks of about ``BLOCK`` documents, dealt out by a hash of the
document. Only ids, sizes and probabilities are shuffled, not texts. What reaches the
driver is a row for each source.

Cases: null text counts as empty (size 0); a null source is a source of its own and last;
a source without words has target 0 and gives nothing; an empty table gives an empty
table; repeated rows are decided one by one; equal inputs give equal results in every
run; columns named like a result column are replaced.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import WORD, doc_key, text_of, without, written

BLOCK = 2000
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 20
#: A probability this near to 0 or 1 is 0 or 1 (rounding of the steps).
NEAR = 1e-9


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Words to take from each source: all words shared by weight; what exceeds ``most``
    times a source's size is shared again among the others until none is above."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    cap = {s: float(most * n) for s, n in order}
    fixed: dict[str | None, float] = {}
    total = float(sum(n for _, n in order))
    while True:
        open_ = [s for s, _ in order if s not in fixed]
        left, by = total - sum(fixed.values()), sum(weight[s] for s in open_)
        share = {s: left * weight[s] / by for s in open_}
        above = [s for s in open_ if share[s] > cap[s]]
        if not above:
            return fixed | share
        fixed |= {s: cap[s] for s in above}


def flight(p: list[float], size: list[int], rng: random.Random) -> list[int]:
    """Move probabilities ``p`` in place until at most two are open; returns the open ones.

    Of three open documents with sizes a, b, c the direction (b - c, c - a, a - b) keeps
    the sum of probabilities and the sum of expected words; of two of equal size (1, -1).
    The step's sense is drawn so that every probability keeps its expectation.
    """
    open_: list[int] = []
    for k in range(len(p)):
        if not NEAR < p[k] < 1 - NEAR:
            p[k] = float(round(p[k]))
            continue
        open_.append(k)
        if len(open_) == 2 and size[open_[0]] == size[open_[1]]:
            _step(p, open_, (1.0, -1.0), rng)
        elif len(open_) == 3:
            a, b, c = (size[i] for i in open_)
            _step(p, open_, (float(b - c), float(c - a), float(a - b)), rng)
        open_ = [i for i in open_ if 0.0 < p[i] < 1.0]
    return open_


def _step(p: list[float], at: list[int], u: tuple[float, ...], rng: random.Random) -> None:
    moves = [(p[i], x) for i, x in zip(at, u) if x]
    ahead = min((1 - v) / x if x > 0 else v / -x for v, x in moves)
    back = min(v / x if x > 0 else (1 - v) / -x for v, x in moves)
    by = ahead if rng.random() * (ahead + back) < back else -back
    for i, x in zip(at, u):
        v = p[i] + by * x
        p[i] = 0.0 if v < NEAR else 1.0 if v > 1 - NEAR else v


def landing(p: list[float], size: list[int], open_: list[int]) -> None:
    """Decide the last open documents so that the words taken come nearest to their expectation."""
    best = min(range(1 << len(open_)), key=lambda m: (abs(sum((((m >> k) & 1) - p[i]) * size[i] for k, i in enumerate(open_))), m))
    for k, i in enumerate(open_):
        p[i] = float((best >> k) & 1)


def touch_down(p: list[float], size: list[int], goal: float) -> None:
    """Let decided documents change sides, one by one, as long as the words taken come nearer to ``goal``."""
    words = np.array(size, np.int64)
    sign = np.where(np.array(p) > 0.5, -1, 1)  # what a change adds: its words, or takes them away
    left = goal - float(words[sign < 0].sum())
    while True:
        after = np.abs(left - sign * words)
        best = int(after.argmin())
        if not after[best] < abs(left) - 1e-9:
            return
        left -= float(sign[best] * words[best])
        sign[best] = -sign[best]
        p[best] = 1.0 if sign[best] < 0 else 0.0


def _decide(last: bool):
    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mark", "doc_id", "size"], kind="stable", ignore_index=True)
        p, size = pdf["p"].tolist(), pdf["size"].tolist()
        rng = random.Random(f"{SEED} {pdf['number'].iloc[0]} {pdf['block'].iloc[0]}")
        open_ = flight(p, size, rng)
        if last:
            goal = sum(a * b for a, b in zip(pdf["p"], size))
            landing(p, size, open_)
            touch_down(p, size, goal)
        pdf["p"] = p
        return pdf
    return block


def sizes(docs: DataFrame, text: str = "text"):
    """Number of words of a text."""
    return F.regexp_count(text_of(docs, text), F.lit(WORD)).cast("long")


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, source, mark (hash of its text), size, source_size,
    target (its source's) and copies (how often the mix takes it)."""
    spark = docs.sparkSession
    d = docs.select("doc_id", "source", F.xxhash64(text_of(docs, text)).alias("mark"), sizes(docs, text).alias("size"))
    d = written(spark, d, "mix-sizes")
    by_source = [(r["source"], r["s"], r["n"]) for r in d.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()]
    goal = targets([(s, n) for s, n, _ in by_source])
    rows = []
    for k, (s, words, n) in enumerate(sorted(by_source, key=lambda x: (x[0] is None, x[0] or ""))):
        rate = min(float(MOST_REPEATS), goal[s] / words) if words else 0.0
        whole = int(rate)
        rows.append((s, k, words, goal[s], whole, rate - whole, n))
    table = spark.createDataFrame(rows, "_s string, number int, source_size long, target double, whole int, p double, n long")
    d = d.join(table, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    parts = [d.where("p = 0").drop("n").withColumn("block", F.lit(0).cast("long"))]
    d, most, level = d.where("p > 0"), max((r[6] for r in rows), default=0), 0
    while most:
        n_blocks = F.ceil(F.col("n") / BLOCK) if most > BLOCK else F.lit(1)
        d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "mark", F.lit(level)), n_blocks).cast("long"))
        out = written(spark, d.groupBy("number", "block").applyInPandas(_decide(most <= BLOCK), d.schema), f"mix-{level}")
        parts.append(out.where("p = 0 OR p = 1").drop("n"))
        if most <= BLOCK:
            break
        d, most, level = out.where("p > 0 AND p < 1").withColumn("n", 2 * F.ceil(F.col("n") / BLOCK)), 2 * -(-most // BLOCK), level + 1
    all_ = parts[0]
    for x in parts[1:]:
        all_ = all_.unionByName(x)
    copies = (F.col("whole") + F.col("p")).cast("int")
    return all_.select("doc_id", "source", "mark", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (dropped if it doesn't).

    A document is known by id, source and a hash of its text; repeated rows are told apart by number."""
    key = doc_key(docs, text) | {"_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "_no_source": F.col("source").isNull()}
    chosen = mix(docs, text)
    chosen = chosen.select(F.col("mark").alias("_mark"), *[v.alias(k) for k, v in key.items() if k != "_mark"], "copies")
    chosen = chosen.groupBy(*key).agg(F.sort_array(F.collect_list("copies")).alias("_copies"))
    chosen = written(docs.sparkSession, chosen, "mix-copies")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in key.items()]).join(chosen, list(key))
    # the shuffle of the join serves the window too
    n = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("row")))
    d = d.withColumn("_n", n).withColumn("_copies", F.get("_copies", F.col("_n") - 1)).where(F.col("_copies") > 0)
    return d.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
