"""Quality of documents by weak supervision.

Method: every rule votes good or bad for a document or abstains. How reliable each rule
is isn't set but estimated: expectation-maximisation over the counts of vote patterns fits
for good and for bad documents how often each rule votes which way. A document's
probability of being good follows from its votes, and replaces the filter that every
rule must pass.

Only DataFrame functions are used: texts are read in place (once if they are not wanted back), and the only shuffle is
the count of vote patterns (at most 3 to the number of rules, so small enough for the
driver, where the estimation runs). Hot sources or copies change counts, not the work of
a task.

Cases: null or blank texts have no words and fail the base rules, whatever the votes; an
empty table gives an empty table; repeated rows are judged alike; columns named like a
result column are replaced. Without any document the prior reliabilities hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import WORD_SEPARATORS, settled, text_of, without, written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
WINDOW = 5
#: Documents are kept from this probability of being good on.
KEEP_FROM = 0.5
#: Prior share of good documents, and how much the priors weigh against the documents.
PRIOR_GOOD, PRIOR_SHARE = 0.9, 0.1
ROUNDS, CLOSE = 200, 1e-9


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts of each text (see ``BASE``) and, in ``_more``, further
    counts that rules vote on."""
    t, n = F.col("_t"), F.col("n_words")
    d = without(docs, *BASE, "_t", "_w", "_lines", "_h", "_s", "_pos", "_more").withColumn("_t", text_of(docs, text))
    d = d.withColumn("_w", F.split(F.btrim(t, F.lit(BLANKS)), WORD_SEPARATORS))
    d = d.withColumn("n_words", F.when(F.get("_w", F.lit(0)) == "", 0).otherwise(F.size("_w")).cast("long"))
    d = d.withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    hashed = F.transform(F.sequence(F.lit(0), (n - WINDOW).cast("int")),
                         lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(WINDOW)]))
    d = d.withColumn("_h", F.when(n >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    # most texts repeat no window; only the others sort theirs
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_s", F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("_pos", _repeated_positions())
    covered = F.aggregate(F.transform("_pos", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_pos"), k + 1) - p, F.lit(WINDOW)))),
                          F.lit(0), lambda a, x: a + x)
    lines = F.size("_lines")
    more = F.struct(
        lines.cast("long").alias("n_lines"),
        F.length(F.regexp_replace(t, "[^0-9]+", "")).cast("long").alias("n_digits"),
        F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]+")).cast("long").alias("n_symbol_words"),
        F.size(F.filter("_lines", lambda x: F.btrim(x, F.lit(BLANKS)).rlike("[.!?]$"))).cast("long").alias("n_ended_lines"))
    d = (d.withColumn("word_chars", F.when(n == 0, 0).otherwise(F.length(F.regexp_replace(t, WORD_SEPARATORS, ""))).cast("long"))
         .withColumn("n_symbols", F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"))
         .withColumn("n_dup_lines", (lines - F.size(F.array_distinct("_lines"))).cast("long"))
         .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
         .withColumn("_more", more))
    failed = (n < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n)
    d = d.withColumn("base_failed", failed).drop("_t", "_w", "_lines", "_h", "_s", "_pos")
    return settled(d, *BASE, "_more")


def _repeated_positions() -> Column:
    """Numbers of the windows whose hash is found twice or more, ascending."""
    s = F.col("_s")
    like = lambda x, other: F.coalesce(x["h"] == other, F.lit(False))
    same = F.filter(s, lambda x, i: like(x, F.get(s, i + 1)["h"]) | like(x, F.when(i > 0, F.get(s, i - 1)["h"])))
    return F.sort_array(F.transform(same, lambda x: x["i"]))


#: How likely a vote is before any document is seen, for a good and for a bad document.
TELLING = {-1: (0.01, 0.8), 0: (0.04, 0.1), 1: (0.95, 0.1)}
SUSPICION = {-1: (0.02, 0.3), 0: (0.98, 0.7)}
SUPPORT = {0: (0.2, 0.5), 1: (0.8, 0.5)}


def rules() -> dict[str, tuple[Column, dict[int, tuple[float, float]]]]:
    """The rules, over the columns of ``measure``: name, vote (1 good, -1 bad, 0 abstains)
    and the prior of its reliability."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("_more.n_lines"), F.lit(1))
    mean, symbols = F.col("word_chars") / n, F.col("n_symbols") / n
    bad_if = lambda condition: F.when(condition, -1).otherwise(0)
    return {
        "symbols": (F.when(symbols <= 0.02, 1).when(symbols >= 0.1, -1).otherwise(0), TELLING),
        "symbol_share": (F.when(F.col("n_symbols") / chars <= 0.005, 1).when(F.col("n_symbols") / chars >= 0.02, -1).otherwise(0), TELLING),
        "symbol_words": (F.when(F.col("_more.n_symbol_words") / n <= 0.02, 1)
                         .when(F.col("_more.n_symbol_words") / n >= 0.05, -1).otherwise(0), TELLING),
        "length": (F.when(n >= 50, 1).otherwise(0), SUPPORT),
        "repeated_lines": (bad_if(F.col("n_dup_lines") / lines >= 0.5), SUSPICION),
        "repeated_words": (bad_if(F.col("n_repeat_words") / n >= 0.15), SUSPICION),
        "word_length": (bad_if((mean < 2.5) | (mean > 12.0)), SUSPICION),
        "digits": (bad_if(F.col("_more.n_digits") / chars >= 0.3), SUSPICION),
        "capitals": (bad_if(F.col("_more.n_upper") / chars >= 0.5), SUSPICION),
        "line_ends": (bad_if((F.col("_more.n_lines") >= 3) & (F.col("_more.n_ended_lines") / lines <= 0.2)), SUSPICION),
    }


def votes(measured: DataFrame) -> DataFrame:
    """``measured`` with ``votes`` (array of -1, 0, 1 in the order of ``rules``)."""
    return settled(without(measured, "votes").withColumn("votes", F.array(*[v.cast("int") for v, _ in rules().values()])), "votes")


def estimate(patterns: list[tuple[tuple[int, ...], int]], start: list[dict[int, tuple[float, float]]]) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over (votes, number of documents) from the priors ``start``.

    Returns the share of good documents and for every rule and vote how likely the vote
    is (for a good document, for a bad one). Abstaining counts too: rules may abstain
    more often for one kind. The priors weigh as much as ``PRIOR_SHARE`` of the documents
    (and one document), at every size; they keep "good" the side that good votes speak for.
    """
    prior, table = PRIOR_GOOD, [dict(t) for t in start]
    total, before = sum(c for _, c in patterns), None
    belief = 1 + PRIOR_SHARE * total
    for _ in range(ROUNDS if total else 0):
        good_docs, loss = 0.0, 0.0
        sums = [{v: [belief * PRIOR_GOOD * g, belief * (1 - PRIOR_GOOD) * b] for v, (g, b) in t.items()} for t in start]
        for pattern, c in patterns:
            g = math.log(prior) + sum(math.log(table[r][v][0]) for r, v in enumerate(pattern))
            b = math.log(1 - prior) + sum(math.log(table[r][v][1]) for r, v in enumerate(pattern))
            top = max(g, b)
            norm = top + math.log(math.exp(g - top) + math.exp(b - top))
            p = math.exp(g - norm)
            good_docs, loss = good_docs + c * p, loss - c * norm
            for r, v in enumerate(pattern):
                sums[r][v][0] += c * p
                sums[r][v][1] += c * (1 - p)
        prior = (good_docs + belief * PRIOR_GOOD) / (total + belief)
        for r in range(len(start)):
            size = [sum(x[k] for x in sums[r].values()) for k in (0, 1)]
            table[r] = {v: (x[0] / size[0], x[1] / size[1]) for v, x in sums[r].items()}
        if before is not None and abs(before - loss) <= CLOSE * total:
            break
        before = loss
    return prior, table


def learn(voted: DataFrame) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """The estimate from all documents that pass the base rules."""
    counts = voted.groupBy("votes", "base_failed").count().collect()  # at most 2 * 3 ** len(rules()) rows
    return estimate(sorted((tuple(r["votes"]), r["count"]) for r in counts if not r["base_failed"]), [prior for _, prior in rules().values()])


def probability(prior: float, table: list[dict[int, tuple[float, float]]]) -> Column:
    """Posterior probability that a document is good, from its column ``votes``."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for r, by_vote in enumerate(table):
        vote = F.get("votes", F.lit(r))
        weight = F.lit(0.0)
        for v, (g, b) in by_vote.items():
            weight = F.when(vote == v, math.log(g / b)).otherwise(weight)
        odds = odds + weight
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, text: str = "text", lean: bool = False) -> DataFrame:
    """``docs`` with the base counts, ``votes``, ``quality`` (probability of being good)
    and ``kept`` (boolean). ``lean``: without the text, whose counts and votes are then written
    once and serve both the estimate and the answer."""
    voted = votes(measure(without(docs, "quality", "kept"), text))
    if lean:
        voted = written(docs.sparkSession, voted.drop(text), "votes")
    out = voted.withColumn("quality", probability(*learn(voted))).drop("_more")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
