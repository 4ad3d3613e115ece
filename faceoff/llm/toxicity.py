"""Toxicity scores by positive-unlabelled learning.

Method: non-negative positive-unlabelled learning. A linear classifier is trained in numpy
from confirmed toxic texts and unlabelled ones. With the class prior q its risk is
q R+(positive) + max(0, R-(unlabelled) - q R-(positive)): the unlabelled texts stand for
all texts, and the part of their risk that positives explain is taken off, but never
below zero (a step that would go below zero goes back instead).

The features are words. Which words count is chosen on the same training texts: words that
are in many more of the confirmed texts than of the unlabelled ones, or the other way
round; the surest ones, at most one to four confirmed texts. Labels, language, source and id are never features.

Fitting uses a bounded sample: at most ``FIT_POSITIVE`` confirmed and ``FIT_UNLABELLED``
other ids, those with the lowest hash of the id, without exact copies of texts. Words are
counted and chosen by Spark; only the chosen words and which of them the sample's texts
hold reach the driver. Scoring reads every text whole, in Arrow batches, with
nothing shuffled; the model (at most ``MOST_WORDS`` words) is a literal of the job.

Cases: null text counts as empty and gets the score of a text without known words;
documents without a label are never confirmed; an id with contradicting labels is
confirmed if one says so; a null id is never labelled; without any confirmed text the
score is the class prior everywhere; repeated rows get equal scores; an empty table gives
an empty table; columns named like a result column are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faceoff.llm.common import small_arrow_batches, text_of, without, written
from faceoff.llm.vocab import distinct

FIT_POSITIVE, FIT_UNLABELLED, MOST_WORDS = 6000, 18000, 4000
#: Words need this many standard errors between the two kinds of texts, and this many texts.
SURE, LEAST_TEXTS = 4.5, 5
STEPS, RATE, SHRINK = 800, 0.05, 1e-5
PREDICT_FROM = 0.3
WORDS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class Model:
    words: list[str]
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of being toxic of whole texts."""
        out = np.full(len(texts), self.bias)
        known = pa.array(self.words, pa.large_string())
        held: list[str] = []
        docs: list[int] = []
        sizes: list[int] = []

        def add():
            if not held:
                return
            vocabulary, code = distinct(held)
            at = pc.index_in(vocabulary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
            word = at[code]
            doc = np.repeat(np.array(docs), np.array(sizes))
            pair = np.unique(doc[word >= 0].astype(np.int64) * len(self.words) + word[word >= 0])
            np.add.at(out, pair // max(1, len(self.words)), self.weights[pair % max(1, len(self.words))])

        count = 0
        for d, t in enumerate(texts):
            got = WORDS.findall((t or "").lower())
            held += got
            docs.append(d)
            sizes.append(len(got))
            count += len(got)
            if count > 1_000_000:
                add()
                held, docs, sizes, count = [], [], [], 0
        add()
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def train(patterns: list[tuple[bool, list[int], int]], words: list[str], prior: float) -> Model:
    """Fit on (confirmed or unlabelled, numbers of the words present, how many texts)."""
    prior = min(max(prior, 1e-4), 0.9)
    start = float(np.log(prior / (1 - prior)))
    n = np.array([c for _, _, c in patterns], np.float64)
    kind = np.array([k for k, _, _ in patterns], bool)
    if not words or not n[kind].sum() or not n[~kind].sum():
        return Model([], np.zeros(0), start)
    row = np.repeat(np.arange(len(patterns)), [len(x) for _, x, _ in patterns])
    col = np.array([i for _, x, _ in patterns for i in x], np.int64)
    p, u = np.where(kind, n, 0) / n[kind].sum(), np.where(kind, 0, n) / n[~kind].sum()
    w, b = np.zeros(len(words)), start
    m, v = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    negative = u - prior * p
    for step in range(1, STEPS + 1):
        z = b + np.bincount(row, w[col], len(patterns))
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))  # logistic loss: as positive -log s, as negative -log(1 - s)
        if (negative * np.logaddexp(0, z)).sum() >= 0:
            g = prior * p * (s - 1) + negative * s
        else:  # the risk of the negatives went below zero: step back
            g = -negative * s
        grad = np.append(np.bincount(col, g[row], len(words)) + SHRINK * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(words, w, float(b))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """Train on the texts of ``docs`` that are not held out; confirmed are those that ``labels.toxic`` marks 1."""
    spark = docs.sparkSession
    known = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    rate = known.agg(F.avg((F.col("_toxic") == 1).cast("double")).alias("q")).first()["q"] or 0.0
    ids = docs.where(~held_out(F.col("doc_id"))).select("doc_id").join(known, "doc_id", "left")
    ids = ids.select("doc_id", F.coalesce(F.col("_toxic") == 1, F.lit(False)).alias("_pos"), F.xxhash64("doc_id").alias("_rank")).distinct()
    lowest = lambda d, n: d.orderBy("_rank", "doc_id").limit(n)
    # the unlabelled sample stands for all texts, so confirmed ones are in it at their share
    chosen = lowest(ids.where("_pos"), FIT_POSITIVE).unionByName(lowest(ids, FIT_UNLABELLED).withColumn("_pos", F.lit(False)))
    chosen = written(spark, chosen.select(F.col("doc_id").alias("_id"), "_pos"), "chosen")
    sample = docs.select("doc_id", text_of(docs, text).alias("_t")).join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")))
    cut = F.array_distinct(F.regexp_extract_all(F.lower("_t"), F.lit(r"(\p{L}+)"), F.lit(1)))
    sample = sample.select("_pos", F.xxhash64("_t").alias("_copy"), cut.alias("w")).dropDuplicates(["_pos", "_copy"])
    sample = written(spark, sample, "sample")  # at most FIT_POSITIVE + FIT_UNLABELLED ids
    size = {r["_pos"]: r["count"] for r in sample.groupBy("_pos").count().collect()}
    n_pos, n_unl = size.get(True, 0), size.get(False, 0)
    if not n_pos or not n_unl:
        return train([], [], rate)
    each = sample.select("_pos", F.explode("w").alias("word")).groupBy("word").agg(
        F.sum(F.col("_pos").cast("long")).alias("p"), F.sum((~F.col("_pos")).cast("long")).alias("u"))
    share = (F.col("p") + F.col("u")) / (n_pos + n_unl)
    error = F.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_unl)) + 1e-12
    sure = F.abs(F.col("p") / n_pos - F.col("u") / n_unl) / error
    each = each.where(F.col("p") + F.col("u") >= LEAST_TEXTS).withColumn("sure", sure).where(F.col("sure") >= SURE)
    words = [r["word"] for r in each.orderBy(F.desc("sure"), "word").limit(min(MOST_WORDS, max(20, n_pos // 4))).select("word").collect()]
    present = F.sort_array(F.array_intersect("w", F.lit(words).cast("array<string>") if words else F.array().cast("array<string>")))
    number = {w: i for i, w in enumerate(words)}
    patterns = sample.select("_pos", present.alias("w")).groupBy("_pos", "w").count().collect()
    found = sorted((r["_pos"], [number[w] for w in r["w"]], r["count"]) for r in patterns)
    return train(found, words, rate)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``."""
    small_arrow_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def toxic_score(t: pa.Array) -> pa.Array:
        return pa.array(model.scores(t.to_pylist()), pa.float64())

    d = without(docs, "held_out", "score", "predicted")
    d = d.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("score", toxic_score(text_of(docs, text)))
    return d.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
