"""Language of texts from character n-grams.

Method: sparse multinomial logistic regression on TF-IDF weights of character n-grams. It is
trained with follow-the-regularised-leader: every weight has its own step size, the
absolute penalty keeps weights at exactly zero and the squared one keeps the others small. A
temperature, fitted on part of the sample that the weights have not seen, then makes the
scores probabilities.

Features: runs of letters in lower case, everything else one separator; n-grams of the
lengths ``SIZES`` fall by a hash into ``BUCKETS`` buckets. A bucket weighs 1 + log(count in the text)
times its inverse document frequency, and a text's weights have length one.

Plan: document frequencies come from all labelled training texts, whole, in Arrow batches:
a task returns at most a row a bucket, and sums a bucket reach the driver. The classifier
is fitted on a bounded sample, ``FIT_ROWS`` texts in all, shared among the languages, but at least ``FIT_LEAST``
of each (the lowest hashes of id and text; copies count once); what reaches the driver are its n-gram
counts. Prediction reads every text whole, in place, with nothing shuffled; the model is
at most ``BUCKETS`` rows of a weight a language. A very long text is counted piece by piece.

Cases: null texts and texts without letters are ``und`` with score 0, in training they are left out; a
null language is not learned from; without any labelled text all are ``und``; with one
language that has score 1; repeated rows get equal results; an empty table gives an empty
table; columns named like a result column are replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faceoff.llm.common import small_arrow_batches, text_of, without, written

SIZES, BUCKET_BITS = (1, 2, 3), 16
BUCKETS = 1 << BUCKET_BITS
FIT_ROWS, FIT_LEAST = 6000, 50
#: One in so many texts of the sample sets the temperature.
CALIBRATE = 5
EPOCHS, ALPHA, BETA, L1, L2 = 3, 1.0, 0.1, 0.002, 0.01
NONE = "und"
PIECE = 1 << 18
_STEP, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _buckets(seq: np.ndarray, first: int) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of ``seq`` that end at position ``first`` or later."""
    for n in SIZES:
        start = max(0, first - n + 1)
        m = len(seq) - n + 1 - start
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * _STEP + seq[start + k : start + k + m]
        if n == 1:
            h = h[seq[start:] > 0]  # a separator alone says nothing
        yield ((h * _SPREAD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of a whole text; empty without letters."""
    total, letters, any_letter = np.zeros(BUCKETS, np.int64), _letters(), False
    text = text or ""
    seq = np.zeros(1, np.uint64)
    for at in range(0, len(text), PIECE):
        cp = np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kept = letters[cp]
        any_letter = any_letter or bool(kept.any())
        new = np.where(kept, cp, 0).astype(np.uint64)
        new = new[(new > 0) | (np.append(seq[-1], new[:-1]) > 0)]  # one separator between runs
        last = at + PIECE >= len(text)
        if last and (new[-1] if len(new) else seq[-1]) > 0:
            new = np.append(new, np.uint64(0))
        before = seq[-(max(SIZES) - 1):]
        seq = np.append(before, new)
        for b in _buckets(seq, len(before)):
            total += np.bincount(b, minlength=BUCKETS)
    if not any_letter:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass(frozen=True)
class Model:
    langs: list[str]
    idf: np.ndarray  # a weight a bucket
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[buckets]
        return x / np.sqrt((x * x).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        buckets, counts = ngrams(text)
        if not len(buckets) or not self.langs:
            return NONE, 0.0
        p = softmax((self.vector(buckets, counts) @ self.weights[buckets] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from (buckets, vector, class), by the regularised leader of every coordinate.

    ``z`` sums the gradients, less what the moving weights stand for, and ``n`` their squares;
    the weight that is best for both and the penalties has a closed form.
    """
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    bz, bn = np.zeros(classes), np.zeros(classes)

    def leader(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for buckets, x, c in rows:
            zb, nb = z[buckets], n[buckets]
            w, b = leader(zb, nb, L1), leader(bz, bn, 0.0)
            error = softmax(x @ w + b)
            error[c] -= 1
            g = x[:, None] * error
            more = nb + g * g
            z[buckets] = zb + g - (np.sqrt(more) - np.sqrt(nb)) / ALPHA * w
            n[buckets] = more
            bmore = bn + error * error
            bz, bn = bz + error - (np.sqrt(bmore) - np.sqrt(bn)) / ALPHA * b, bmore
    return leader(z, n, L1), leader(bz, bn, 0.0)


def temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature that makes the classes likeliest (golden section on its logarithm; 1 without rows).

    As in Platt's scaling, one row in n + 2 is taken to be wrong, or rows that are all right would ask for scores of 1.
    """
    n, k = logits.shape
    if not n or k < 2:
        return 1.0
    wrong = 1 / (n + 2)
    target = np.full((n, k), wrong / (k - 1))
    target[np.arange(n), classes] = 1 - wrong

    def loss(t):
        z = logits / np.exp(t)
        top = z.max(axis=1, keepdims=True)
        return (np.log(np.exp(z - top).sum(axis=1, keepdims=True)) + top - z)[target > 0] @ target[target > 0]

    low, high, ratio = np.log(0.02), np.log(50.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """In how many texts (column ``_t``) each bucket is found."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total[ngrams(t)[0]] += 1
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def sample_counts(train: DataFrame, sizes: dict[str, int]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, counts) of the sample, in the order of the hash."""
    spark = train.sparkSession
    bound = max(FIT_LEAST, FIT_ROWS // len(sizes))
    place = F.pmod(F.col("_h"), F.lit(1 << 32))
    share = {k: min(1 << 32, int((1.5 * bound + 50) / n * (1 << 32))) for k, n in sizes.items()}
    limit = F.element_at(F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, v)]), F.col("_lang")).cast("long")
    near = train.withColumn("_h", F.xxhash64("doc_id", "_t")).where(place < limit)
    near = near.groupBy("_lang", "_h").agg(F.min("_t").alias("_t"))  # copies of a row count once
    lowest = Window.partitionBy("_lang").orderBy(place, "_h")
    near = near.withColumn("_k", F.row_number().over(lowest)).where(F.col("_k") <= bound).select("_lang", "_k", "_t")
    near = written(spark, near, "langid-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [ngrams(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([b.astype(np.int32).tobytes() for b, _ in got], pa.binary()),
                pa.array([c.astype(np.int32).tobytes() for _, c in got], pa.binary())], ["lang", "k", "buckets", "counts"])

    rows = near.mapInArrow(count, "lang string, k int, buckets binary, counts binary").collect()  # bounded by FIT_ROWS
    back = lambda b: np.frombuffer(bytes(b), np.int32).astype(np.int64)
    return [(r["lang"], back(r["buckets"]), back(r["counts"])) for r in sorted(rows, key=lambda r: (r["k"], r["lang"])) if r["buckets"]]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Train on the labelled rows of ``docs``."""
    small_arrow_batches(docs.sparkSession)
    t = docs[text].cast("string")
    train = docs.where(docs[lang].isNotNull() & t.rlike(r"\p{L}")).select("doc_id", t.alias("_t"), docs[lang].cast("string").alias("_lang"))
    sizes = {r["_lang"]: r["count"] for r in train.groupBy("_lang").count().collect()}  # a row a language
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    idf = np.log((1 + sum(sizes.values())) / (1 + document_frequencies(train.select("_t")))) + 1
    blank = Model(langs, idf, np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)), 1.0)
    rows = [(b, blank.vector(b, c), langs.index(name)) for name, b, c in sample_counts(train, sizes)]
    learn = [r for k, r in enumerate(rows) if k % CALIBRATE or len(rows) < CALIBRATE]
    check = [r for k, r in enumerate(rows) if k % CALIBRATE == 0]
    weights, bias = follow_the_leader(learn, len(langs))
    logits = np.array([x @ weights[b] + bias for b, x, _ in check]).reshape(len(check), len(langs))
    return Model(langs, idf, weights, bias, temperature(logits, np.array([c for *_, c in check], int)))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the probability of that language."""
    small_arrow_batches(docs.sparkSession)

    @F.arrow_udf("struct<lang:string,score:double>")
    def language(t: pa.Array) -> pa.Array:
        got = [model.predict(x) for x in t.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], ["lang", "score"])

    d = without(docs, "lang_pred", "score", "_found")
    columns = [F.col(f"`{c}`") for c in d.columns]
    # exploding an array of one keeps the optimizer from computing the structure once for each of its fields
    d = d.select(*columns, F.explode(F.array(language(text_of(d, text)))).alias("_found"))
    return d.select(*columns, F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))
