import random
import zlib

from pyspark.sql import functions as F

from faceoff.llm import registry, toxicity
from tests.llm.cases import ODD_TEXTS, docs, written

MEAN = ["blorf", "grunk", "snarp"]


def corpus(n=1200):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        words = [f"word{r.randrange(300)}" .replace("0", "a").replace("1", "b") for _ in range(r.randrange(5, 60))]
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        bad = r.random() < 0.15
        if bad:
            words.insert(r.randrange(len(words)), r.choice(MEAN).upper() + "!")
        rows.append((i, " ".join(words)))
        if r.random() < 0.6:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_folds(spark, tmp_path):
    rows, labels = corpus()
    d = written(docs(spark, rows), tmp_path)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in registry.op7_toxicity(spark, d).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    truth = {i: any(m.upper() in t for m in MEAN) for i, t in rows}
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.97


def test_held_out_labels_have_no_influence(spark):
    rows, labels = corpus(400)
    df = docs(spark, rows)
    flip = [(i, q, t if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - t) for i, q, t in labels]
    a, b = (toxicity.fit(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flip))
    assert a.words == b.words and a.bias == b.bias and (a.weights == b.weights).all()


def test_edges(spark):
    df = docs(spark, [*enumerate(ODD_TEXTS), (None, "blorf"), (1, "blorf")]).withColumnRenamed("lang", "score").withColumnRenamed("source", "_toxic")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, none)
    out = toxicity.score(df, model).collect()
    assert len({r.score for r in out}) == 1 and len(out) == len(ODD_TEXTS) + 2
    assert toxicity.score(df.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (0, None)], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit(df, odd)).where(F.col("score").isNull()).count() == 0


def test_model_counts_a_word_once_in_long_texts():
    m = toxicity.Model(["aa", "bb"], toxicity.np.array([2.0, -1.0]), 0.5)
    s = m.scores(["aa " * 1000 + "BB", "", None, "aaa"])
    logit = lambda x: 1 / (1 + toxicity.np.exp(-x))
    assert abs(s[0] - logit(1.5)) < 1e-9 and s[1] == s[2] == s[3] == logit(0.5)
