import hashlib
import random

from pyspark.sql import functions as F

from faceoff.llm import fingerprint, registry
from tests.llm.cases import ODD_TEXTS, docs, written


def words(n, seed, alphabet=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(alphabet)}" for _ in range(n)]


def shingles(t):
    w = t.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_query_equals_definition(spark, tmp_path):
    texts = [*ODD_TEXTS, *[" ".join(words(80 + 7 * k, k)) for k in range(30)]]
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    got = registry.op4_fingerprints(spark, written(docs(spark, rows).repartition(5), tmp_path)).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    texts = [t or "" for t in texts]
    prints = {}
    for k, (r, t) in enumerate(zip(got, texts)):
        nxt = texts[(k + 1) % len(texts)]
        e = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(t.split()) > 60 and len(set(t.split())) > 50:
            assert abs(r.near_edited - likeness(t, e)) < 0.2 and abs(r.near_next - likeness(t, nxt)) < 0.2
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and len(r.fingerprint) == 256
        if t == e:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint


def test_likeness_is_unbiased_for_short_and_long_texts(spark):
    pairs, want = [], []
    for n in (12, 40, 150, 800):
        for k in range(60):
            a = words(n, 1000 * n + k)
            cut = n // 3
            b = a[:-cut] + words(cut, 7 + 1000 * n + k)
            pairs.append((" ".join(a), " ".join(b), n))
    df = spark.createDataFrame(pairs, "a string, b string, n int").repartition(4)
    df = fingerprint.fingerprint(fingerprint.fingerprint(df, "a", "fa"), "b", "fb")
    got = df.select("a", "b", "n", fingerprint.likeness(F.col("fa"), F.col("fb")).alias("x")).collect()
    for n in (12, 40, 150, 800):
        errors = [r.x - likeness(r.a, r.b) for r in got if r.n == n]
        assert abs(sum(errors) / len(errors)) < 0.05, n


def test_edges(spark, tmp_path):
    one = registry.op4_fingerprints(spark, written(docs(spark, [(5, "ab cd")]), tmp_path / "a")).collect()
    assert one[0].near_next == 1.0
    assert registry.op4_fingerprints(spark, written(docs(spark, []), tmp_path / "b")).count() == 0
    rows = [(1, "x y"), (1, "a b"), (None, "n"), (1, "x y"), (2, None)]
    got = registry.op4_fingerprints(spark, written(docs(spark, rows), tmp_path / "c"))
    assert got.count() == 5
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    nulls = {r.doc_id: r for r in got.collect()}
    assert nulls[2].fingerprint == "0" * 256 and nulls[2].near_next == 0.0
