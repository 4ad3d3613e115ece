import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from faceoff.llm import langid, registry
from tests.llm.cases import ODD_TEXTS, docs, written

SYLLABLES = {"aa": ["ba", "ko", "tu", "ri"], "bb": ["sch", "ein", "ung", "er"], "cc": ["ção", "que", "os", "ri"], "": ["ш", "ба", "ко", "и"]}


def corpus(n=400, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        lang = r.choice([*SYLLABLES, "aa", "aa"])
        words = ["".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(3, 60))]
        rows.append((i, " ".join(words) + r.choice(["", "!", " 123"]), lang))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def naive(text):
    """Counts by bucket, gram by gram."""
    squeezed = "".join(c if c.isalpha() else "\0" for c in f" {text.lower()} ")
    while "\0\0" in squeezed:
        squeezed = squeezed.replace("\0\0", "\0")
    out = {}
    for n in langid.SIZES:
        for s in range(len(squeezed) - n + 1):
            gram = squeezed[s:s + n]
            if gram == "\0":
                continue
            h = n
            for c in gram:
                h = (h * int(langid._STEP) + ord(c)) % 2**64
            b = h * int(langid._SPREAD) % 2**64 >> (64 - langid.BUCKET_BITS)
            out[b] = out.get(b, 0) + 1
    return out if any(c.isalpha() for c in text) else {}


def test_ngrams_equal_naive_counts_whatever_the_pieces(monkeypatch):
    texts = [t for t in ODD_TEXTS if t] + [t for _, t, _ in corpus(20)]
    for piece in (langid.PIECE, 1, 2, 3, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        for t in texts:
            if t.lower() != "".join(c.lower() for c in t):
                continue  # letters whose lower case depends on their neighbours
            b, c = langid.ngrams(t[:300])
            assert dict(zip(b.tolist(), c.tolist())) == naive(t[:300]), (piece, t)


def test_held_out_accuracy_and_folds(spark, tmp_path):
    rows = corpus()
    d = written(docs(spark, rows), tmp_path)
    got = {r.doc_id: r for r in registry.op12_langid(spark, d).collect()}
    assert len(got) == len(rows) and all(r.held_out == held(i) and 0 <= r.score <= 1 for i, r in got.items())
    for fold in (True, False):
        right = [got[i].lang_pred == lang for i, _, lang in rows if held(i) == fold]
        assert sum(right) / len(right) > 0.97
    assert 0.8 < sum(r.score for r in got.values()) / len(got) < 1


def test_held_out_rows_have_no_influence(spark, tmp_path):
    rows = corpus(150)
    other = [(i, "xyz " * 9, "zz") if held(i) else (i, t, lang) for i, t, lang in rows]
    fits = []
    for x in (rows, other):
        d = docs(spark, x)
        fits.append(langid.fit(d.where(~langid.held_out(F.col("doc_id")))))
    a, b = fits
    assert a.langs == b.langs and (a.idf == b.idf).all() and (a.weights == b.weights).all() and a.temperature == b.temperature


def test_how_rows_are_dealt_has_no_influence(spark):
    d = docs(spark, corpus(150))
    a, b = langid.fit(d.repartition(1)), langid.fit(d.repartition(7))
    assert (a.weights == b.weights).all() and (a.bias == b.bias).all() and (a.idf == b.idf).all()


def test_sample_is_bounded_shared_and_counts_copies_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "FIT_ROWS", 40)
    monkeypatch.setattr(langid, "FIT_LEAST", 10)
    rows = corpus(300) + [(7, "bako turi", "aa")] * 500
    train = docs(spark, rows).selectExpr("doc_id", "text AS _t", "lang AS _lang")
    sizes = {r["_lang"]: r["count"] for r in train.groupBy("_lang").count().collect()}
    got = langid.sample_counts(train, sizes)
    by = {k: [x for x in got if x[0] == k] for k in sizes}
    assert all(len(v) == 10 for v in by.values())
    same = {b.tobytes() + c.tobytes() for _, b, c in by["aa"]}
    assert len(same) == 10


def test_odd_tables(spark):
    odd = docs(spark, [*enumerate(ODD_TEXTS), (None, "bako"), (1, "")]).withColumnsRenamed({"source": "Lang_Pred", "n_chars": "_found"})
    for labelled in (odd.limit(0), odd.withColumn("lang", F.lit(None).cast("string"))):
        out = langid.predict(odd, langid.fit(labelled)).collect()
        assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)} and len(out) == len(ODD_TEXTS) + 2
    one = langid.predict(odd, langid.fit(odd)).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    for r in one:
        letters = any(c.isalpha() for c in r.text or "")
        assert r.lang_pred == ("en" if letters else "und") and r.score == float(letters)
    assert langid.predict(odd.limit(0), langid.fit(odd)).count() == 0
    twice = langid.predict(docs(spark, [(1, "bako ri"), (1, "bako ri")]), langid.fit(docs(spark, corpus(60)))).collect()
    assert twice[0] == twice[1]


def test_weights_are_sparse_and_the_penalty_makes_them_so(monkeypatch):
    r = np.random.default_rng(1)
    rows = []
    for k in range(200):
        c = k % 2
        b = np.unique(np.append(r.integers(10, 500, 8), c))
        rows.append((b, np.full(len(b), len(b) ** -0.5), c))
    w, _ = langid.follow_the_leader(rows, 2)
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 > w[1, 0]
    monkeypatch.setattr(langid, "L1", 0.3)
    strict, _ = langid.follow_the_leader(rows, 2)
    assert (strict != 0).sum() < (w != 0).sum() / 2 and strict[0, 0] > 0


def test_temperature_makes_scores_probabilities():
    r = np.random.default_rng(3)
    z = r.normal(size=(4000, 3))
    p = langid.softmax(z)
    classes = np.array([r.choice(3, p=x) for x in p])
    assert abs(langid.temperature(z * 5, classes) - 5) < 0.6
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0 == langid.temperature(np.ones((4, 1)), np.zeros(4, int))
