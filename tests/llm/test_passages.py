import hashlib
import random

import numpy as np

from faceoff.llm import passages, registry, suffixes
from tests.llm.cases import ODD_TEXTS, docs, written


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéü ") for _ in range(r.randrange(2, 9))) for _ in range(n))


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - 399):
            seen.setdefault(b[i:i + 400], []).append((d, i))
    cover = [bytearray(len(b)) for b in raw]
    for v in seen.values():
        if len(v) > 1:
            for d, i in v:
                cover[d][i:i + 400] = b"\1" * 400
    out = []
    for b, c in zip(raw, cover):
        spans = sum(1 for i, x in enumerate(c) if x and (i == 0 or not c[i - 1]))
        out.append((len(b), sum(c), spans, hashlib.sha256(bytes(x for x, y in zip(b, c) if not y)).hexdigest()))
    return out


def corpus():
    p = [words(150, 900 + k) for k in range(3)]
    out = [*ODD_TEXTS, p[0], p[0], "x" + p[0], p[1][:400], "ä" + p[1][:399] + "q", p[1][:399]]
    for k in range(25):
        a, b = words(60 + 5 * k, k), words(40, 500 + k)
        q = p[k % 3]
        out.append(a + q[k * 3:][: 300 + 20 * k] + b + (q[:450] if k % 4 == 0 else ""))
    out.append((words(20, 7) + "\n") * 30)
    out.append("ab" * 700)
    return out


def check(spark, path, texts):
    rows = list(enumerate(texts))
    got = registry.op6_suffix_dedup(spark, written(docs(spark, rows).repartition(6), path)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(i, *b) for i, b in enumerate(brute(texts))]


def test_query_equals_brute_force(spark, tmp_path):
    check(spark, tmp_path, corpus())


def test_crowded_anchors_go_by_strings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(passages, "CROWD", 2)
    check(spark, tmp_path, corpus())


def words_brute(texts, size):
    """Words left of each text, without those in a stretch of ``size`` words that starts anywhere else."""
    split = [t.split() for t in texts]
    seen = {}
    for d, ws in enumerate(split):
        for i in range(len(ws) - size + 1):
            seen.setdefault(tuple(ws[i:i + size]), []).append((d, i))
    gone = {(d, i + k) for v in seen.values() if len(v) > 1 for d, i in v for k in range(size)}
    return [[x for i, x in enumerate(ws) if (d, i) not in gone] for d, ws in enumerate(split)]


def test_passages_by_words_equal_brute_force(spark, monkeypatch):
    r = random.Random(11)
    p = [" ".join(r.choice("abcdefg") for _ in range(70)) for _ in range(3)]
    texts = []
    for k in range(30):
        ws = p[k % 3].split()
        own = [" ".join(f"{c}{k}x{i}" for i in range(20)) for c in "uv"]
        texts.append(f"{own[0]}\n {' '.join(ws[k % 7: k % 7 + 8 + k])}  {own[1]}")
    texts += ["", "a", "a b " * 40]
    want = words_brute(texts, 12)
    for crowd in (passages.CROWD, 2):
        monkeypatch.setattr(passages, "CROWD", crowd)
        got = passages.remove_repeats(docs(spark, list(enumerate(texts))).repartition(5), words=12).orderBy("doc_id").collect()
        assert [x.kept_text.split() for x in got] == want
    assert sum(len(t.split()) for t in texts) > sum(map(len, want)) > 0


def test_rows_columns_and_edges(spark):
    t = words(200, 3)
    df = docs(spark, [(1, t), (1, t), (None, words(100, 4)), (2, None)]).withColumnRenamed("lang", "SPANS").withColumnRenamed("source", "row")
    out = passages.remove_repeats(df)
    got = {(r.doc_id, r.n_bytes): r for r in out.collect()}
    assert out.count() == 4 and got[1, len(t.encode())].kept == b"" and got[2, 0].kept_text == "" and "row" in out.columns
    assert passages.remove_repeats(df.limit(0)).count() == 0


def test_suffix_arrays_of_any_alphabet():
    r = random.Random(2)
    for _ in range(400):
        n, k = r.randrange(45), r.choice([1, 2, 3, 6])
        t = np.array([r.randrange(k) for _ in range(n)], np.int64)
        want = sorted(range(n), key=lambda i: t[i:].tolist())
        for alphabet in (k, 5000):
            assert suffixes.suffix_array(t, alphabet).tolist() == want
        if n > 1:
            plcp = suffixes.common_prefixes(t, np.array(want), 7)
            for a, b in zip(want, want[1:]):
                same = 0
                while same < 7 and max(a, b) + same < n and t[a + same] == t[b + same]:
                    same += 1
                assert plcp[b] == same
