import random

import pytest

from faceoff.llm import mixing, registry
from tests.llm.cases import docs, written


def table(spark, n=3000, blocks=7):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.choice([0, 1, 5, 40, 300])), "en", r.choice(["a", "a", "a", "b", "c", "Z", None])) for i in range(n)]
    return docs(spark, rows).repartition(blocks), rows


def test_targets():
    got = mixing.targets([("b", 10), ("a", 1000), (None, 100)])
    assert got["b"] == 30.0
    assert sum(got.values()) == pytest.approx(1110) and got[None] == 300.0 and got["a"] == pytest.approx(780)
    assert mixing.targets([]) == {}
    assert mixing.targets([("a", 0), ("b", 0)]) == {"a": 0.0, "b": 0.0}


def test_flight_keeps_both_sums_and_expectation():
    r = random.Random(1)
    size = [r.randrange(1, 500) for _ in range(400)]
    p = [0.37] * 400
    open_ = mixing.flight(p, size, r)
    assert len(open_) <= 2 and all(0 <= x <= 1 for x in p)
    assert sum(p) == pytest.approx(148, abs=1e-6) and sum(a * b for a, b in zip(p, size)) == pytest.approx(0.37 * sum(size), abs=1e-3)
    mean = [0.0] * 12
    for k in range(3000):
        q, s = [0.3] * 12, [5, 9, 2, 2, 7, 30, 1, 0, 0, 4, 4, 8]
        open_ = mixing.flight(q, s, random.Random(k))
        mean = [a + b / 3000 for a, b in zip(mean, q)]
        mixing.landing(q, s, open_)
        assert set(q) <= {0.0, 1.0}
    assert all(abs(m - 0.3) < 0.04 for m in mean)


def test_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)  # several levels
    df, rows = table(spark)
    d = written(df, tmp_path)
    got = registry.op10_mixing(spark, d).collect()
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in registry.op10_mixing(spark, d).collect())
    source = {i: s for i, _, _, s in rows}
    n = {i: len(t.split()) for i, t, _, _ in rows}
    total = {}
    for i in n:
        total[source[i]] = total.get(source[i], 0) + n[i]
    goal = mixing.targets(list(total.items()))
    taken = dict.fromkeys(total, 0)
    assert sorted(r.doc_id for r in got) == sorted(n)
    for r in got:
        s = source[r.doc_id]
        assert r.size == n[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(goal[s])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[s] += r.taken
    for s in total:
        assert abs(taken[s] - goal[s]) <= 300


def share_out(sizes):
    """The targets by the rule, in words: all sizes by weight 1, 2, 3, ...; whoever is above three times its size gives back, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    full = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = {s: 3 * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in order if x not in full) for s in order}
        over = {s for s in order if s not in full and share[s] > 3 * sizes[s]}
        if not over:
            return share
        full |= over


def test_words_taken_come_within_a_small_document_of_the_target(spark, tmp_path):
    r = random.Random(12)
    rows = [(i, " ".join(["w"] * (r.choice([3, 8, 20, 60]) if i % 9 else 2500)), "en", f"s{i % 6}") for i in range(600)]
    got = registry.op10_mixing(spark, written(docs(spark, rows).repartition(5), tmp_path)).collect()
    source = {i: s for i, _, _, s in rows}
    size, taken = {}, {}
    for r in got:
        size[source[r.doc_id]] = size.get(source[r.doc_id], 0) + r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    goal = share_out(size)
    for r in got:
        assert r.target == pytest.approx(goal[source[r.doc_id]])
    assert all(abs(taken[s] - goal[s]) <= 5 for s in goal)  # the smallest documents have 3 words, the largest 2500


def test_rows_of_the_mix_and_edges(spark, tmp_path):
    df, rows = table(spark, 400)
    df = df.union(df.where("doc_id < 20")).withColumnRenamed("lang", "copies")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    want = {}
    for r in mixing.mix(df).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert registry.op10_mixing(spark, written(docs(spark, []), tmp_path)).count() == 0
    assert mixing.mixed(docs(spark, [(1, None), (None, "")])).count() == 0
