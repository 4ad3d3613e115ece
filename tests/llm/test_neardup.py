import random
import re

from faceoff.llm import common, components, neardup, registry
from tests.llm.cases import ODD_TEXTS, docs, written


def sets(t, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size):
    s = [sets(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= 80 * (len(s[i]) + len(s[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(groups=8, per=14):
    r = random.Random(11)
    rows = []
    for g in range(groups):
        base = [f"w{r.randrange(4000)}" for _ in range(r.choice([12, 60, 300]))]
        for _ in range(per):
            t = list(base)
            for _ in range(r.randrange(0, max(2, len(base) // 25))):
                t[r.randrange(len(t))] = f"x{r.randrange(9999)}"
            rows.append(" ".join(t).upper() if r.random() < 0.1 else "  ".join(t))
    chain = [f"c{k}" for k in range(120)]
    for k in range(10):  # neighbours are alike, the ends are not
        rows.append(" ".join(chain[k * 4: k * 4 + 70]))
    rows += [*ODD_TEXTS, "A b", "a  B", "a b c", "", None]
    ids = r.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def test_query_equals_brute_force(spark, tmp_path):
    rows = corpus()
    got = registry.op2_minhash(spark, written(docs(spark, rows).repartition(5), tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4)


def test_block_against_block(spark, monkeypatch):
    """Without help from pivots: every link of a bucket is found between its blocks."""
    rows = corpus(5, 9)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(neardup, "MORE_PIVOTS", 0)
    monkeypatch.setattr(neardup, "PAIRS", 4)
    got = neardup.near_duplicates(docs(spark, rows).repartition(3), 4).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got)) == brute(rows, 4)


def test_candidates_are_the_unlike_components_of_the_first_shared_band():
    r = neardup.np.random.default_rng(5)
    base = r.integers(0, 1 << 32, neardup.HASHES, dtype=neardup.np.uint32)
    close, other = base.copy(), r.integers(0, 1 << 32, neardup.HASHES, dtype=neardup.np.uint32)
    close[::20] += 1  # bands 0, 5, 10, ... differ
    m = [{"node": bytes([k]), "comp": c, "signature": s.tobytes()} for k, (c, s) in enumerate([(b"a", base), (b"a", base), (b"b", close), (b"c", other)])]
    assert neardup.candidates(m[:2], m[2:], 1).tolist() == [[0, 0], [1, 0]]
    assert neardup.candidates(m[:2], m[2:], 2).tolist() == [] == neardup.candidates(m[:1], m[1:2], 0).tolist()
    assert neardup.candidates([], m, 0).tolist() == []


def test_long_texts_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PIECE", 2000)
    r = random.Random(9)
    long = " ".join(f"w{r.randrange(9000)}" for _ in range(4000))
    rows = [(1, long), (2, long + " end"), (3, "short one two three four")]
    null = [(None, f"null {k} " + " ".join(f"n{k}x{i}" for i in range(20))) for k in range(6)] + [(None, long.upper())]
    got = neardup.near_duplicates(docs(spark, rows + null), 4).collect()
    assert {r.component_id for r in got if r.n_shingles > 1000} == {1} and len(got) == 10
    assert len({r.component for r in got}) == 8


def test_nothing_is_left_behind_in_a_scope(spark):
    import os
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with common.scope():
        assert neardup.keep_one(docs(spark, corpus(2, 5)), 4).count()
        big = [d for d in set(os.listdir(folder)) - before if "-sets-" in d or "signatures" in d]
        assert not big  # those go before the result is read
    assert set(os.listdir(folder)) == before


def test_edges(spark):
    df = docs(spark, [(5, "a b c"), (5, "a b c"), (3, "a b c"), (None, "a b c"), (None, "q"), (9, "")]).withColumnRenamed("lang", "node")
    assert sorted((str(r.doc_id), r.text) for r in neardup.keep_one(df, 5).collect()) == [("3", "a b c"), ("9", ""), ("None", "q")]
    got = neardup.near_duplicates(df, 5).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got if r.n_shingles and r.component_id is not None) == \
        [("3", 3, True), ("5", 3, False), ("5", 3, False), ("None", 3, None)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 9] == [(9, True)]
    assert neardup.near_duplicates(df.limit(0), 5).count() == 0


def test_posterior_bounds():
    assert neardup.NEEDED == sorted(neardup.NEEDED) and neardup.NEEDED[-1] < 0.8 * neardup.HASHES
    r = neardup.np.random.default_rng(1)
    a = r.integers(0, 1 << 32, (20000, neardup.HASHES), dtype=neardup.np.uint32)
    b = neardup.np.where(r.random(a.shape) < 0.8, a, a + 1)
    assert neardup.may_be_similar(a, b).all()
    c = neardup.np.where(r.random(a.shape) < 0.4, a, a + 1)
    assert neardup.may_be_similar(a, c).mean() < 0.01


def test_components(spark):
    r = random.Random(4)
    edges = [(f"{k:04d}", f"{k + 1:04d}") for k in range(0, 60)] + [(f"{r.randrange(100, 400):04d}", f"{r.randrange(100, 400):04d}") for _ in range(150)]
    got = {x.node: x.comp for x in components.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    up = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(up[a], up[b])
            changed |= up[a] != m or up[b] != m
            up[a] = up[b] = m
    assert got == {n: c for n, c in up.items() if any(n in e and e[0] != e[1] for e in edges)}
