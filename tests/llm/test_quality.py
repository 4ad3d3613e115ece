import re

from faceoff.llm import quality, registry
from tests.llm.cases import ODD_TEXTS, docs, written


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i:i + 5]), []).append(i)
    hit = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), failed


GOOD = "This is a line of plain words that ends well.\nAnother line follows it and says a bit more.\n" * 1
JUNK = "### a$$$ b&&& c%%% ddd### eee$$$ word *** |x| <y> tail### more### even$$$ more&&&\n"


def test_base_counts_equal_brute_force(spark, tmp_path):
    texts = [*ODD_TEXTS, "a b c d e f a b c d e f a b c d e", "one two three four five " * 2 + "six", GOOD, JUNK, "a\nb\na\n\n \n \na ",
             " ".join(str(k % 7) for k in range(200)), " ".join(str(k) for k in range(50)) + " 0 1 2 3 4"]
    rows = list(enumerate(texts)) + [(0, None)]
    got = registry.op5_quality_rules(spark, written(docs(spark, rows), tmp_path)).collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted((i, *brute(t)) for i, t in rows)
    assert all(not r.kept for r in got if r.base_failed)


def test_a_very_long_text(spark, tmp_path):
    texts = [" ".join(f"w{k}" for k in range(60_000)) + "\n" + "$ " * 20_000, "\n".join(["same line of words here and so on"] * 9_000)]
    got = registry.op5_quality_rules(spark, written(docs(spark, list(enumerate(texts))), tmp_path)).collect()
    assert sorted(tuple(r)[:7] for r in got) == sorted((i, *brute(t)) for i, t in enumerate(texts))


def test_verdict_follows_the_votes(spark):
    long_good = [(i, " ".join(f"word{(i * 31 + k * k) % 977}x{k}" for k in range(60)) + ".") for i in range(60)]
    junk = [(100 + i, JUNK + " ".join(f"w{i}q{k}$$" for k in range(40))) for i in range(8)]
    out = quality.judge(docs(spark, long_good + junk).withColumnRenamed("lang", "kept").withColumnRenamed("source", "VOTES"))
    got = {r.doc_id: r.kept for r in out.collect()}
    assert all(got[i] for i, _ in long_good) and not any(got[i] for i, _ in junk)
    assert out.where("kept").count() == 60


def test_estimate_finds_planted_reliabilities():
    start = [quality.TELLING, quality.TELLING, quality.SUSPICION]
    patterns = [((1, 1, 0), 900), ((-1, -1, 0), 80), ((-1, -1, -1), 20), ((1, 1, -1), 5)]
    prior, table = quality.estimate(patterns, start)
    assert 0.85 < prior < 0.95 and table[0][-1][1] > 0.9 and table[0][-1][0] < 0.05
    assert quality.estimate([], start)[0] == quality.PRIOR_GOOD


def test_empty_and_no_python(spark):
    out = quality.judge(docs(spark, []))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
