import random

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from faceoff.llm import mixing
from tests.llm.cases import docs, written
from tests.llm.test_neardup import brute
from tests.llm.test_quality import JUNK


def corpus():
    r = random.Random(8)
    rows = []
    passage = " ".join(f"p{k * 7}q" for k in range(120))
    for i in range(150):
        t = " ".join(f"w{r.randrange(3000)}" for _ in range(r.randrange(30, 120))) + "."
        if i % 15 == 0:
            t += "\n" + passage
        rows.append((i, t, "en", f"src{i % 4}"))
    rows += [(200 + i, rows[i][1] + " more", "en", "src0") for i in range(20)]
    rows += [(300 + i, JUNK + " ".join(f"w{i}q{k}$$" for k in range(40)), "en", "src1") for i in range(12)]
    return rows + [(400, None), (401, "short one"), (402, "")]


def test_stages_and_run(spark, tmp_path):
    rows = corpus()
    df = docs(spark, rows).repartition(4)
    d = written(df, tmp_path)
    state, outs = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, state, d).write.parquet(f"{d}/out{k}")
        state = spark.read.parquet(f"{d}/out{k}")
        outs.append(state.collect())
        if k < 4:
            assert state.columns == df.columns
    quality, unique, cut, mix, coded = outs
    kept = {r.doc_id for r in quality}
    assert kept == {i for i, *_ in rows if i < 300}
    want = [i for i, _, _, first in brute([(r.doc_id, r.text) for r in quality], 5) if first]
    assert sorted(r.doc_id for r in unique) == want and not any(200 <= i < 300 for i in want)
    assert {r.doc_id for r in cut} == set(want) and all("p70q p77q" not in r.text and r.n_chars == len(r.text) for r in cut)
    taken = {}
    for r in mix:
        taken.setdefault(r.source, []).append(len(r.text.split()))
    size = {}
    for r in cut:
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
    goal = mixing.targets(list(size.items()))
    assert all(abs(sum(taken[s]) - goal[s]) <= 150 for s in goal)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert len(coded) == len(mix)
    for r in coded:
        ids = lib.encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == lib.decode(ids, skip_special_tokens=False)
    again = corpus_pipeline.run(spark, d).collect()
    assert sorted((r.doc_id, r.text) for r in again) == sorted((r.doc_id, r.text) for r in coded)


def test_passages_of_51_words_are_cut_and_of_50_stay(spark, tmp_path):
    r = random.Random(5)
    short = [" ".join(f"{c}{r.randrange(10)}" for _ in range(n)) for c, n in (("p", 51), ("q", 50))]
    assert all(len(p) < 160 for p in short)
    rows = []
    for i in range(40):
        own = [" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(40)) for _ in range(2)]
        rows.append((i, f"{own[0]} {short[i % 2] if i < 8 else 'none'} {own[1]}"))
    rows += [(50, rows[0][1].replace(" ", "\n", 60) + " end"), (51, None), (52, "")]
    out = {x.doc_id: x.text for x in corpus_pipeline.suffix_array_dedup(spark, docs(spark, rows).repartition(3), str(tmp_path)).collect()}
    assert len(out) == len(rows)
    for i, text in rows:
        if i in (2, 4, 6):
            assert out[i] == text.replace(short[0], "")
        elif i in (0, 50):  # all words of the one are in the other
            assert out[i].split() == (["end"] if i else [])
        else:
            assert out[i] == (text or "")


def test_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(docs(spark, []), tmp_path)).count() == 0
