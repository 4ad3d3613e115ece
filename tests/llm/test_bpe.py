import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faceoff.llm import bpe, registry, tokencount
from tests.llm.cases import ODD_TEXTS, docs, written

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def test_ids_and_text_equal_the_library(spark, tmp_path):
    lib = Tokenizer.from_file(WORD)
    rows = list(enumerate(ODD_TEXTS)) + [(3, ODD_TEXTS[5])]
    got = registry.op3_bpe(spark, written(docs(spark, rows), tmp_path)).collect()
    assert len(got) == len(rows)
    want = set()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert {tuple(r) for r in got} == want


def test_every_kind_of_character(spark):
    coder = bpe.WordCoder(open(WORD, encoding="utf-8").read())
    lib = Tokenizer.from_file(WORD)
    texts = [f"a{chr(c)}b1 {chr(c)}'s" for c in range(0, 0x30000, 37) if not 0xD800 <= c < 0xE000]
    got = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
    assert got == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_empty_table_clashing_columns_and_bad_ids(spark):
    df = docs(spark, [(1, "ab cd")]).withColumnRenamed("lang", "ids").withColumnRenamed("source", "DECODED")
    out = bpe.encode_decode(df, WORD)
    assert out.count() == 1 and out.columns == ["doc_id", "text", "n_chars", "ids", "n_tokens", "decoded"]
    assert bpe.encode_decode(df.limit(0), WORD).count() == 0
    raw = spark.createDataFrame([(b"\xff\xff\xff\xff",), (None,)], "ids binary")
    assert [r.decoded for r in bpe.decode(raw, WORD).collect()] == ["", ""]


def test_counts_equal_the_library(spark, tmp_path):
    lib = Tokenizer.from_file(BYTE)
    rows = list(enumerate(ODD_TEXTS)) + [(3, ODD_TEXTS[5])]
    got = registry.op8_token_counts(spark, written(docs(spark, rows), tmp_path)).collect()
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert sorted(map(tuple, got)) == sorted((i, len((t or "").encode()), k, k > 1024) for (i, t), k in zip(rows, n))


def test_every_prefix_and_truncation(spark):
    lib = Tokenizer.from_file(BYTE)
    table = tokencount.PrefixTable(open(BYTE, encoding="utf-8").read())
    for t in ODD_TEXTS:
        t = (t or "")[:300]
        want = [len(e.ids) for e in lib.encode_batch([t[:k] for k in range(len(t) + 1)], add_special_tokens=False)]
        assert table.prefixes(t) == want, t
    text = "Some words that we've cut, again and again\n\n  here"
    df = tokencount.prefix_counts(docs(spark, [(1, text), (2, None)]), BYTE)
    for budget in (-1, 0, 1, 5, 1000):
        r = {x.doc_id: x for x in tokencount.truncate(df, budget).collect()}
        fit = [k for k in range(len(text) + 1) if len(lib.encode(text[:k], add_special_tokens=False).ids) <= budget]
        assert r[1].fit_text == text[: max(fit, default=0)] and r[2].fit_chars == 0


def test_long_texts_are_cut_without_effect(spark, monkeypatch):
    from faceoff.llm import vocab
    text = "some words, and  more\n of them " * 400 + "中" * 50
    coder, table = bpe.WordCoder(open(WORD, encoding="utf-8").read()), tokencount.PrefixTable(open(BYTE, encoding="utf-8").read())
    ids, n = coder.encode([text]), table.count([text])
    monkeypatch.setattr(vocab, "PIECE", 100)
    assert coder.encode([text]) == ids and table.count([text])[0] == n[0]


def test_only_plain_bpe():
    with pytest.raises(ValueError):
        bpe.WordCoder('{"model": {"type": "Unigram"}}')
