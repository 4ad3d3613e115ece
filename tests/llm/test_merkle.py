import hashlib
import random
import zlib

import duckdb
import pytest

from faceoff.llm import merkle, oracle, registry
from tests.llm.cases import ODD_TEXTS, docs, written


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(nodes):
    """(root, for each node the list of (left, right) on its path)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, j in enumerate(at):
            start = j // 8 * 8
            paths[k].append(("".join(nodes[start:j]), "".join(nodes[j + 1:start + 8])))
            at[k] = j // 8
        nodes = [h(*nodes[s:s + 8]) for s in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_lang = {}
    for doc_id, text, lang, source, n in rows:
        leaf = h(framed(doc_id, source, lang, n, text))
        bad = None
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            lowered = text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            bad = h(framed(doc_id, source, lang, n, lowered))
        by_lang.setdefault(lang, []).append(((doc_id is not None, doc_id, leaf), doc_id, leaf, bad))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0][0], x[0][1] or 0, x[0][2]))
        trees[lang] = climb([x[2] for x in by_lang[lang]])
    root, tops = climb([trees[x][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        subroot, paths = trees[lang]
        for (_, doc_id, leaf, bad), path in zip(by_lang[lang], paths):
            whole = path + tops[k]
            acc = bad or leaf
            for left, right in whole:
                acc = h(left, acc, right)
            out.append((doc_id, leaf, subroot, root, h(*[x + y for x, y in whole]), acc, acc == root))
    return sorted(out, key=str)


def got(spark, folder):
    rows = registry.op11_merkle(spark, folder).collect()
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows], key=str)


def rows_of(n, seed=1):
    r = random.Random(seed)
    langs = ["en", "en", "en", "de", None, "", "é", "z"]
    return [(i, f"Text {r.randrange(9)} Number", r.choice(langs), r.choice(["a", None]), r.choice([None, 5])) for i in range(n)]


def same_in_sql(rows, expected):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert sorted(con.execute(oracle.ORACLES["op11_merkle"]).fetchall(), key=str) == expected


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("levels", [1, 3])
def test_equals_brute_force_and_sql(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3 * levels)
    rows = rows_of(700) + [(None, "x", "en", "a", 1), (None, None, None, None, None), (5, "again", "en", "a", 1)]
    rows += [(9, "Same Row", "en", "a", 1)] * 20 + [(10_000 + i, t, "odd", None, 3) for i, t in enumerate(ODD_TEXTS)] + [(99, "Lone", "lone", "a", 4)]
    d = written(spark.createDataFrame(rows, SCHEMA).repartition(5), tmp_path)
    expected = brute(rows)
    assert got(spark, d) == expected
    same_in_sql(rows, expected)
    assert {r[-1] for r in expected} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_sizes_of_one_group(spark, tmp_path, n):
    rows = [(i, f"T{i}", "en", "s", i) for i in range(n)]
    d = written(spark.createDataFrame(rows, SCHEMA), tmp_path)
    assert got(spark, d) == (brute(rows) if n else [])


def test_many_groups_are_a_tree_too(spark, tmp_path):
    rows = [(i, f"T{i}", f"lang{i % 75}", "s", i) for i in range(150)]
    assert got(spark, written(spark.createDataFrame(rows, SCHEMA), tmp_path)) == brute(rows)


def test_tampering_of_any_column_is_seen_and_columns_pass_through(spark):
    d = docs(spark, [(i, f"text {i}") for i in range(30)]).withColumnsRenamed({"lang": "Path", "source": "_v0"})
    leaves = d.withColumn("leaf", merkle.leaf_of(*[d[c] for c in ("doc_id", "text", "n_chars")])).withColumnRenamed("n_chars", "lang")
    out = merkle.manifest(leaves, "lang", "doc_id")
    assert out.columns == ["doc_id", "text", "lang", "leaf", "subroot", "root", "path"]
    changed = out.withColumn("bad", merkle.leaf_of(out.doc_id, out.text, out.lang + 1))
    r = changed.select(merkle.folded(out.leaf, out.path).alias("own"), merkle.folded(changed.bad, out.path).alias("other"), "root").collect()
    assert all(x.own == x.root != x.other for x in r) and len(r) == 30
