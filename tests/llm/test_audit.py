import random
import re
from itertools import permutations

import duckdb

from faceoff.llm import audit, oracle, registry
from tests.llm.cases import ODD_TEXTS, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("part", "filter_order", "step", *audit.COUNTS)


def failing(doc_id, text, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = ""
    out += "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
    out += "D" if set(text) & set("#$%&*|") else ""
    copies = [d for d, t, *_ in rows if (t or "") == text and d is not None and doc_id is not None and d < doc_id]
    return out + ("E" if copies else "")


def brute(rows, labels):
    """Every order applied in turn, on the documents left."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = [(r[0], r[3] or "", failing(r[0], r[1] or "", rows)) for r in rows]
    out, removals = [], {}
    for part in {p for _, p, _ in docs}:
        mine = [d for d in docs if d[1] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[2]]
                left = [d for d in left if f not in d[2]]
                removals[part, f] = removals.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), sum(f in d[2] for d in mine) - len(gone),
                            sum(d[2] == f for d in mine), sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)])
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


def corpus():
    r = random.Random(3)
    rows = [(i, t, "en", r.choice(["a", "b"]), 0) for i, t in enumerate(ODD_TEXTS)]
    for i in range(20, 140):
        words = [f"w{r.randrange(r.choice([30, 4000]))}" for _ in range(r.choice([20, 49, 50, 51, 120]))]
        text = r.choice([" ", "\t", "\n\n"]).join(words)
        text = text.upper() if r.random() < 0.2 else text
        rows.append((i, text + r.choice(["", "", " #", "|"]), "en", r.choice(["a", "b", None, "", "é"]), 0))
    rows += [(200 + i, r.choice(rows)[1], None, r.choice(["a", "copies"]), 0) for i in range(60)]
    rows += [(None, rows[30][1], None, "a", 0), (30, rows[30][1], "en", "b", 0), (30, "another text", "en", "a", 0), rows[40], rows[40]]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 260, 2)] + [(20, 1, 0), (20, 0, 1), (None, 1, 1)]
    return rows, labels


def tables(spark, tmp_path, rows, labels):
    d = written(spark.createDataFrame(rows, SCHEMA).repartition(3), tmp_path)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_equals_every_order_applied_in_turn_and_sql(spark, tmp_path):
    rows, labels = corpus()
    got = registry.op13_filter_audit(spark, tables(spark, tmp_path, rows, labels))
    assert tuple(got.columns) == COLUMNS and dict(got.dtypes)["step"] == "int"
    expected = brute(rows, labels)
    assert sorted(tuple(r) for r in got.collect()) == expected
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    sql = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.ORACLES['op13_filter_audit']})").fetchall()
    assert sorted(sql) == expected
    assert all(any(r[k] for r in expected) for k in range(3, 10))  # every count is reached


def test_no_documents_and_no_labels(spark, tmp_path):
    d = tables(spark, tmp_path / "none", [], [])
    assert registry.op13_filter_audit(spark, d).count() == 0
    d = tables(spark, tmp_path / "one", [(1, None, None, None, None)], [])
    got = sorted(tuple(r) for r in registry.op13_filter_audit(spark, d).collect())
    assert got == brute([(1, None, None, None, None)], []) and len(got) == 600


def test_path_counts():
    edges = audit.paths_through()
    assert len(edges) == 80 and sum(w for *_, w in edges) == 5 * 120
    assert all(w == [24, 6, 4, 6, 24][s.bit_count()] for s, _, w in edges)


def test_extra_columns_are_not_looked_at(spark):
    rows, labels = corpus()
    d = spark.createDataFrame(rows, SCHEMA)
    odd = d.withColumnsRenamed({"lang": "fails", "n_chars": "part"})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS text", "2 AS source")
    a, b = (sorted(tuple(r) for r in audit.audit(audit.failures(x, marks)).collect()) for x in (d, odd))
    assert a == b
