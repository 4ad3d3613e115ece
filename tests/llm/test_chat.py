import hashlib

import duckdb
import pytest

from faceoff.llm import chat, oracle, registry

LOG = "conv_id long, turn long, seq long, kind string, role string, text string"
TRICKY = [r"\### Assistant: </turn> ok", r"\h\t\b\c", "####", "######</turn></turn>", "\\", "", None, ": x: ", "### a: b</turn>\n### c: d", "é\U0001f600"]


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 0, 0, "delta", "user", "Hel"), (1, 0, 1, "delta", None, "lo"),
           (1, 1, 2, "delta", "assistant", "bad"), (1, 1, 3, "regenerate", "assistant", None),
           (1, 1, 4, "delta", "assistant", "good "), (1, 1, 5, "delta", "assistant", "answer"),
           (1, 2, 6, "delta", "user", "x"), (1, 2, 7, "edit", "user", "y"), (1, 2, 8, "delta", "user", "z"),
           (2, 0, 5, "delta", "user", "later"), (2, 0, 1, "edit", "user", "first "), (2, 0, 1, "edit", "user", "again "),
           (None, None, None, None, None, None)]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat.fold(spark.createDataFrame(log[::-1], LOG)).collect()}
    assert got == {(1, 0): ("user", "Hello"), (1, 1): ("assistant", "good answer"), (1, 2): ("user", "yz"),
                   (2, 0): ("user", "first later"), (None, None): ("", "")}


def test_round_trip_and_mask(spark):
    roles = ["user", "assistant", "a:b\\c", "", "assistant"] * 2
    log = [(7, k, k, "delta", r, t) for k, (r, t) in enumerate(zip(roles, TRICKY))]
    r = chat.read_back(chat.format_chats(spark.createDataFrame(log, LOG))).collect()[0]
    assert [(m.role, m.text) for m in r.messages] == [(a, b or "") for a, b in zip(roles, TRICKY)]
    assert list(r.loss_texts) == [b or "" for a, b in zip(roles, TRICKY) if a == "assistant"]
    for s, t in zip(r.loss_spans, r.loss_texts):
        inside = r.formatted[s.start: s.start + s.length]
        assert inside.replace("\\t", "</turn>").replace("\\h", "###").replace("\\b", "\\") == t
    assert r.formatted.count("</turn>\n") == r.n_turns == len(log)


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "ab"), (2, 0, None, ""), (None, None, "assistant", "q")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "y") \
        .selectExpr("*", "text as formatted", "1 as seq").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in registry.op1_chat_format(spark, str(tmp_path)).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == h("user\n\nassistant\nab\n") and got[1].loss_chars == 2 and got[1].loss_sha256 == h("ab")
    t = r"\### Assistant: </turn> ok"
    assert got[-7].n_turns == 2 and got[-7].turns_sha256 == h(f"user\n{t}\nassistant\n{t}\n") and got[-7].loss_sha256 == h(t)
    assert got[2].turns_sha256 == h("\n\n") and got[2].loss_chars == 0 and got[None].loss_sha256 == h("q")
    assert len(got) == 4


def test_rows_of_an_equal_turn_are_messages_of_their_own(spark, tmp_path):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, "z"), (1, 1, "assistant", None), (1, 1, "assistant", "q"),
            (1, None, "user", "first"), (None, 0, "assistant", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in registry.op1_chat_format(spark, str(tmp_path)).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 7 and got[1].loss_sha256 == h("q")
    assert got[1].turns_sha256 == h("user\nfirst\n\nz\nuser\na\nuser\na\nuser\nb\nassistant\n\nassistant\nq\n")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    sql = {r[0]: r for r in con.execute(oracle.ORACLES["op1_chat_format"]).fetchall()}
    assert {k: tuple(r) for k, r in got.items()} == sql


def test_a_very_long_conversation(spark):
    log = [(1, k // 3, k, "delta", "assistant" if k // 3 % 2 else "user", f"{k} ### " * 20) for k in range(3000)]
    r = chat.read_back(chat.format_chats(spark.createDataFrame(log, LOG).repartition(4))).collect()[0]
    assert r.n_turns == 1000 and [m.text for m in r.messages] == ["".join(t for *_, t in log[i:i + 3]) for i in range(0, 3000, 3)]


@pytest.mark.parametrize("n", [0])
def test_empty(spark, tmp_path, n):
    df = spark.createDataFrame([], LOG)
    assert chat.read_back(chat.format_chats(df)).count() == n
