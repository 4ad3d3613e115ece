import hashlib
import random
import re

from faceoff.llm import registry, warc

BARRED = set(warc.NOT_MERGED)


def value(headers, name):
    return next((h[1].strip() for h in headers or [] if h[0].lower() == name), None)


def brute(records):
    """records: (id, type, status, canonical, time, headers, body) -> id: (resolution, refers_to, headers, body)."""
    out = {}
    for i, kind, _, key, time, new, _ in records:
        if kind != "revisit":
            continue
        if key is None or time is None:
            out[i] = ("incomplete", None, None, None)
            continue
        before = [r for r in records if r[1] == "response" and r[2] == 200 and r[3] == key and r[4] is not None and r[4] < time]
        if not before:
            out[i] = ("no_earlier_response", None, None, None)
            continue
        of = max(before, key=lambda r: (r[4], r[0]))
        etag, day, old, old_day = (value(h, n) for h in (new, of[5]) for n in ("etag", "last-modified"))
        if etag is not None:
            fits = old is not None and (old.removeprefix("W/") == etag.removeprefix("W/") if etag.startswith("W/") else old == etag)
        else:
            fits = day == old_day if day is not None else old is None and old_day is None
        if not fits:
            out[i] = ("validator_mismatch", of[0], None, None)
            continue
        hop = {x.strip().lower() for h in new or [] if h[0].lower() == "connection" for x in h[1].split(",")}
        take = [tuple(h) for h in new or [] if h[0].lower() not in BARRED | hop]
        names = {h[0].lower() for h in take}
        out[i] = ("resolved", of[0], [tuple(h) for h in of[5] or [] if h[0].lower() not in names] + take, of[6])
    return out


def check(spark, rows, parts):
    df = spark.createDataFrame([(i, k, s, u, t, h, b) for i, k, s, u, t, h, b in rows], warc.RECORD).repartition(parts)
    got = warc.resolve(df).collect()
    want = brute([(i, k, s, u, t, h, b) for i, k, s, u, t, h, b in rows])
    assert len(got) == len(want)
    for r in got:
        headers = None if r.headers is None else [(h["name"], h["value"]) for h in r.headers]
        assert (r.resolution, r.refers_to, headers, r.body) == want[r.record_id], r
    return want


def corpus(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        url = "hot/a" if r.random() < 0.6 else r.choice(["b.org", "c.org/x?a=1", None])
        time = None if r.random() < 0.02 else r.randrange(n // 3)
        h = [("ETag", r.choice(['"1"', 'W/"1"', '"2"']))] if r.random() < 0.6 else []
        h += [("last-modified", r.choice(["m", "n"]))] if r.random() < 0.5 else []
        h += [("Set-Cookie", "a"), ("set-cookie", str(i)), ("Content-Length", str(i))] if r.random() < 0.5 else []
        if r.random() < 0.4:
            rows.append((i, "response", r.choice([200, 200, 200, 404]), url, time, h or None, f"body {i}"))
        else:
            h += [("Connection", "close, X-Hop"), ("x-hop", "1"), ("Date", str(i))]
            rows.append((i, "revisit", 304, url, time, h, None))
    return rows + [(n, "request", None, "hot/a", 1, None, None)]


def test_hot_url_equals_brute_force(spark):
    want = check(spark, corpus(600, 1), 5)
    assert {w[0] for w in want.values()} == {"resolved", "validator_mismatch", "no_earlier_response", "incomplete"}


def test_hot_url_is_split_into_ranges(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        check(spark, corpus(500, 2), 3)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_canonical_urls(spark):
    cases = {"HTTP://WWW.Ex.org:80/A/?b=2&utm_source=x&a=1#f": "ex.org/A?a=1&b=2", "https://ex.org:443/": "ex.org",
             "https://ex.org:80/?": "ex.org:80", "ex.org?sid=4": "ex.org", "http://m.ex.org/a//": "m.ex.org/a"}
    got = spark.createDataFrame([(u,) for u in cases], "u string").select("u", warc.canonical_url(warc.F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in got} == cases


def test_query_resolves_every_page(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, r.choice([f"http://ex.org/{i % 40}", f"https://www.ex.org/{i % 40}/?utm_source=q", None]), f"<p>{i % 7}</p>") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = {x.record_id: x for x in registry.op9_revisits(spark, str(tmp_path)).collect()}
    assert len(got) == 300
    short = lambda u: u and re.sub(r"/?(\?.*)?$", "", re.sub(r"^https?://(www\.)?", "", u))
    records = [(x.record_id, x.type, x.status, short(x.url), x.time, [tuple(h) for h in x.headers], x.body) for x in warc.standin_records(pages).collect()]
    want = brute(records)
    assert sum(w[0] == "resolved" for w in want.values()) > 30
    for i, (resolution, of, headers, body) in want.items():
        x = got[i]
        assert (x.resolution, x.refers_to) == (resolution, of)
        if resolution == "resolved":
            assert x.headers_sha256 == hashlib.sha256("\n".join(f"{a}: {b}" for a, b in headers).encode()).hexdigest()
            assert x.body_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_records_without_id_or_status(spark):
    tag = [("ETag", '"1"')]
    rows = [(None, "response", 200, "a", 3, tag, "no id"), (7, "response", 200, "a", 1, tag, "x"), (8, "response", None, "a", 2, tag, "no status"),
            (None, "revisit", None, "a", 9, tag, None), (None, "revisit", 304, "a", 9, tag, None), (9, "revisit", 304, "a", 1, tag, None)]
    got = warc.resolve(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert sorted(((r.record_id, r.resolution, r.body) for r in got), key=str) == [
        (9, "no_earlier_response", None), (None, "resolved", "x"), (None, "resolved", "x")]


def test_of_repeated_responses_the_first_counts(spark):
    tag = [("ETag", '"1"')]
    rows = [(1, "response", 200, "a", 5, tag, "later"), (1, "response", 200, "a", 2, tag, "first"), (1, "response", 200, "a", 2, tag, "first"),
            (1, "response", 200, "a", None, tag, "no time"), (2, "revisit", 304, "a", 4, tag, None), (2, "revisit", 304, "a", 4, tag, None),
            (3, "revisit", 304, "a", 9, tag, None), (4, "revisit", 304, "a", 2, tag, None)]
    df = spark.createDataFrame(rows, warc.RECORD).selectExpr("*", "'x' AS _id", "1 AS _copies", "2 AS kind", "3 AS canonical", "4 AS no_time")
    got = warc.resolve(df).collect()
    assert sorted((r.record_id, r.resolution, r.body) for r in got if r.body) == [(2, "resolved", "first")] * 2 + [(3, "resolved", "first")]
    assert [(r.record_id, r.resolution) for r in got if not r.body] == [(4, "no_earlier_response")]


def test_revisits_of_a_busy_response_are_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARE", 7)
    want = check(spark, corpus(500, 4), 4)
    of = [w[1] for w in want.values() if w[0] == "resolved"]
    assert max(map(of.count, of)) > 0
    tag = [("ETag", '"1"')]
    rows = [(0, "response", 200, "a", 0, tag, "b")] + [(i, "revisit", 304, "a", i, tag, None) for i in range(1, 90)]
    got = warc.resolve(spark.createDataFrame(rows, warc.RECORD)).collect()
    assert len(got) == 89 and {r.body for r in got} == {"b"}


def test_empty(spark):
    assert warc.resolve(spark.createDataFrame([], warc.RECORD)).count() == 0
