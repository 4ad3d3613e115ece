"""Entity-timeline operators against plain Python loops (hot entity, same-day peers)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from faceoff.operators import timeline


def make_history(seed, n=400):
    """One hot entity with ~1/3 of rows, several small ones, many same-day rows, NULL entity too."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ent = "HOT" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", "d", None])
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        rows.append((i * 7 + rnd.randint(0, 6), ent, day, rnd.choice([1, -1, 0]), rnd.randint(0, 1)))
    return rows


def ordered(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by.setdefault(r[1], []).append(r)
    return by


def df_of(spark, rows, parts):
    return spark.createDataFrame(rows, "id long, ent string, date date, o int, won int").repartition(parts)


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 5), (3, 3)])
def test_prior_rows_strict_and_rowwise(spark, seed, parts):
    rows = make_history(seed)
    df = df_of(spark, rows, parts)
    strict = timeline.prior_rows(df, "ent", "date", "id", 5, {"won": F.col("won")}, strict_time=True)
    rowwise = timeline.prior_rows(df, "ent", "date", "id", 5, {"won": F.col("won")}, strict_time=False, out="_r")
    got_s = {r["id"]: [x["k"] for x in r["_prior"]] for r in strict.collect()}
    got_r = {r["id"]: [x["k"] for x in r["_r"]] for r in rowwise.collect()}
    for ent, hist in ordered(rows).items():
        for i, r in enumerate(hist):
            earlier_day = [h[0] for h in hist if h[2] < r[2]]
            assert got_s[r[0]] == earlier_day[-5:], (ent, r)
            assert got_r[r[0]] == [h[0] for h in hist[:i]][-5:], (ent, r)


@pytest.mark.parametrize("seed,parts", [(4, 1), (5, 6)])
def test_signed_streak_matches_loop(spark, seed, parts):
    rows = make_history(seed)
    out = timeline.signed_streak(df_of(spark, rows, parts), "ent", "date", "id", "o", "before", "after")
    got = {r["id"]: (r["before"], r["after"]) for r in out.collect()}
    for ent, hist in ordered(rows).items():
        s = 0
        for r in hist:
            before = s
            if r[3] == 1:
                s = s + 1 if s >= 0 else 1
            elif r[3] == -1:
                s = s - 1 if s <= 0 else -1
            else:
                s = 0
            assert got[r[0]] == (before, s), (ent, r)


@pytest.mark.parametrize("inclusive", [False, True])
def test_running_and_lag(spark, inclusive):
    rows = make_history(7)
    df = df_of(spark, rows, 4)
    out = timeline.running(df, "ent", "date", "id", {"w": F.col("won"), "n": F.lit(1)}, inclusive=inclusive)
    out = timeline.lag_value(out, "ent", "date", "id", "o", "prev_o")
    got = {r["id"]: (r["w"], r["n"], r["prev_o"]) for r in out.collect()}
    for ent, hist in ordered(rows).items():
        for i, r in enumerate(hist):
            upto = hist[: i + 1] if inclusive else hist[:i]
            prev = hist[i - 1][3] if i else None
            assert got[r[0]] == (sum(h[4] for h in upto), len(upto), prev), (ent, r)


def test_latest_n(spark):
    rows = make_history(8)
    df = df_of(spark, rows, 3)
    top = timeline.latest_n(df, "ent", [F.col("date").desc(), F.col("id").desc()], 3)
    got = sorted((r["ent"] or "", r["id"]) for r in top.collect())
    exp = sorted((e or "", h[0]) for e, hist in ordered(rows).items() for h in hist[::-1][:3])
    assert got == exp


def crowded(seed, n=600):
    """A third of all rows on one entity and day, ids in no order, some days without a date."""
    rnd = random.Random(seed)
    ids = rnd.sample(range(-10**12, 10**12), n)
    rows = []
    for i, key in enumerate(ids):
        if i % 3 == 0:
            ent, day = "HOT", dt.date(2020, 1, 9)
        else:
            ent = rnd.choice(["HOT", "a", "b", None])
            day = None if rnd.random() < 0.1 else dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 15))
        rows.append((key, ent, day, rnd.choice([1, 1, -1, 0]), rnd.randint(0, 1)))
    return rows


def in_order(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or dt.date.min, r[0])):
        by.setdefault(r[1], []).append(r)
    return by


@pytest.fixture
def short_ranges(monkeypatch):
    monkeypatch.setattr(timeline, "LEAST", 12)
    monkeypatch.setattr(timeline, "SAMPLE", 4)


def test_crowded_day_is_cut(spark, short_ranges):
    rows = crowded(11)
    cells = timeline.with_cell(df_of(spark, rows, 5), "ent", "date", "id").groupBy(timeline.CELL).count().collect()
    hot = sorted((c[timeline.CELL].part, c["count"]) for c in cells if c[timeline.CELL].entity.k0 == "HOT" and c[timeline.CELL].time == dt.date(2020, 1, 9))
    assert len(hot) >= 8 and max(n for _, n in hot) <= 60
    assert [p for p, _ in hot] == list(range(len(hot)))
    assert sum(c["count"] for c in cells) == len(rows)


def test_cuts_follow_the_table(spark, monkeypatch):
    rows = crowded(12)
    df = df_of(spark, rows, 3)
    cell = F.struct(F.struct(F.col("ent").alias("k0")).alias("entity"), F.col("date").alias("time")).alias(timeline.CELL)
    assert timeline.cuts(df.select(cell, "id"), "id") == []  # no day fills a range
    monkeypatch.setattr(timeline, "LEAST", 1)
    monkeypatch.setattr(timeline, "RANGES", 30)
    found = timeline.cuts(df.select(cell, "id"), "id")
    assert 5 <= sum(len(r["_cuts"]) for r in found) <= 30
    same_tie = spark.range(100).selectExpr("5L AS id", "'x' AS ent", "DATE'2020-01-01' AS date", "1 AS o", "1 AS won")
    assert [r["_cuts"] for r in timeline.cuts(same_tie.select(cell, "id"), "id")] in ([], [[5]])


@pytest.mark.parametrize("parts", [1, 6])
def test_operators_on_a_crowded_day(spark, short_ranges, parts):
    rows = crowded(13)
    df = df_of(spark, rows, parts)
    streak = {r["id"]: (r["before"], r["after"]) for r in timeline.signed_streak(df, "ent", "date", "id", "o", "before", "after").collect()}
    run = timeline.running(df, "ent", "date", "id", {"w": F.col("won"), "n": F.lit(1)}, inclusive=True)
    lag = timeline.lag_value(run, "ent", "date", "id", "o", "prev_o")
    counted = {r["id"]: (r["w"], r["n"], r["prev_o"]) for r in lag.collect()}
    strict = timeline.prior_rows(df, "ent", "date", "id", 5, {"won": F.col("won")}, strict_time=True)
    strict = {r["id"]: [x["k"] for x in r["_prior"]] for r in strict.collect()}
    by_row = timeline.prior_rows(df, "ent", "date", "id", 5, {"won": F.col("won")}, strict_time=False)
    by_row = {r["id"]: [x["k"] for x in r["_prior"]] for r in by_row.collect()}
    assert len(streak) == len(counted) == len(strict) == len(by_row) == len(rows)
    for hist in in_order(rows).values():
        s = 0
        for i, r in enumerate(hist):
            before, s = s, (0 if r[3] == 0 else s + r[3] if s * r[3] > 0 else r[3])
            assert streak[r[0]] == (before, s)
            assert counted[r[0]] == (sum(h[4] for h in hist[: i + 1]), i + 1, hist[i - 1][3] if i else None)
            assert strict[r[0]] == [h[0] for h in hist[:i] if h[2] != r[2]][-5:]
            assert by_row[r[0]] == [h[0] for h in hist[:i]][-5:]


def test_text_ties_and_repeated_ties(spark, short_ranges):
    rows = [(f"{i % 90:03d}", "x", dt.date(2020, 1, 1), 1, 1) for i in range(180)]
    df = spark.createDataFrame(rows, "id string, ent string, date date, o int, won int")
    out = timeline.running(df, "ent", "date", "id", {"n": F.lit(1)}, inclusive=True).collect()
    assert sorted(r["n"] for r in out) == list(range(1, 181))
    assert all(r["n"] in (2 * int(r["id"]) + 1, 2 * int(r["id"]) + 2) for r in out)


def test_empty_history(spark, short_ranges):
    df = spark.createDataFrame([], "id long, ent string, date date, o int, won int")
    assert timeline.signed_streak(df, "ent", "date", "id", "o").collect() == []
