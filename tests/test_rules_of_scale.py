"""Uncapped results, elapsed days, text dates, equal stay lines, null keys, released storage."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from claimsmith.functions.exprs import days_between_clock, elapsed_days, parse_when
from claimsmith.operators.joins import join_enrich_nullsafe
from claimsmith.operators.windows import rank_all, sessionize_gap
from claimsmith.plans import profile as P
from claimsmith.sources import sinks as SK

D, TS = dt.date, dt.datetime


def test_rank_all_ranks_every_line_of_a_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([None, *map(float, range(30))]), f"l{i:05d}") for i in range(4000)]
    rows += [(f"k{j}", float(rng.randint(0, 5)), f"m{j}-{i}") for j in range(60) for i in range(4)]
    out = rank_all(spark.createDataFrame(rows, "e string, amt double, lk string"), "e", "amt", "lk").collect()
    want = {}
    for e in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == e), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        want |= {(e, r[2]): i + 1 for i, r in enumerate(own)}
    assert {(r.e, r.lk): r.RANK for r in out} == want


def test_distinct_counts_know_no_limit(spark):
    df = spark.range(150_000).select(F.col("id").cast("string").alias("A"), (F.col("id") % 3).alias("B"))
    expected = {c: (False, False, c) for c in ("A", "B")}
    got = {r.column_name: r.distinct_count for r in P.profile_columns(df, expected, "T").collect()}
    assert got == {"A": 150_000, "B": 3}


def test_empty_table_has_one_alert(spark):
    df = spark.createDataFrame([], "A string")
    expected = {"A": (True, False, "a"), "Z": (True, False, "z")}
    _, alerts, summary = P.profile_table(df, expected, "T")
    assert [r.message for r in alerts.collect()] == ["Table T is empty!"]
    assert summary.first().total_rows == 0 and not summary.first().passed


def test_days_are_elapsed_and_floored(spark):
    rows = [(TS(2001, 12, 1, 22), TS(2001, 12, 2, 2), 0), (TS(2001, 12, 2), TS(2001, 12, 1, 23), -1), (TS(2001, 1, 1), TS(2001, 1, 3), 2), (None, TS(2001, 1, 1), None)]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp, want int")
    assert df.where(~elapsed_days("a", "b").eqNullSafe(F.col("want"))).count() == 0
    clock = spark.createDataFrame([(TS(2001, 12, 16, 10),)], "t timestamp")
    assert clock.select(days_between_clock(D(2001, 12, 31), "t").alias("d")).first().d == 14
    assert clock.select(days_between_clock(TS(2001, 12, 31, 10), "t").alias("d")).first().d == 15


def test_text_dates(spark):
    cases = {"01/02/2001": TS(2001, 1, 2), "1/2/2001 4:05": TS(2001, 1, 2, 4, 5), "1/2/2001 4:05 PM": TS(2001, 1, 2, 16, 5), "2001-01-02": TS(2001, 1, 2),
             "2001-01-02 03:04:05": TS(2001, 1, 2, 3, 4, 5), "20010102": TS(2001, 1, 2), "2 Jan 2001": TS(2001, 1, 2), "Jan 2, 2001": TS(2001, 1, 2),
             "13/40/2001": None, "not a date": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "START_DATE string")
    got = [r.t for r in df.select(parse_when(df, "START_DATE").alias("t")).collect()]
    assert got == list(cases.values())
    text, _ = SK.normalize_dates(df)
    assert [r.START_DATE for r in text.collect()] == [v and v.strftime("%Y-%m-%d") for v in cases.values()]


def line_rule(lines, gap, mode):
    """Stay number of every line, one line at a time."""
    lines = sorted(lines, key=lambda r: (r[0] or D.min, r[1] is not None, r[1] or D.min))
    out, n, ends = [], 0, []
    for a, d in lines:
        before = None if not ends else ends[-1] if mode == "previous" else max((e for e in ends if e), default=None)
        if before is None or (a - before).days > gap:
            n += 1
        out.append(((a, d), n))
        ends.append(d)
    return out


@pytest.mark.parametrize("mode", ["previous", "running_max"])
def test_equal_lines_open_stays_as_single_lines_do(spark, mode):
    rng = random.Random(7)
    rows = []
    for m in range(60):
        for _ in range(rng.randint(1, 6)):
            a = D(2001, 1, 1) + dt.timedelta(rng.randint(0, 25))
            d = rng.choice([None, a + dt.timedelta(rng.randint(0, 6)), a - dt.timedelta(rng.randint(1, 9))])
            rows += [(f"m{m}", a, d)] * rng.randint(1, 3)
    df = spark.createDataFrame(rows, "m string, a date, d date").groupBy("m", "a", "d").agg(F.count("*").alias("n"))
    got = {(r.m, r.a, r.d): (r.HOSP_STAY, r.REOPENS, r.n) for r in sessionize_gap(df, ["m"], "a", "d", 4, copies="n", mode=mode).collect()}
    for m in {r[0] for r in rows}:
        want = {}
        for key, n in line_rule([r[1:] for r in rows if r[0] == m], 4, mode):
            want.setdefault(key, []).append(n)
        for (a, d), numbers in want.items():
            first, reopens, n = got[m, a, d]
            assert numbers == ([first + i for i in range(n)] if reopens else [first] * n), (m, a, d)


def test_null_keys_match_nulls_over_many_tasks(spark):
    left = spark.createDataFrame([(None, i) for i in range(40)] + [("a", 100), ("b", 101)], "k string, i int")
    right = spark.createDataFrame([(None, True), (None, False), ("a", True), ("a", False)], "k string, v boolean")
    got = sorted((r.k or "", r.i, str(r.v)) for r in join_enrich_nullsafe(left, right, "k", ["v"]).collect())
    assert got == sorted([("", i, v) for i in range(40) for v in ("False", "True")] + [("a", 100, "False"), ("a", 100, "True"), ("b", 101, "None")])


def test_null_keys_in_an_upsert_match_nothing(spark):
    t = spark.createDataFrame([(None, "t")] * 5 + [(1, "t")], "ID int, V string")
    s = spark.createDataFrame([(None, "s")] * 4 + [(1, "s")], "ID int, V string")
    merged, counts = SK.upsert_merge(t, s)
    assert tuple(counts.first()) == (4, 1, 5) and merged.count() == 10


def test_stored_tables_are_released(spark):
    SK.release_stored(spark)
    paths = []
    SK.materialize(spark.range(5).toDF("x"), stored=paths)
    P.profile_table(spark.range(5).toDF("A"), {"A": (True, False, "a")}, "T")
    local = [p.removeprefix("file:") for p in SK.STORED]
    assert len(local) >= 2 and all(os.path.exists(p) for p in local)
    SK.release_stored(spark)
    assert not SK.STORED and not any(os.path.exists(p) for p in local)
