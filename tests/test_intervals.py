"""Interval join, segmented scan and distinct months against brute force, with hot keys."""

import datetime as dt
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from claimsmith.config import StudyWindow
from claimsmith.operators.joins import interval_join, join_enrich_nullsafe
from claimsmith.operators.periods import distinct_months, membership_periods
from claimsmith.operators.windows import deal_by_range, sessionize_gap

D0 = dt.date(1990, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_with_long_intervals_and_a_hot_key(spark, how):
    rng = random.Random(3)
    points = [("hot", day(rng.randrange(11_000)), i) for i in range(600)] + [(rng.choice("abc"), day(rng.randrange(11_000)), i) for i in range(600, 700)]
    points += [("hot", None, 701), (None, day(5), 702), ("z", day(5), 703)]
    spans = [("hot", rng.randrange(11_000), rng.choice([0, 1, 30, 400]), i) for i in range(400)]
    spans += [("hot", 0, 10_957, 900), ("hot", 10, 10_957, 901), ("a", 0, 10_957, 902), ("b", 50, -1, 903), ("c", 3, 9000, 904), (None, 0, 99, 905)]
    spans += [("hot", 77, 20, 1000 + i) for i in range(50)]  # one day with many starts
    p = spark.createDataFrame(points, "k string, d date, id int")
    iv = spark.createDataFrame([(k, day(a), day(a + n), v) for k, a, n, v in spans] + [("a", None, day(9), 906)], "k string, lo date, hi date, v int")
    got = sorted((tuple(r) for r in interval_join(p, iv, ["k"], "d", "lo", "hi", how=how, starts=16).select("id", "v").collect()), key=repr)
    want = [(i, v) for k, d, i in points for q, a, n, v in spans if k is not None and d is not None and k == q and day(a) <= d <= day(a + n)]
    if how == "left":
        met = {i for i, _ in want}
        want += [(i, None) for _, _, i in points if i not in met]
    assert got == sorted(want, key=repr)


def test_interval_copies_are_bounded(spark):
    """Thirty-year intervals of ordinary keys are not copied, those of a hot key once a cell."""
    from claimsmith.operators import joins as J
    iv = spark.range(300).select(F.concat(F.lit("k"), (F.col("id") % 30).cast("string")).alias("k"), F.lit(D0).alias("lo"), F.lit(day(10_957)).alias("hi"))
    assert J.interval_cells(iv, ["k"], "lo", 64).isEmpty()
    hot = spark.range(1000).select(F.lit("k").alias("k"), F.expr("date_add(date'1990-01-01', cast(id * 10 as int))").alias("lo"))
    edges = J.interval_cells(hot, ["k"], "lo", 64).first()._edges
    assert len(edges) == 16 and edges == sorted(edges)


def intervals(rng, n, key="m"):
    out = set()
    while len(out) < n:
        a = rng.randrange(20 * n)
        out.add((key, day(a) if rng.random() > 0.01 else None, day(a + rng.randrange(-6, 30)) if rng.random() > 0.05 else None))
    return [(*x, rng.randrange(1, 4)) for x in sorted(out, key=repr)]


@pytest.mark.parametrize("mode", ["previous", "running_max"])
@pytest.mark.parametrize("copies", [None, "n"])
def test_segmented_scan_equals_the_window(spark, mode, copies):
    rng = random.Random(7)
    rows = intervals(rng, 900, "hot") + [r for k in "abcde" for r in intervals(rng, 12, k)] + intervals(rng, 5, None)
    df = spark.createDataFrame(rows, "m string, a date, d date, n int")
    one, many = (sessionize_gap(df, ["m"], "a", "d", 4, copies=copies, mode=mode, spread=s) for s in (False, True))
    assert set(one.columns) == set(many.columns)
    assert sorted(map(repr, one.select(sorted(one.columns)).collect())) == sorted(map(repr, many.select(sorted(one.columns)).collect()))


def test_a_million_intervals_of_one_key_are_spread(spark):
    df = spark.range(1_000_000).select(F.lit("m").alias("m"), F.expr("date_add(date'0100-01-01', cast(id * 3 as int))").alias("a"),
                                       F.expr("date_add(date'0100-01-01', cast(id * 3 + id % 9 as int))").alias("d"))
    sizes = [r[0] for r in deal_by_range(df, ["m"], [F.col("a"), F.col("d")]).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * median(sizes) and len(sizes) == 8
    got = sessionize_gap(df, ["m"], "a", "d", 4, spread=True).agg(F.max("HOSP_STAY"), F.count("*"), F.sum("NEW_STAY")).first()
    assert tuple(got) == (1, 1_000_000, 1)


def test_months_are_counted_once(spark):
    rng = random.Random(11)
    w = StudyWindow(dt.date(1999, 8, 1), dt.date(2000, 8, 1), dt.date(2001, 7, 31), dt.date(2001, 10, 31))
    rows = []
    for m in range(40):
        for _ in range(rng.randrange(1, 9)):
            a = dt.date(1999, 1, 1) + dt.timedelta(days=rng.randrange(1100))
            rows.append((str(m), a, None if rng.random() < 0.1 else a + dt.timedelta(days=rng.randrange(-20, 400))))
    df = spark.createDataFrame(rows, "INDV_ID string, MEM_EFF_DT date, MEM_EXP_DT date")
    got = {(r.INDV_ID, r.STUDY_YR): r.MEMBER_MONTHS for r in distinct_months(df, w).collect()}
    want = {}
    for m, a, b in rows:
        for label, lo, hi in (("Previous", w.start, w.mid - dt.timedelta(days=1)), ("Current", w.mid, w.end)):
            s, e = max(a, lo), b and min(b, hi)
            if e and s <= e:
                want.setdefault((m, label), set()).update(range(s.year * 12 + s.month, e.year * 12 + e.month + 1))
    assert got == {k: len(v) for k, v in want.items()} and max(got.values()) <= 12


def test_membership_once_never_exceeds_the_window(spark):
    from claimsmith.config import FIXTURE_WINDOW
    from claimsmith.sources import fixtures as FX
    from conftest import SF0001
    members = FX.fx_membership(spark, SF0001)
    once = {(r.INDV_ID, r.STUDY_YR): r.MEMBER_MONTHS for r in membership_periods(members, FIXTURE_WINDOW, "X", once=True).collect()}
    every = {(r.INDV_ID, r.STUDY_YR): r.MEMBER_MONTHS for r in membership_periods(members, FIXTURE_WINDOW, "X").collect()}
    assert once.keys() == every.keys() and all(once[k] <= every[k] for k in once) and max(once.values()) <= 12 and max(every.values()) > 12


def test_compact_null_enrichment(spark):
    left = spark.range(1_000_000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("i")).unionAll(
        spark.createDataFrame([("a", -1), ("b", -2), ("c", -3)], "k string, i long"))
    right = spark.range(1_000_000).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v")).unionAll(
        spark.createDataFrame([("a", -7), ("b", -8), ("b", -9)], "k string, v long"))
    got = join_enrich_nullsafe(left, right, "k", ["v"], null_matches="n")
    assert sorted(tuple(r) for r in got.where("i < 0").select("i", "v", "n").collect()) == sorted([(-1, -7, 1), (-2, -8, 1), (-2, -9, 1), (-3, None, 0)], key=lambda r: (r[0], r[1] or 0))
    assert tuple(got.where("i >= 0").agg(F.count("*"), F.min("v"), F.max("v"), F.min("n"), F.max("n")).first()) == (1_000_000, 999_999, 999_999, 1_000_000, 1_000_000)
