import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimsmith.operators.windows import latest_per_key, pick_one, sessionize_gap, top_k_salted

D = dt.date


def _stays(spark, rows):
    df = spark.createDataFrame(rows, "m string, a date, d date").distinct()
    out = sessionize_gap(df, ["m"], "a", "d", 4)
    return sorted((r["a"], r["HOSP_STAY"]) for r in out.collect())


def test_gap_of_four_days_continues_five_starts_new(spark):
    rows = [("x", D(2020, 1, 1), D(2020, 1, 2)), ("x", D(2020, 1, 6), D(2020, 1, 7)),
            ("x", D(2020, 1, 12), D(2020, 1, 12))]
    assert _stays(spark, rows) == [(D(2020, 1, 1), 1), (D(2020, 1, 6), 1), (D(2020, 1, 12), 2)]


def test_duplicate_intervals_do_not_open_stays(spark):
    rows = [("x", D(2020, 1, 1), D(2020, 1, 3))] * 3 + [("x", D(2020, 1, 5), D(2020, 1, 5))]
    assert _stays(spark, rows) == [(D(2020, 1, 1), 1), (D(2020, 1, 5), 1)]


def test_previous_row_rule_splits_contained_stay(spark):
    # A long stay, a short contained one, then a line 6 days after the short
    # one: the previous-row rule opens a new stay even though it is inside the
    # long stay's span (documented source behaviour).
    rows = [("x", D(2020, 1, 1), D(2020, 1, 30)), ("x", D(2020, 1, 2), D(2020, 1, 3)),
            ("x", D(2020, 1, 9), D(2020, 1, 10))]
    assert _stays(spark, rows) == [(D(2020, 1, 1), 1), (D(2020, 1, 2), 1), (D(2020, 1, 9), 2)]


def test_pick_one_matches_row_number(spark):
    random.seed(7)
    rows = [(random.randint(0, 5), random.randint(0, 3), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, v int, id int")
    got = sorted(tuple(r) for r in pick_one(df, ["k"], [F.col("v"), F.col("id")], ["v", "id"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("id").desc())
    exp = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
                 .select("k", "v", "id").collect())
    assert got == exp


def test_latest_per_key_nulls_last(spark):
    rows = [("a", None, 1, "x"), ("a", D(2020, 1, 1), 2, "y"), ("a", D(2020, 1, 1), 3, "z")]
    df = spark.createDataFrame(rows, "k string, d date, rk int, v string")
    assert [r["v"] for r in latest_per_key(df, "k", "d", "rk", ["v"]).collect()] == ["z"]


def test_top_k_salted_equals_brute_force_on_hot_key(spark):
    random.seed(3)
    # one hot key with 3000 rows plus many small keys; ties on amount
    rows = [("hot", float(random.randint(0, 50)), f"l{i:05d}") for i in range(3000)]
    rows += [(f"k{j}", float(random.randint(0, 5)), f"m{j}-{i}") for j in range(50) for i in range(4)]
    df = spark.createDataFrame(rows, "e string, amt double, lk string")
    got = sorted(tuple(r) for r in top_k_salted(df, "e", "amt", "lk", 3, 8).select("e", "lk", "RANK").collect())
    w = Window.partitionBy("e").orderBy(F.col("amt").desc(), F.col("lk"))
    exp = sorted(tuple(r) for r in df.withColumn("RANK", F.row_number().over(w)).filter("RANK <= 3")
                 .select("e", "lk", "RANK").collect())
    assert got == exp


def test_sessionize_events_matches_lag_rule(spark):
    import datetime as dt2
    from claimsmith.operators.windows import sessionize_events
    random.seed(11)
    base = dt2.datetime(2020, 1, 1)
    rows = []
    for u in range(20):
        t = base
        for i in range(60 if u else 2000):  # user 0 is hot
            t = t + dt2.timedelta(seconds=random.choice([10, 100, 1799, 1800, 1801, 5000]))
            rows.append((u * 100000 + i, u, t))
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp")
    got = {r["event_id"]: r["SESSION_ID"] for r in sessionize_events(df, "user_id", "ts", 1800).collect()}
    exp = {}
    by_user = {}
    for e, u, t in rows:
        by_user.setdefault(u, []).append((t, e))
    for u, evs in by_user.items():
        evs.sort()
        sid, prev = 0, None
        for t, e in evs:
            if prev is None or (t - prev).total_seconds() > 1800:
                sid += 1
            exp[e] = sid
            prev = t
    assert got == exp


def test_table_name_rules():
    import pytest
    from claimsmith.config import ClaimsConfig, table_name
    cfg = ClaimsConfig(client="ACME", table_suffix="_TEST")
    assert table_name("medical", cfg) == "FA_MEDICAL_ACME"
    assert table_name("ps_newborns", cfg) == "PS_NEWBORNS_ACME_TEST"
    assert table_name("ref_newborn_icd", cfg) == "NEWBORN_ICD"
    with pytest.raises(ValueError):
        table_name("unknown", cfg)
    with pytest.raises(ValueError):
        ClaimsConfig(table_suffix="bad")
