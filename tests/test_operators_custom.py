import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from claimsmith.operators.aggregates import exact_median
from claimsmith.operators.joins import range_join


def test_exact_median_hot_null_and_global(spark):
    random.seed(2)
    rows = [("hot", random.randint(-10**9, 10**9)) for _ in range(5001)]
    rows += [(f"g{i}", random.randint(0, 9)) for i in range(100) for _ in range(random.randint(1, 4))]
    rows += [(None, 3), (None, 10), ("even", 1), ("even", 2), ("nullv", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r["g"]: r["M"] for r in exact_median(df, ["g"], "v", "M", buckets=256).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: float(statistics.median(vs)) for g, vs in groups.items()}
    allv = [v for _, v in rows if v is not None]
    assert exact_median(df, [], "v", "M").first()["M"] == float(statistics.median(allv))


def test_range_join_equals_naive_join(spark):
    random.seed(4)
    d0 = dt.date(2000, 1, 1)
    pts = [(f"m{random.randint(0, 5)}", i, d0 + dt.timedelta(days=random.randint(0, 400))) for i in range(600)]
    ivs = []
    for j in range(80):
        a = d0 + dt.timedelta(days=random.randint(0, 400))
        ivs.append((f"m{random.randint(0, 5)}", j, a, a + dt.timedelta(days=random.choice([0, 3, 40, 150]))))
    p = spark.createDataFrame(pts, "k string, pid int, d date")
    iv = spark.createDataFrame(ivs, "k string, iid int, lo date, hi date")
    got = sorted(tuple(r) for r in range_join(p, iv, ["k"], "d", "lo", "hi", bucket_days=7)
                 .select("pid", "iid").collect())
    exp = sorted((pid, iid) for k, pid, d in pts for k2, iid, lo, hi in ivs if k == k2 and lo <= d <= hi)
    assert got == exp
    left = range_join(p, iv, ["k"], "d", "lo", "hi", bucket_days=7, how="left")
    matched = {pid for pid, _ in exp}
    assert left.filter(F.col("iid").isNull()).count() == len([x for x in pts if x[1] not in matched])
