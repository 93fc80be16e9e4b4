"""Plan-shape and skew checks: pushdown into Parquet, hot-member correctness."""

import datetime as dt
import os
import random
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from claimsmith.config import FIXTURE_WINDOW, ClaimsConfig
from claimsmith.operators import codes
from claimsmith.plans import episodes as EP
from claimsmith.sources import fixtures as FX
from conftest import SF0001

CFG = ClaimsConfig()


def _stored_claims(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="claims-"), "fa_medical")
    FX.fx_claims(spark, SF0001).write.parquet(path)
    return spark.read.parquet(path)


def test_window_filter_and_cohort_columns_reach_the_scan(spark):
    claims = _stored_claims(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    w = EP.filter_study_window(claims, FIXTURE_WINDOW)
    plan = codes.cohort_keys(w, CFG)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters: ["):].split("]", 1)[0]
    for f in ("IsNotNull(INDV_ID)", "GreaterThanOrEqual(SRVC_FROM_DT,1999-08-01)",
              "LessThanOrEqual(SRVC_FROM_DT,2001-07-31)", "LessThanOrEqual(PROCESS_DT,2001-10-31)"):
        assert f in pushed, (f, pushed)
    # only the key, date and code columns are read for the cohort
    read = plan[plan.index("ReadSchema: struct<"):].split(">", 1)[0]
    assert "NET_PD_AMT" not in read and "PROV_FULL_NM" not in read and "INDV_ID" in read


def _brute_force_stays(rows, gap=4):
    """Line-level previous-row rule, the direct way."""
    out = {}
    by = {}
    for m, dlv, a, d, paid in rows:
        by.setdefault((m, dlv), []).append((a, d, paid))
    for key, lines in by.items():
        lines.sort(key=lambda x: (x[0], x[1]))
        stay, prev, agg = 0, None, {}
        for a, d, paid in lines:
            if prev is None or (a - prev).days > gap:
                stay += 1
            prev = d
            lo, hi, s = agg.get(stay, (a, d, Decimal(0)))
            agg[stay] = (min(lo, a), max(hi, d), s + paid)
        for s, v in agg.items():
            out[(key[0], key[1], s)] = v
    return out


def test_hot_member_stays_equal_brute_force(spark):
    random.seed(5)
    d0 = dt.date(2000, 1, 1)
    rows = []
    for m, n in (("hot", 6000), ("a", 40), ("b", 15)):
        for _ in range(n):
            a = d0 + dt.timedelta(days=random.randint(0, 600))
            d = a + dt.timedelta(days=random.randint(0, 6))
            rows.append((m, d0, a, d, Decimal(random.randint(1, 10000)) / 100))
    df = spark.createDataFrame(
        [(m, dlv, "IP", a, d, a, d, p, False) for m, dlv, a, d, p in rows],
        "INDV_ID string, DELIVERY_DT date, CLAIM_TYPE string, ADMIT_DT date, DISCH_DT date, SRVC_FROM_DT date, "
        "SRVC_THRU_DT date, NET_PD_AMT decimal(18,2), HIGH_COST boolean")
    runout = dt.date(2010, 1, 1)
    got = {(r["INDV_ID"], r["DELIVERY_DT"], r["HOSP_STAY"]): (r["ADMIT"], r["DSCHRG"], r["PAID_AMT"])
           for r in EP.hospital_rollup(df, runout, CFG).collect()}
    exp = _brute_force_stays(rows)
    assert got == exp


def test_among_is_a_condition_that_spark_pushes_to_the_scan(spark, tmp_path):
    from claimsmith.operators.joins import among
    spark.range(5000).selectExpr("cast(id as string) as k", "id % 7 as v").write.parquet(str(tmp_path / "l"))
    spark.range(5000).selectExpr("cast(id as string) as k2", "id as w").write.parquet(str(tmp_path / "r"))
    joined = spark.read.parquet(str(tmp_path / "l")).join(spark.read.parquet(str(tmp_path / "r")), F.col("k") == F.col("k2"))
    keys = spark.createDataFrame([(str(i),) for i in range(0, 5000, 50)] + [(None,)], "k string")
    out = joined.where(among(keys, "k"))
    kept = {r.k for r in out.collect()}
    assert kept >= {str(i) for i in range(0, 5000, 50)} and len(kept) < 110
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("getbit")
    assert spark.createDataFrame([(None,)], "k string").where(among(keys, "k")).count() == 0
    assert joined.where(among(keys.limit(0), "k")).count() == 0


def test_claims_are_scanned_once_for_the_cohort_and_once_for_its_lines(spark):
    """The claim-level flags start from the stored cohort claims, so the claims aren't built again for them."""
    from claimsmith import queries as Q
    from claimsmith.sources.sinks import materialize
    ctx, stored = Q.Ctx(spark, SF0001), []

    def cut(df):
        stored.append(df._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") > 0)
        return materialize(df)
    out = EP.tagged_claims(ctx.claims, ctx.ps, Q.W, Q.CFG, cut=cut)
    assert "l_orderkey" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert stored == [True, False, True]  # cohort, filter of its keys, lines
    plain = EP.tagged_claims(ctx.claims, ctx.ps, Q.W, Q.CFG)
    assert out.columns == plain.columns and out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty() and not out.isEmpty()


def test_wide_claims_projection_is_small_enough_to_be_compiled(spark):
    """No constant list is a chain of conditions (each one was hundreds of bytes of generated code)."""
    from claimsmith.sources import fixtures as FX
    plan = FX.fx_claims(spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" WHEN ") < 25


def test_tagged_claims_are_stored_once_and_eligibility_is_read_for_the_cohort(spark):
    """The last stored table has the flags already, and the key filter of the cohort is on both scans of the orders."""
    from claimsmith import queries as Q
    from claimsmith.sources.sinks import materialize
    ctx, stored = Q.Ctx(spark, SF0001), []

    def cut(df):
        stored.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return materialize(df)
    out = EP.tagged_claims(ctx.claims, ctx.ps, Q.W, Q.CFG, cut=cut)
    columns, plan = stored[-1]
    assert columns == out.columns and "NEWBORN_ICD" in columns
    filters = [x for x in plan.splitlines() if "Filter" in x and "getbit" in x]
    assert any("o_orderdate" in y for y in plan.splitlines()) and len(filters) >= 2


def test_claim_rows_are_compiled_unless_the_session_has_a_limit(spark):
    from claimsmith import queries as Q
    limit = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(limit)
    try:
        for given, kept in (("65535", "8000"), ("4000", "4000")):
            spark.conf.set(limit, given)
            Q.Ctx(spark, SF0001)
            assert spark.conf.get(limit) == kept
    finally:
        spark.conf.set(limit, was)


def test_a_month_of_claims_is_more_files_where_there_are_more_tasks(spark, monkeypatch):
    from claimsmith import queries as Q
    seen = []
    monkeypatch.setattr(Q.LO, "write_by_month", lambda claims, path, files: seen.append(files))
    monkeypatch.setattr(Q.LO, "month_bounds", lambda *a: (_ for _ in ()).throw(KeyError))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (8, 600):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            try:
                Q.q_newborn_by_tables(Q.Ctx(spark, SF0001))
            except KeyError:
                pass
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert seen == [1, 50]
