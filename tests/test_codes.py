from pyspark.sql import functions as F

from claimsmith.config import FIXTURE_WINDOW, ClaimsConfig
from claimsmith.operators import codes
from claimsmith.plans import episodes as EP
from claimsmith.sources import fixtures as FX
from conftest import SF0001

CFG = ClaimsConfig()


def test_claim_flag_spreads_to_all_lines_and_null_keys_false(spark):
    rows = [("m1", "c1", "Z3800", None), ("m1", "c1", "J100", None), ("m1", "c2", "J100", None),
            (None, "c1", "Z3800", None)]
    df = spark.createDataFrame(rows, "INDV_ID string, CLM_AUD_NBR string, DIAG_1_CD string, DIAG_2_CD string")
    out = codes.flag_any_of_columns(df, {"SINGLE": ("Z3800",)}, ["DIAG_1_CD", "DIAG_2_CD"])
    got = sorted((r["INDV_ID"] or "", r["CLM_AUD_NBR"], r["DIAG_1_CD"], r["SINGLE"]) for r in out.collect())
    assert got == [("", "c1", "Z3800", False), ("m1", "c1", "J100", True), ("m1", "c1", "Z3800", True),
                   ("m1", "c2", "J100", False)]


def test_cohort_forms_agree(spark):
    w = EP.filter_study_window(FX.fx_claims(spark, SF0001), FIXTURE_WINDOW)
    a = sorted(r[0] for r in codes.cohort_keys(w, CFG).collect())
    b = sorted(r[0] for r in codes.cohort_keys_union(w, CFG).collect())
    c = sorted(r[0] for r in codes.cohort_or_join(w, CFG).collect())
    assert a == b == c and len(a) > 0


def test_cohort_semi_join_plan_has_no_driver_list(spark):
    w = EP.filter_study_window(FX.fx_claims(spark, SF0001), FIXTURE_WINDOW)
    plan = codes.cohort_semi_join(w, codes.cohort_keys(w, CFG))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_prefix_flag_null_is_false(spark):
    df = spark.createDataFrame([("5931",), (None,), ("790",)], "DRG string")
    out = codes.flag_code_prefix(df, "DRG", ("593",), "MS")
    assert [r["MS"] for r in out.collect()] == [True, False, False]


def test_reference_table_is_broadcast_before_lines_are_dealt_by_code(spark):
    """Most lines have no code: none of them may be shuffled by it (it put them all in one task)."""
    df = spark.range(1000).selectExpr("id as LINE", "case when id % 50 = 0 then '5801' when id % 50 = 1 then '470' end as DRG")
    ref = spark.createDataFrame([("580",), ("580",), (None,)], "CODE string")  # of a size that Spark doesn't know
    out = codes.flag_code_prefix(df, "DRG", ref, "HIT")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_probe" not in plan
    assert out.columns == ["LINE", "DRG", "HIT"] and out.count() == 1000
    assert out.where("HIT").count() == 20 and out.where("HIT and DRG <> '5801'").count() == 0


def test_lines_without_a_code_are_dealt_over_tasks_where_the_table_is_too_big_to_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(4000).selectExpr("id as LINE", "case when id % 50 = 0 then '5801' end as DRG")
        out = codes.flag_code_prefix(df, "DRG", spark.createDataFrame([("580",)], "CODE string"), "HIT")
        parts = out.where("DRG is null").groupBy(F.spark_partition_id()).count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "_deal" in plan and sum(r["count"] for r in parts) == 3920
        assert out.where("HIT").count() == 80
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_flags_of_lines_that_are_together_equal_the_join(spark):
    rows = [("1", "a", 1, "Z3800", None), ("1", "a", 2, None, None), ("1", "a", 2, None, None), ("1", "b", 3, "X", None), ("1", None, 4, "Z3800", None),
            ("1", None, 5, None, None), (None, "a", 6, None, "Z3800"), (None, "a", 7, None, None), ("2", "a", 8, None, "Y")]
    df = spark.createDataFrame(rows, "INDV_ID string, CLM_AUD_NBR string, n int, DIAG_1_CD string, DIAG_2_CD string")
    flags = {"SINGLE": ("Z3800",), "OTHER": ("X", "Y")}
    joined, spread = (codes.flag_any_of_columns(df, flags, together=t) for t in (False, True))
    assert spread.columns == joined.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, joined.collect()))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan(joined) and "Join" not in plan(spread)
