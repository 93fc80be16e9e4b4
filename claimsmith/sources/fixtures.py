"""Deterministic claims-shaped views over the TPC-H-like test tables.

The jobs read a claims table, a monthly eligibility table, reference code
tables, two crosswalks and a wide request list.  None ship with test data,
so these views derive them from ``lineitem``/``orders``/``customer``/...
with integer arithmetic only (identical in Spark and in the SQL oracle).
Every view is a lazy DataFrame: its size grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.config import ClaimsConfig
from claimsmith.sources.tables import read_table

BIRTH_BASE = "1999-08-01"


def _case(key: Column, values: list) -> Column:
    """The key-th of constant values, else null.

    A look-up in one constant array, not a chain of conditions: the wide claims
    projection must stay small enough as generated code to be compiled."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), key)


def _amt(cents: Column) -> Column:
    """Integer cents -> decimal(18,2), exactly."""
    return (cents.cast("decimal(18,2)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")


def _plus_days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def _at_hour(d: Column, hour: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(d.cast("timestamp")) + hour * 3_600_000_000)


def _birth(k: Column) -> Column:
    return _plus_days(F.lit(BIRTH_BASE).cast("date"), (k * 37) % 730)


def fx_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim line per lineitem row (claims table stand-in)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(su, li.l_suppkey == su.s_suppkey)
            .join(na, su.s_nationkey == na.n_nationkey))
    # Shared terms are computed once in a narrow projection so the wide
    # projection below references columns instead of repeating expressions.
    base = base.select(
        F.col("o_custkey").alias("k"), F.col("l_orderkey").alias("o"), F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("n"), "s_name", "s_nationkey", "n_name",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        _birth(F.col("o_custkey")).alias("bth"))
    k, o, p, s, n = (F.col(x) for x in ("k", "o", "p", "s", "n"))
    base = base.withColumns({
        "srvc": _plus_days(F.col("bth"), (o * 7 + n * 11) % 150), "k5": k % 5 == 0, "p2": (p % 2).cast("int"), "p3": (p % 3).cast("int"),
        "p4": (p % 4).cast("int"), "p20": (p % 20).cast("int"), "s_text": s.cast("string"), "o_text": o.cast("string")})
    k5, p2, p3, p4, p20 = (F.col(x) for x in ("k5", "p2", "p3", "p4", "p20"))
    cents, bth, srvc = F.col("cents"), F.col("bth"), F.col("srvc")
    j = lambda x: F.concat(F.lit("J"), (F.lit(100) + x).cast("string"))
    diag1 = (F.when(~k5, j(p % 900))
             .when((p20 == 0) & (k % 3 == 0), "Z3830")
             .when((p20 == 1) & (k % 7 == 0), "Z3861")
             .when(p20 < 4, "Z3800")
             .otherwise(_case(p20, [None] * 4 + ["P0714", "P0732", "P961"])))
    diag2 = F.when((p % 7 == 0) & k5, "P0734").when(p % 7 == 1, j(s % 50))
    k20 = k % 20 == 0
    rest = ["0120", "0450", "0981", "0987", "ABC", None, "0301", "0301"]
    rev_k20, rev_nb = ["0170", "0171", "0173", "0174", *rest], ["0170", "0171", "0120", "0120", *rest]
    rev_other = ["0450", "0301", "0490", None, "0960", "0360"]
    return base.select(
        k.cast("string").alias("INDV_ID"),
        F.col("o_text").alias("CLM_AUD_NBR"),
        F.concat_ws("-", "o_text", n, p, "s_text", cents).alias("LINE_KEY"),
        bth.alias("BTH_DT"),
        srvc.alias("SRVC_FROM_DT"),
        _plus_days(srvc, p4).alias("LST_SRVC_DT"),
        _plus_days(srvc, F.lit(10) + s % 200).alias("PROCESS_DT"),
        F.when(p3 != 0, F.date_sub(srvc, p2)).alias("ADMIT_DT"),
        F.when(p4 != 0, _plus_days(srvc, p % 6)).alias("DISCH_DT"),
        diag1.alias("DIAG_1_CD"),
        diag2.alias("DIAG_2_CD"),
        F.when(p2 == 0, j(n)).alias("DIAG_3_CD"),
        F.lit(None).cast("string").alias("DIAG_4_CD"),
        F.lit(None).cast("string").alias("DIAG_5_CD"),
        F.when(p3 == 1, F.concat(F.lit("0B"), (F.lit(10) + s % 7).cast("string"))).alias("PROC_1_CD"),
        F.when(p % 5 == 2, F.concat(F.lit("0C"), (F.lit(20) + n).cast("string"))).alias("PROC_2_CD"),
        F.lit(None).cast("string").alias("PROC_3_CD"),
        _case(s % 8, ["99233", "99468", "99479", "99221", "99283",
                      None, "43239", "0FT44"]).alias("PROC_CD"),
        F.coalesce(F.when(k % 40 == 0, _case(p % 10, ["593", "790"])), F.when(p % 25 == 0, "470")).alias("DERIV_DRG_CD"),
        _case(p % 9, ["01", "20", "07", "02", "30", "06", "04", "1",
                      None]).alias("DSCHRG_STS"),
        _case(n % 6, ["21", "23", "22", "24", "11", "19"]).alias("PL_OF_SRVC_CD"),
        F.when(k20, _case(p % 12, rev_k20)).when(k5, _case(p % 12, rev_nb)).otherwise(_case(p % 6, rev_other)).alias("RVNU_CD"),
        _amt(F.when(p % 50 == 0, cents * 20).otherwise(cents % 1000000)).alias("NET_PD_AMT"),
        _amt(F.when(p % 13 == 0, F.lit(0)).otherwise((cents * 7) % 500000)).alias("ALLW_AMT"),
        _amt(cents).alias("SBMT_CHRG_AMT"),
        _amt((cents * 3) % 500000).alias("COV_AMT"),
        F.when(s % 17 != 0, F.col("s_text")).alias("PROV_NPI"),
        F.col("s_nationkey").cast("string").alias("PROV_TIN"),
        F.col("s_name").alias("PROV_FULL_NM"),
        F.col("n_name").alias("PROV_STATE"),
        (F.lit(501) + (s * 613) % 99000).cast("string").alias("PROV_ZIP_CD"),
        _case(s % 3, ["H", "P", "O"]).alias("PROV_TYP_CD"),
        F.when(n % 2 == 0, "0131").otherwise("0831").alias("BILL_TYPE"),
    )


def fx_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly eligibility rows (about ten per member)."""
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    na = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = od.join(cu, od.o_custkey == cu.c_custkey).join(na, cu.c_nationkey == na.n_nationkey)
    k, o = F.col("o_custkey"), F.col("o_orderkey")
    eff = F.trunc(F.to_date("o_orderdate"), "month")
    ym = F.date_format(F.col("o_orderdate"), "yyyyMM")
    return base.select(
        k.cast("string").alias("INDV_ID"),
        o.alias("ROW_KEY"),
        ym.alias("YEARMO"),
        ym.alias("MM"),
        eff.alias("MEM_EFF_DT"),
        F.when(o % 11 != 0, _plus_days(eff, o % 400)).alias("MEM_EXP_DT"),
        _case(k % 3, ["M", "F", None]).alias("GENDER"),
        F.when(k % 50 != 0, _birth(k)).alias("BTH_DT"),
        F.col("c_mktsegment").alias("BUS_LINE_CD"),
        F.col("o_orderpriority").alias("PRDCT_CD"),
        F.col("o_orderpriority").alias("PRODUCT"),
        F.col("n_name").alias("STATE"),
        F.expr("o_custkey div 4").cast("string").alias("SBSCR_ID"),
        _case(k % 4, ["18", "01", "19", "20"]).alias("REL_CD"),
        (F.lit(501) + (k * 613) % 99000).cast("string").alias("MBR_ZIP_CD"),
    )


# Products of the request fixture: (product, category, flag, start, end, status).
REQUEST_PRODUCTS = (
    ("NICU", "Clinical", "NICU", "NICU_START", "NICU_END", "NICU_STATUS"),
    ("Maternity", "Clinical", "MATERNITY", "MATERNITY_START", "MATERNITY_END", "MATERNITY_STATUS"),
    ("Kidney", "Specialty", "KIDNEY", "KIDNEY_START", "KIDNEY_END", "KIDNEY_STATUS"),
    ("CAR-T", "Specialty", "CAR-T", "CAR_T_START", "CAR_T_END", "CAR_T_STATUS"),
)
# Client-type labels of the request fixture; a code without a label (9) passes through.
CLIENT_TYPES = {"1": "Kind A", "2": "Kind B", "3": "Kind C", "4": "Kind D", "5": "Kind E", "6": "Kind F", "7": "None", "8": "None"}
STATUSES = ["Not Started", "In Progress", "Waiting", "Complete", "Completed"]


def fx_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide request list: one row per order, product flags and per-product dates."""
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    base = od.join(cu, od.o_custkey == cu.c_custkey)
    o = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    title = (F.when(o % 7 == 0, F.concat(F.col("o_orderpriority"), F.lit(" request")))
             .when(o % 13 == 0, F.lit("[] request"))
             .otherwise(F.concat(F.lit("["), F.col("o_orderpriority"), F.lit("] request"))))
    overall = _case((o / 5).cast("bigint") % 5, STATUSES)
    cols = [
        o.alias("ID"),
        title.alias("TITLE"),
        day.alias("REQUEST_DATE"),
        F.col("c_name").alias("CLIENT"),
        F.col("c_mktsegment").alias("MARKET"),
        F.concat(F.lit("user"), (o % 20).cast("string")).alias("REQUESTOR"),
        (F.lit(1) + o % 9).cast("string").alias("CLIENT_TYPE_DETAIL"),
        overall.alias("OVERALL_STATUS"),
        F.when(o % 3 == 0, F.lit("Listed")).alias("PRODUCTS_REQUESTED"),
        F.when(o % 8 != 0, F.col("o_custkey").cast("string")).alias("SALESFORCE_ID"),
        F.when(o % 9 != 0, _at_hour(_plus_days(day, o % 40), o % 24)).alias("STATUS_CHANGE_DATE"),
        # Text as a list may hold it: US style, ISO, not a date, absent.
        F.when(o % 4 == 0, F.date_format(day, "M/d/yyyy")).when(o % 4 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(o % 4 == 2, "not a date").alias("RECEIVED_DATE"),
        F.when(~overall.isin("Not Started", "In Progress", "Waiting"),
               F.date_add(day, 45)).alias("CLOSED_DATE"),
        F.when(o % 6 == 0, "Y").otherwise("N").alias("PTRR"),
        (o % 2 == 0).alias("NICU"),
        (o % 3 == 0).alias("MATERNITY"),
        (o % 5 == 0).alias("KIDNEY"),
        F.when(o % 11 == 0, F.lit(True)).alias("CAR-T"),
    ]
    for i, (_, _, _, start, end, status) in enumerate(REQUEST_PRODUCTS):
        st = _plus_days(day, (o + i) % 10)
        cols += [_at_hour(st, (o + i) * 7 % 24).alias(start),
                 F.when((o + i) % 4 != 0, _at_hour(_plus_days(st, (o + i) % 30), (o + i) * 5 % 24)).alias(end),
                 _case((o + i) % 5, STATUSES).alias(status)]
    return base.select(*cols)


def fx_initiatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return (cu.filter(F.col("c_custkey") % 2 == 0)
            .select(F.col("c_custkey").cast("string").alias("SALESFORCE_ID"),
                    (F.col("c_acctbal") > 5000).alias("HAS_VALUE")))


def fx_orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, changed, with one column more."""
    return (read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
        .withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("SRC_NOTE", F.lit("v2")))


def fx_upsert(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(target, source) for the key-based merge: every order is in one of them or in both."""
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    target = od.filter(F.col("o_orderkey") % 3 != 0)
    source = fx_orders_v2(spark, sf_dir).filter((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0))
    return target, source


# ---------------------------------------------------------------------------
# Reference tables and crosswalks (config-sized literals, broadcast-safe).
# ---------------------------------------------------------------------------
# Fixed values of the procedure crosswalk fixture: code, desc, specialty,
# include-in-ordering, ASC-eligible.  99283 is absent on purpose.
PROC_XWALK = (
    ("99233", "Subsequent hospital care", "Hospitalist", "Y", "Y"),
    ("99468", "Neonatal critical care", "Neonatology", "Y", "N"),
    ("99479", "Subsequent intensive care", "Neonatology", "Y", "Y"),
    ("99221", "Initial hospital care", "Hospitalist", "N", "N"),
    ("43239", "Upper GI endoscopy biopsy", "Gastroenterology", "Y", "Y"),
    ("0FT44", "Resection of gallbladder", "Surgery", "N", "Y"),
)


def ref_codes_df(spark: SparkSession, codes, name: str = "CODE") -> DataFrame:
    return spark.createDataFrame([(str(x),) for x in codes], f"{name} string")


def ref_flag_table(spark: SparkSession, cfg: ClaimsConfig, flags) -> DataFrame:
    """(CODE, FLAG) rows for several code sets at once."""
    sets = cfg.code_sets()
    rows = [(code, f) for f in flags for code in sets[f]]
    return spark.createDataFrame(rows, "CODE string, FLAG string")


def ref_category_df(spark: SparkSession, pairs, cat: str) -> DataFrame:
    return spark.createDataFrame(list(pairs), f"ICD_CODE string, {cat} string")


def xref_proc(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PROC_XWALK),
        "PROC_CD string, PROC_CD_DESC string, ASGN_SPCLTY string, INCLD_ORDRNG string, ASC_ELIG string")


def xref_cbsa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip -> CBSA crosswalk; zips stored as integers, so joins must pad."""
    cu = read_table(spark, sf_dir, "customer").select("c_custkey")
    z = (F.lit(501) + (F.col("c_custkey") * 613) % 99000).cast("int")
    return (cu.filter(F.col("c_custkey") % 3 != 0)
            .select(z.alias("ELIG_ZIP_CD"))
            .distinct()
            .select("ELIG_ZIP_CD",
                    F.concat(F.lit("C"), (F.col("ELIG_ZIP_CD") % 50).cast("string")).alias("CBSA"),
                    F.concat(F.lit("Area "), (F.col("ELIG_ZIP_CD") % 50).cast("string")).alias("CBSA_NM")))
