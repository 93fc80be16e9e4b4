"""Row classification: first-match CASE chains over code columns.

All rules are plain ``when`` chains (JVM-side, no UDF).  Null inputs fall
through to the next rule exactly as SQL three-valued logic does.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith import config as K
from claimsmith.functions.exprs import c, code_between, lit_date


def _any(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def claim_type_expr(pos="PL_OF_SRVC_CD", rev="RVNU_CD", proc="PROC_CD", drg="DRG") -> Column:
    """IP / ER / OP (first match wins; string ranges compare lexicographically)."""
    ip = _any([c(pos) == K.POS_INPATIENT,
               code_between(rev, *K.IP_REVENUE_RANGE),
               c(rev) == K.IP_REVENUE_EXTRA]
              + [code_between(proc, lo, hi) for lo, hi in K.IP_PROC_RANGES]
              + [c(drg).isNotNull()])
    er = _any([c(pos) == K.POS_EMERGENCY,
               c(proc).isin(list(K.ER_PROC_CODES)),
               c(rev).startswith(K.ER_REVENUE_PREFIX),
               c(rev) == K.ER_REVENUE_EXTRA])
    return F.when(ip, "IP").when(er, "ER").otherwise("OP")


def claim_type(df: DataFrame, out: str = "CLAIM_TYPE", **cols) -> DataFrame:
    return df.withColumn(out, claim_type_expr(**cols))


def _numeric_code_in(proc: Column, lo: int, hi: int) -> Column:
    n = proc.try_cast("int")
    return proc.rlike(r"^\d+$") & (n >= lo) & (n <= hi)


def provider_category_expr(rev="RVNU_CD", pos="PL_OF_SRVC_CD", proc="PROC_CD") -> Column:
    """Facility / Professional / Unknown.

    Revenue patterns are prefix matches (the evident intent of ``^(..)``);
    numeric procedure ranges use try_cast so non-numeric codes never raise.
    """
    r, p, pr = c(rev), c(pos), c(proc)
    e = (F.when(r.rlike(K.FACILITY_REV_PATTERN), "Facility")
         .when(r.rlike(K.PROFESSIONAL_REV_PATTERN), "Professional")
         .when(p.isin(list(K.FACILITY_POS)), "Facility")
         .when(p.isin(list(K.PROFESSIONAL_POS)), "Professional"))
    for lo, hi in K.PROFESSIONAL_PROC_RANGES:
        e = e.when(_numeric_code_in(pr, lo, hi), "Professional")
    for lo, hi in K.FACILITY_PROC_RANGES:
        e = e.when(_numeric_code_in(pr, lo, hi), "Facility")
    return e.otherwise("Unknown")


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Recode by dictionary; values without a mapping are kept."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.col(col).cast("string")
    return df.withColumn(out or col, F.coalesce(F.try_element_at(m, v), v))


def fill_flags(df: DataFrame, flags) -> DataFrame:
    """Null booleans -> false, for those flag columns that exist."""
    present = [f for f in flags if f in df.columns]
    return df.withColumns({f: F.coalesce(F.col(f"`{f}`"), F.lit(False)) for f in present})


def flag_list_text(df: DataFrame, flags, text_col: str = "PRODUCTS_REQUESTED") -> DataFrame:
    """Where text is null: title-cased names of true flags joined by ', ', else 'None'."""
    present = [f for f in flags if f in df.columns]
    if text_col not in df.columns or not present:
        return df
    names = F.array(*[F.when(F.col(f"`{f}`"), F.lit(f.title())) for f in present])
    joined = F.array_join(F.filter(names, lambda x: x.isNotNull()), ", ")
    filled = F.when(joined == "", F.lit("None")).otherwise(joined)
    return df.withColumn(text_col, F.coalesce(F.col(text_col), filled))


def high_cost_flag(df: DataFrame, amount: str = "NET_PD_AMT",
                   threshold: int = K.HIGH_COST_CLAIM_THRESHOLD, out: str = "HIGH_COST") -> DataFrame:
    return df.withColumn(out, F.col(amount) > F.lit(threshold))


def drop_flagged(df: DataFrame, flag: str = "HIGH_COST") -> DataFrame:
    """Keep rows whose flag is false (null flag -> dropped, as ~null is null)."""
    return df.filter(~F.col(flag)) if flag in df.columns else df


def stay_type_flags(df: DataFrame, window_start: dt.date, window_mid: dt.date,
                    long_stay: int = K.LONG_STAY_THRESHOLD,
                    init_days: int = K.INIT_HOSP_THRESHOLD_DAYS,
                    readmit_days: int = K.READMIT_THRESHOLD_DAYS) -> DataFrame:
    """STAY_TYPE, IN_DAYS, STUDY_YR, ADMIT_GAP; keep gap < readmit_days and IN_DAYS."""
    return (df.withColumns({
        "STAY_TYPE": F.when(F.col("LOS") >= long_stay, "Long Stay").otherwise("Short Stay"),
        "IN_DAYS": F.col("ADMIT") <= F.date_add("DELIVERY_DT", init_days),
        "STUDY_YR": F.when((F.col("DELIVERY_DT") >= lit_date(window_start))
                           & (F.col("DELIVERY_DT") < lit_date(window_mid)), "Previous")
                     .otherwise("Current"),
        "ADMIT_GAP": F.datediff("ADMIT", "DELIVERY_DT"),
    }).filter((F.col("ADMIT_GAP") < readmit_days) & F.col("IN_DAYS")))


def cost_flags(df: DataFrame, cfg: K.ClaimsConfig | None = None) -> DataFrame:
    """Zero-fill measures, ALL_FACILITY_COST, LOW_PAID_NICU, INAPPROPRIATE_NICU.

    INAPPROPRIATE_NICU keeps SQL null semantics: null FINAL_REV_CD with the
    other terms true gives null, not false.
    """
    cfg = cfg or K.ClaimsConfig()
    zero = {m: F.coalesce(F.col(m), F.lit(0)) for m in
            ("ALL_PROFFEE", "MANAGEABLE_PROFFEE", "CRITICAL_CARE_PROFFEE",
             "FACILITY_RM_COST", "TOTAL_NICU_COST", "LOS") if m in df.columns}
    out = df.withColumns(zero)
    return out.withColumns({
        "ALL_FACILITY_COST": F.col("TOTAL_NICU_COST") - F.col("ALL_PROFFEE"),
        "LOW_PAID_NICU": F.when((F.col("LOS") > 0)
                                & ((F.col("TOTAL_NICU_COST") / F.col("LOS")) < cfg.low_cost_per_day),
                                F.lit(True)).otherwise(F.lit(False)),
        "INAPPROPRIATE_NICU": (F.col("CONTRACT") == "DRG")
                              & (F.col("LOS") <= cfg.inappropriate_max_los)
                              & F.col("FINAL_REV_CD").isin("170", "171"),
    })


def cost_per_day_expr(amount: str = "NET_PD_AMT", los: str = "LOS") -> Column:
    return F.when(F.col(los) > 0, F.col(amount).cast("double") / F.col(los))


def discharge_rank_expr(status: str = "DSCHRG_STS") -> Column:
    """Discharge status -> priority 0 (death) .. 4 (home), 6 (other known), 9."""
    # The ranges of other known codes.
    s = F.col(status)
    other = _any([F.length(s) < 2, s.isin(list(K.DISCHARGE_STATUS_EXCLUDED))]
                 + [s.between(lo, hi) for lo, hi in
                    (("08", "19"), ("21", "29"), ("31", "39"), ("44", "49"),
                     ("52", "60"), ("67", "69"), ("71", "99"))])
    return (F.when(s == K.DISCHARGE_STATUS_DEATH, 0)
            .when(s == K.DISCHARGE_STATUS_AMA, 1)
            .when(s.isin(list(K.DISCHARGE_STATUS_TRANSFERS)), 2)
            .when(s == K.DISCHARGE_STATUS_SNF, 3)
            .when(s.isin(list(K.DISCHARGE_STATUS_HOME)), 4)
            .when(other, 6)
            .otherwise(9))


def birth_type_label(pri: Column) -> Column:
    return (F.when(pri == 3, "Multiple").when(pri == 2, "Twin")
            .when(pri == 1, "Single").otherwise("Unknown"))


def birth_type_priority(label: Column) -> Column:
    return (F.when(label == "Multiple", 3).when(label == "Twin", 2)
            .when(label == "Single", 1).otherwise(0))


def baby_type_label(any_nicu: Column) -> Column:
    return F.when(any_nicu, "NICU").otherwise("Normal Newborn")


def contract_label(any_drg: Column) -> Column:
    return F.when(any_drg, "DRG").otherwise("Per-Diem")


def split_professional_facility(df: DataFrame, cat: str = "PROV_CAT",
                                ordering: str = "INCLUDE_IN_ORDERING") -> DataFrame:
    """Tag each line as PROFESSIONAL / RANKABLE facility / NOT_RANKED facility.

    'Unknown' counts as facility; the ordering flag 'Y' ranks, any other
    non-null value does not, null is in neither group.
    """
    return df.withColumn(
        "LINE_GROUP",
        F.when(F.col(cat) == "Professional", "PROFESSIONAL")
         .when(F.col(ordering) == "Y", "RANKABLE")
         .when(F.col(ordering) != "Y", "NOT_RANKED"))
