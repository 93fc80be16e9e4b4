"""Outpatient site-of-service events: pull, event ids, ranked roll-up.

An event is a member's service day.  Facility lines that take part in the
ordering are ranked by amount inside their event; the roll-up needs only
the top three ranks plus per-event totals, so ranking keeps three
candidates per (event, salt) bucket and then per event - a hot event is
never sorted in one task.  All bucket sums come from one aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith import config as K
from claimsmith.config import ClaimsConfig
from claimsmith.functions.exprs import event_id, lit_date
from claimsmith.operators import classify
from claimsmith.operators.windows import rank_all, top_k_salted
from claimsmith.sources.sinks import materialize

EVENT = "OUTPATIENT_EVENT_ID"


def sos_data_pull(claims: DataFrame, members: DataFrame, xref: DataFrame,
                  start: dt.date, end: dt.date) -> DataFrame:
    """Claims in the study period at outpatient places of service, with the
    member attributes and procedure crosswalk, and a provider category."""
    clm = claims.filter((F.col("SRVC_FROM_DT") >= lit_date(start)) & (F.col("LST_SRVC_DT") <= lit_date(end))
                        & F.col("PL_OF_SRVC_CD").isin(list(K.SOS_PLACES_OF_SERVICE))).select(
        "INDV_ID", "LINE_KEY", "PROCESS_DT", "PL_OF_SRVC_CD", "BILL_TYPE", "SRVC_FROM_DT", "PROC_CD", "RVNU_CD",
        "PROV_NPI", "PROV_FULL_NM", "PROV_STATE", "PROV_ZIP_CD", "COV_AMT", "ALLW_AMT")
    mem = members.select(F.col("INDV_ID").alias("_M_ID"), "BUS_LINE_CD", "REL_CD", "BTH_DT", "GENDER",
                         "SBSCR_ID", F.substring("MBR_ZIP_CD", 1, 5).alias("MBR_ZIP_CD"),
                         F.col("STATE").alias("MBR_STATE"))
    # No hint: Spark broadcasts the crosswalk where its measured size allows.
    xr = xref.select(F.col("PROC_CD").alias("_X_PROC"), "PROC_CD_DESC",
                                 F.col("ASGN_SPCLTY").alias("PROCEDURE_SPECIALTY"),
                                 F.col("INCLD_ORDRNG").alias("INCLUDE_IN_ORDERING"),
                                 F.col("ASC_ELIG").alias("ELIGIBLE"))
    j = (clm.join(mem, clm["INDV_ID"] == mem["_M_ID"], "left")
         .join(xr, clm["PROC_CD"] == xr["_X_PROC"], "left"))
    return j.select(
        "INDV_ID", "LINE_KEY", "BUS_LINE_CD", "REL_CD", "BTH_DT", "GENDER", "SBSCR_ID", "MBR_ZIP_CD", "MBR_STATE",
        "PROCESS_DT", "PL_OF_SRVC_CD", "BILL_TYPE", "SRVC_FROM_DT", "PROC_CD", "PROC_CD_DESC",
        "PROCEDURE_SPECIALTY", "INCLUDE_IN_ORDERING", "ELIGIBLE", "RVNU_CD", "PROV_NPI", "PROV_FULL_NM",
        "PROV_STATE", F.substring("PROV_ZIP_CD", 1, 5).alias("PROV_ZIP_CD"), "COV_AMT", "ALLW_AMT",
        classify.provider_category_expr().alias("PROV_CAT"))


def sos_event_id(pull: DataFrame) -> DataFrame:
    return pull.withColumn(EVENT, event_id("INDV_ID", "SRVC_FROM_DT"))


def rankable_lines(lines: DataFrame, amt: str) -> DataFrame:
    """Facility lines that take part in the ordering, with a non-zero amount."""
    return classify.split_professional_facility(lines).filter(
        (F.col("LINE_GROUP") == "RANKABLE") & (F.col(amt) != 0))


def ranked_lines(lines: DataFrame, amt: str, cut=None) -> DataFrame:
    """Every rankable line with its rank by amount inside its event."""
    return rank_all(rankable_lines(lines, amt), EVENT, amt, "LINE_KEY", cut=cut)


def ranked_top3(lines: DataFrame, amt: str, cfg: ClaimsConfig) -> DataFrame:
    """Ranks 1..3 per event, all that the roll-up needs beside event totals."""
    return top_k_salted(rankable_lines(lines, amt), EVENT, amt, "LINE_KEY", 3, cfg.rank_salt_buckets)


def event_buckets(lines: DataFrame, amt: str, cfg: ClaimsConfig, top: DataFrame | None = None) -> DataFrame:
    """Per-event sums: not-in-ranking, not-eligible, secondary, tertiary,
    all-other eligible.

    Two per-event aggregates joined per event - never a line-level join:
    totals over all lines (one pass), and sums over the at most three ranked
    rows per event; all-other = eligible total - eligible amounts ranked 1-3.
    """
    g = classify.split_professional_facility(lines)
    a = F.col(amt)
    rankable = (F.col("LINE_GROUP") == "RANKABLE") & (a != 0)
    elig = rankable & (F.col("ELIGIBLE") == "Y")
    totals = g.groupBy(EVENT).agg(
        F.sum(F.when(F.col("LINE_GROUP") == "NOT_RANKED", a)).alias("COVERED_NOT_IN_RANKING"),
        F.sum(F.when(rankable & (F.col("ELIGIBLE") != "Y"), a)).alias("NOT_ELIGIBLE_COVERED_AMT"),
        F.sum(F.when(elig, a)).alias("_ELIG_TOTAL"),
        F.count_if(elig).alias("_N_ELIG"))
    top = ranked_top3(lines, amt, cfg) if top is None else top
    te = F.col("ELIGIBLE") == "Y"
    top_sums = top.groupBy(EVENT).agg(
        F.sum(F.when(te & (F.col("RANK") == 2), a)).alias("SECONDARY_COVERED_AMT"),
        F.sum(F.when(te & (F.col("RANK") == 3), a)).alias("TERTIARY_COVERED_AMT"),
        F.sum(F.when(te, a)).alias("_ELIG_TOP"),
        F.count_if(te).alias("_N_ELIG_TOP"),
        F.count_if(te & (F.col("RANK") == 1)).alias("_HAS_PRIMARY"))
    j = totals.join(top_sums, EVENT, "left")
    n_other = F.col("_N_ELIG") - F.coalesce(F.col("_N_ELIG_TOP"), F.lit(0))
    other = F.when(n_other > 0, F.col("_ELIG_TOTAL") - F.coalesce(F.col("_ELIG_TOP"), F.lit(0)))
    return j.select(EVENT, "COVERED_NOT_IN_RANKING", "NOT_ELIGIBLE_COVERED_AMT", "SECONDARY_COVERED_AMT",
                    "TERTIARY_COVERED_AMT", other.cast(j.schema["_ELIG_TOTAL"].dataType).alias("ALLOTH_COVERED_AMT"),
                    F.coalesce(F.col("_HAS_PRIMARY"), F.lit(0)).alias("_HAS_PRIMARY"))


def primary_lines(lines: DataFrame, amt: str, cfg: ClaimsConfig, top: DataFrame | None = None) -> DataFrame:
    """Eligible lines ranked first in their event (event dropped otherwise)."""
    top = ranked_top3(lines, amt, cfg) if top is None else top
    return top.filter((F.col("RANK") == 1) & (F.col("ELIGIBLE") == "Y")).drop("RANK")


# The roll-up's output columns.
ROLLUP_DIMS = ["BUS_LINE_CD", EVENT, "CBSA", "CBSA_NM", "SBSCR_ID", "REL_CD", "INDV_ID", "GENDER", "MBR_STATE",
               "MBR_ZIP_CD", "PROCESS_DT", "PL_OF_SRVC_CD", "BILL_TYPE", "SRVC_FROM_DT", "PROC_CD", "PROC_CD_DESC",
               "PROCEDURE_SPECIALTY", "INCLUDE_IN_ORDERING", "ELIGIBLE", "PROV_NPI", "PROV_FULL_NM",
               "PROV_STATE", "PROV_ZIP_CD", "PROV_CAT"]


def sos_rollup(lines: DataFrame, cbsa: DataFrame, amt: str, cfg: ClaimsConfig, cut=None) -> DataFrame:
    """Episode roll-up: primary line dims + CBSA, bucket sums, total covered.

    ``cut`` stores the top lines, which the primary lines and the buckets share."""
    top = (cut or materialize)(ranked_top3(lines, amt, cfg))
    prim = primary_lines(lines, amt, cfg, top).withColumn("_ZIP5", F.lpad(F.col("MBR_ZIP_CD").cast("string"), 5, "0"))
    buckets = event_buckets(lines, amt, cfg, top).drop("_HAS_PRIMARY")
    xc = cbsa.select(F.lpad(F.col("ELIG_ZIP_CD").cast("string"), 5, "0").alias("_XZIP"), "CBSA", "CBSA_NM")
    base = (prim.join(buckets, EVENT, "left")
            .join(xc, F.col("_ZIP5") == F.col("_XZIP"), "left"))
    parts = ["SECONDARY_COVERED_AMT", "TERTIARY_COVERED_AMT", "ALLOTH_COVERED_AMT",
             "NOT_ELIGIBLE_COVERED_AMT", "COVERED_NOT_IN_RANKING"]
    covered = F.coalesce(F.col(amt), F.lit(0))
    for p in parts:
        covered = covered + F.coalesce(F.col(p), F.lit(0))
    dims = [d for d in ROLLUP_DIMS + [amt] if d in base.columns]
    dims = list(dict.fromkeys(dims))
    return (base.select(*dims, F.col(amt).alias("PRIMARY_COVERED_AMT"), *parts, covered.alias("EPISODE_COVERED"))
            .groupBy(*dims)
            .agg(F.count_distinct(EVENT).alias("VOLUME"),
                 F.sum("PRIMARY_COVERED_AMT").alias("PRIMARY_COVERED_AMT"),
                 *[F.sum(p).alias(p) for p in parts],
                 F.sum("EPISODE_COVERED").alias("EPISODE_COVERED")))
