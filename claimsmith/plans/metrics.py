"""Run-metrics history: one row per (run, client), checks, trend, compare.

Every source frame is aggregated to one row with its own few expressions;
the one-row frames are put under each other and a last aggregate takes each
column's only value.  No row is widened and no frame is read for a column it
doesn't have.  Ratios of counts and of money use integer arithmetic so the
rounded percentages are exact.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith import config as K
from claimsmith.config import ClaimsConfig, StudyWindow
from claimsmith.operators import classify
from claimsmith.functions.exprs import lit_date
from claimsmith.operators.aggregates import exact_median
from claimsmith.sources import sinks
from claimsmith.sources.sinks import materialize
from claimsmith.plans.episodes import STAY_KEYS, EpisodeRun, NewbornIdent, readmissions, stay_fee_features


def _pct_h(num: Column, den: Column) -> Column:
    """round(num*100/den, 2) half-up for non-negative integers, as double; 0 when den = 0."""
    return F.when(den > 0, ((num * 20000 + den) / (den * 2)).cast("long") / 100.0).otherwise(F.lit(0.0))


def _cents(x: Column) -> Column:
    return (x * 100).cast("long")


def _avg(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


@dataclass(frozen=True)
class RunInfo:
    """What a history row says about its run, given by the caller.

    ``lob_groups`` maps 'medicaid' and 'commercial' to their business lines;
    every other line, or none, is 'other'.  ``weight_labels`` and
    ``age_labels`` map the columns' endings to the category labels in use.
    """

    run_id: str
    client: str
    run_date: dt.date
    etl_timestamp: dt.datetime | None = None
    data_cutoff_date: dt.date | None = None
    lob_groups: dict = field(default_factory=dict)
    weight_labels: dict = field(default_factory=lambda: {
        "normal": "Normal", "low": "Low", "very_low": "Very Low", "extremely_low": "Extremely Low"})
    age_labels: dict = field(default_factory=lambda: {
        "term": "Term", "preterm": "Preterm", "very_preterm": "Very Preterm", "extremely_preterm": "Extremely Preterm"})
    pipeline_version: str | None = None
    data_source_version: str | None = None
    sql_engine: str = "spark"
    processing_duration_seconds: int | None = None
    data_quality_score: float | None = None
    notes: str | None = None
    created_by: str | None = None


def _count(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _money(name: str, when: Column | None = None) -> Column:
    v = F.col(name).cast("decimal(38,2)")
    return F.sum(v if when is None else F.when(when, v))


def _lob(info: RunInfo) -> dict[str, Column]:
    line = F.col("BUS_LINE_CD")
    named = {g: F.coalesce(line.isin(list(v)), F.lit(False)) for g, v in
             ((g, info.lob_groups.get(g, ())) for g in ("medicaid", "commercial"))}
    return named | {"other_lob": ~named["medicaid"] & ~named["commercial"]}


def member_metrics(ps: DataFrame, info: RunInfo) -> list[DataFrame]:
    """Members (two aggregates: by member, then over members) and distinct values."""
    yr, months = F.col("STUDY_YR"), F.col("MEMBER_MONTHS").cast("long")
    each = ps.groupBy("INDV_ID").agg(
        F.max(yr == "Previous").alias("prev"), F.max(yr == "Current").alias("cur"), F.sum(months).alias("mm"),
        F.sum(F.when(yr == "Previous", months)).alias("mm_prev"), F.sum(F.when(yr == "Current", months)).alias("mm_cur"),
        F.max(F.col("GENDER") == "M").alias("g_m"), F.max(F.col("GENDER") == "F").alias("g_f"),
        F.max(F.col("GENDER").isNull()).alias("g_u"), F.max(F.col("BTH_DT").isNull()).alias("no_birth"),
        F.max(F.col("PRDCT_CD").isNull()).alias("no_lob"), *[F.max(v).alias(f"lob_{g}") for g, v in _lob(info).items()])
    c = F.col
    members = each.agg(
        F.count(F.lit(1)).alias("total_members_enrolled"), F.sum("mm").alias("total_member_months"),
        _count(c("prev")).alias("members_previous_period"), _count(c("cur")).alias("members_current_period"),
        F.sum("mm_prev").alias("member_months_previous"), F.sum("mm_cur").alias("member_months_current"),
        _count(c("g_m")).alias("members_by_gender_m"), _count(c("g_f")).alias("members_by_gender_f"),
        _count(c("g_u")).alias("members_by_gender_unknown"), _count(c("no_birth")).alias("members_with_null_birth_date"),
        _count(c("g_u")).alias("members_with_null_gender"), _count(c("no_lob")).alias("members_with_missing_lob"),
        *[_count(c(f"lob_{g}")).alias(f"member_count_{g}") for g in _lob(info)])
    values = ps.agg(F.count_distinct("STATE").alias("unique_states_count"),
                    F.count_distinct("BUS_LINE_CD").alias("unique_business_lines_count"),
                    F.count_distinct("PRDCT_CD").alias("unique_product_codes_count"))
    return [members, values]


def newborn_metrics(run: EpisodeRun, info: RunInfo, cfg: ClaimsConfig) -> list[DataFrame]:
    nb, c = run.ident.newborns, F.col
    main = nb.agg(
        F.count(F.lit(1)).alias("total_newborns_identified"),
        _count(c("STUDY_YR") == "Previous").alias("newborns_previous_period"),
        _count(c("STUDY_YR") == "Current").alias("newborns_current_period"),
        _count(c("BIRTH_TYPE") == "Single").alias("newborns_single_birth"),
        _count(c("BIRTH_TYPE") == "Twin").alias("newborns_twin_birth"),
        _count(c("BIRTH_TYPE") == "Multiple").alias("newborns_multiple_birth"),
        _count(c("BABY_TYPE") == "Normal Newborn").alias("newborns_normal"),
        _count(c("BABY_TYPE") == "NICU").alias("newborns_with_any_nicu"),
        _count(c("STAY_TYPE") == "Short Stay").alias("newborns_short_stay"),
        _count(c("STAY_TYPE") == "Long Stay").alias("newborns_long_stay"),
        _count(F.datediff("ADMIT", "DELIVERY_DT") <= cfg.init_hosp_threshold_days).alias("newborns_admitted_in_init_days"),
        F.sum(c("LOS").cast("long")).alias("total_newborn_los_days"), _money("NET_PD_AMT").alias("_nb_paid"),
        *[_count(v).alias(f"newborns_{g}") for g, v in _lob(info).items()])
    again = readmissions(nb.select(*STAY_KEYS).distinct(), run.hosp, cfg).agg(
        F.count(F.lit(1)).alias("newborns_with_readmission"),
        F.coalesce(F.sum("READMIT"), F.lit(0)).alias("total_readmissions_count"),
        _money("READMIT_PAID_AMT").alias("_readmit_paid"),
        F.coalesce(F.sum("READMIT_LOS"), F.lit(0)).alias("total_readmission_los_days"))
    clipped = nb.join(run.hosp.filter(c("OUT_END_DATE") == 1).select(*STAY_KEYS).distinct(), STAY_KEYS, "left_semi").agg(
        F.count(F.lit(1)).alias("newborns_discharge_clipped"))
    how = run.newborns_pre.agg(*[_count(c(f"HAS_NICU_{k.upper()}") == 1).alias(f"nicu_identified_by_{k}")
                                 for k in ("rev", "msdrg", "aprdrg")])
    return [main, again, clipped, how]


def stay_metrics(run: EpisodeRun) -> list[DataFrame]:
    c = F.col
    hosp = run.hosp.agg(
        F.count(F.lit(1)).alias("total_hospital_episodes"), F.count(F.lit(1)).alias("total_hospital_episodes_created"),
        F.count_distinct("INDV_ID").alias("newborns_with_hospital_stay"), _count(c("LOS") < 1).alias("episodes_with_los_lt_1"),
        F.sum(c("OUT_END_DATE").cast("long")).alias("episodes_discharge_clipped"), F.sum(c("LOS").cast("long")).alias("_hosp_los"),
        _count(F.datediff("ADMIT", "DELIVERY_DT") > 0).alias("episodes_with_admit_gap"))
    lines = run.ident.claim_base.agg(F.count(F.lit(1)).alias("_cb_claims"))
    return [hosp, lines]


def nicu_metrics(run: EpisodeRun, info: RunInfo, cfg: ClaimsConfig, cut) -> list[DataFrame]:
    c = F.col
    nicu = cut(run.nicu_rollup)
    money = {"_nicu_cost": "TOTAL_NICU_COST", "_prof": "ALL_PROFFEE", "_man": "MANAGEABLE_PROFFEE",
             "_crit": "CRITICAL_CARE_PROFFEE", "_fac": "ALL_FACILITY_COST", "_room": "FACILITY_RM_COST", "_nicu_readmit": "READMIT_PAID_AMT"}
    levels = {1: ("170", "171", "172", "173"), 2: ("174", "175"), 3: ("176", "177"), 4: ("178", "179")}
    los = c("LOS").cast("long")
    main = nicu.agg(
        F.count(F.lit(1)).alias("total_nicu_episodes"),
        _count(c("STUDY_YR") == "Previous").alias("nicu_episodes_previous"), _count(c("STUDY_YR") == "Current").alias("nicu_episodes_current"),
        _count(c("BIRTH_TYPE") == "Single").alias("nicu_single_birth"), _count(c("BIRTH_TYPE") == "Twin").alias("nicu_twin_birth"),
        _count(c("BIRTH_TYPE") == "Multiple").alias("nicu_multiple_birth"),
        _count(c("CONTRACT") == "DRG").alias("nicu_drg_contract"), _count(c("CONTRACT") == "Per-Diem").alias("nicu_per_diem_contract"),
        F.count_if(~F.coalesce(c("CONTRACT").isin("DRG", "Per-Diem"), F.lit(False))).alias("nicu_other_contract"),
        F.sum(los).alias("total_nicu_los_days"), F.median(los.cast("double")).alias("median_nicu_los_days"),
        F.max(los).alias("max_nicu_los_days"), F.min(los).alias("min_nicu_los_days"),
        F.max(c("TOTAL_NICU_COST").cast("decimal(38,2)")).cast("double").alias("max_nicu_cost_per_episode"),
        *[_money(v).alias(k) for k, v in money.items()],
        _count(c("REV_LEVELING")).alias("nicu_episodes_with_rev_leveling"),
        *[_count(c("FINAL_REV_CD").isin(*v)).alias(f"nicu_rev_level_{k}") for k, v in levels.items()],
        _count(c("FINAL_REV_CD").isNull()).alias("nicu_rev_unknown"),
        _count(c("READMIT") > 0).alias("nicu_episodes_with_readmit"), F.sum(c("READMIT").cast("long")).alias("total_nicu_readmissions"),
        F.sum(c("READMIT_LOS").cast("long")).alias("total_nicu_readmit_los_days"),
        _count(c("LOW_PAID_NICU")).alias("nicu_low_paid_cases"),
        _money("TOTAL_NICU_COST", c("LOW_PAID_NICU")).cast("double").alias("total_low_paid_nicu_cost"),
        _count(c("INAPPROPRIATE_NICU")).alias("nicu_inappropriate_cases"),
        _money("TOTAL_NICU_COST", c("INAPPROPRIATE_NICU")).cast("double").alias("total_inappropriate_nicu_cost"),
        _count(c("PROVID").isNotNull()).alias("nicu_episodes_with_npi"), _count(c("PROV_TIN").isNotNull()).alias("nicu_episodes_with_tin"),
        _count(c("BW_CAT").isNull()).alias("nicu_birth_weight_unknown"), _count(c("GA_CAT").isNull()).alias("nicu_gest_age_unknown"),
        *[_count(c("BW_CAT") == v).alias(f"nicu_birth_weight_{k}") for k, v in info.weight_labels.items()],
        *[_count(c("GA_CAT") == v).alias(f"nicu_gest_age_{k}") for k, v in info.age_labels.items()])
    providers = nicu.agg(F.count_distinct("PROVID").alias("unique_nicu_providers_npi"),
                         F.count_distinct("PROV_TIN").alias("unique_nicu_providers_tin"),
                         F.count_distinct("PROV_STATE").alias("unique_nicu_provider_states"))
    days = stay_fee_features(run.nicu_claims.claims, cfg).agg(
        F.sum("MANAGEABLE_SVC_DAYS").alias("total_manageable_service_days"),
        F.sum("CRITICAL_CARE_DAYS").alias("total_critical_care_service_days"))
    # Last discharge status per stay, grouped with the pipeline's meaning of the codes (20 = death, 01/06 = home).
    sts = c("LAST_DISCHARGE_STATUS")
    known = F.coalesce(sts.isin(*K.DISCHARGE_STATUS_HOME, K.DISCHARGE_STATUS_DEATH, *K.DISCHARGE_STATUS_TRANSFERS), F.lit(False))
    invalid = classify.discharge_rank_expr("LAST_DISCHARGE_STATUS") == 9
    discharge = run.nicu_claims.last_status.agg(
        _count(sts.isin(*K.DISCHARGE_STATUS_HOME)).alias("nicu_discharge_routine"),
        _count(sts.isin(*K.DISCHARGE_STATUS_TRANSFERS)).alias("nicu_discharge_transfer"),
        _count(sts == K.DISCHARGE_STATUS_DEATH).alias("nicu_discharge_expired"),
        _count(~known & ~invalid).alias("nicu_discharge_other"), _count(~known & invalid).alias("nicu_discharge_invalid"))
    # Money median: exact and distributed (see exact_median).
    median = exact_median(nicu.select((c("TOTAL_NICU_COST") * 100).cast("bigint").alias("_c")), [], "_c", "_m").select(
        (c("_m") / 100.0).alias("median_nicu_cost_per_episode"))
    return [main, providers, days, discharge, median]


def claim_metrics(tagged: DataFrame, cfg: ClaimsConfig) -> list[DataFrame]:
    c = F.col
    return [tagged.agg(
        F.count(F.lit(1)).alias("total_claims_processed"),
        _count(c("CLAIM_TYPE") == "IP").alias("total_ip_claims"), _count(c("CLAIM_TYPE") == "OP").alias("total_op_claims"),
        _count(c("NET_PD_AMT") > cfg.high_cost_threshold).alias("claims_excluded_high_cost"),
        _count(c("DIAG_1_CD").isNull()).alias("claims_with_null_diagnosis"),
        *[_count(c(f.upper())).alias(f"claims_matched_{f}") for f in ("newborn_icd", "newborn_rev", "nicu_rev", "nicu_msdrg", "nicu_aprdrg")])]


def run_metrics(run: EpisodeRun, ps_membership: DataFrame, w: StudyWindow, cfg: ClaimsConfig, info: RunInfo, cut=None) -> DataFrame:
    """One history row with every declared metric.

    ``cut`` stores the frames that are read several times (default: the
    shared checkpoint folder)."""
    cut = cut or materialize
    parts = [*member_metrics(cut(ps_membership), info), *newborn_metrics(run, info, cfg), *stay_metrics(run),
             *nicu_metrics(run, info, cfg, cut), *claim_metrics(run.tagged, cfg)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = rows.agg(*[F.max(x).alias(x) for x in rows.columns])
    C = F.col
    text = lambda v: F.lit(v).cast("string")
    episodes, newborns, stays = C("total_nicu_episodes"), C("total_newborns_identified"), C("total_hospital_episodes")
    out = row.select(
        text(info.run_id).alias("run_id"), F.lit(info.run_date).cast("date").alias("run_date"), text(info.client).alias("client_name"),
        F.lit(info.etl_timestamp).cast("timestamp").alias("etl_timestamp"),
        lit_date(w.start).alias("birth_window_start"), lit_date(w.mid).alias("birth_window_mid"),
        lit_date(w.end).alias("birth_window_end"), lit_date(w.runout_end).alias("runout_end_date"),
        F.lit(info.data_cutoff_date).cast("date").alias("data_cutoff_date"),
        *[C(x) for x in rows.columns],
        _avg(C("total_member_months"), C("total_members_enrolled")).alias("avg_member_months_per_member"),
        _pct_h(episodes, newborns).alias("nicu_rate_pct"),
        _pct_h(C("newborns_admitted_in_init_days"), newborns).alias("pct_admitted_in_init_days"),
        C("_nb_paid").cast("double").alias("total_newborn_paid_amt"), _avg(C("_nb_paid"), newborns).alias("avg_newborn_paid_amt"),
        _avg(C("total_newborn_los_days"), newborns).alias("avg_newborn_los_days"), _avg(stays, newborns).alias("avg_episodes_per_newborn"),
        C("_readmit_paid").cast("double").alias("total_readmission_paid_amt"),
        _avg(C("_readmit_paid"), C("total_readmissions_count")).alias("avg_readmission_paid_amt"),
        _pct_h(C("episodes_discharge_clipped"), stays).alias("pct_episodes_discharge_clipped"),
        _avg(C("_hosp_los"), stays).alias("avg_los_all_episodes"), _avg(C("_cb_claims"), stays).alias("avg_claims_per_episode"),
        _avg(C("total_nicu_los_days"), episodes).alias("avg_nicu_los_days"),
        C("_nicu_cost").cast("double").alias("total_nicu_cost"), _avg(C("_nicu_cost"), episodes).alias("avg_nicu_cost_per_episode"),
        _avg(C("_nicu_cost"), C("total_nicu_los_days")).alias("avg_nicu_cost_per_day"),
        C("_prof").cast("double").alias("total_professional_fees"), _avg(C("_prof"), episodes).alias("avg_professional_fees"),
        _pct_h(_cents(C("_prof")), _cents(C("_nicu_cost"))).alias("pct_professional_fees"),
        C("_man").cast("double").alias("total_manageable_proffee"), _avg(C("_man"), episodes).alias("avg_manageable_proffee"),
        C("_crit").cast("double").alias("total_critical_care_proffee"), _avg(C("_crit"), episodes).alias("avg_critical_care_proffee"),
        C("_fac").cast("double").alias("total_facility_cost"), _avg(C("_fac"), episodes).alias("avg_facility_cost"),
        _pct_h(_cents(C("_fac")), _cents(C("_nicu_cost"))).alias("pct_facility_cost"),
        C("_room").cast("double").alias("total_facility_room_cost"), _avg(C("_room"), episodes).alias("avg_facility_room_cost"),
        _pct_h(_cents(C("_room")), _cents(C("_fac"))).alias("pct_room_of_facility"),
        _pct_h(C("nicu_episodes_with_rev_leveling"), episodes).alias("pct_episodes_with_rev_leveling"),
        C("_nicu_readmit").cast("double").alias("total_nicu_readmit_paid_amt"),
        _avg(C("_nicu_readmit"), C("total_nicu_readmissions")).alias("avg_nicu_readmit_paid_amt"),
        _pct_h(C("nicu_episodes_with_npi"), episodes).alias("pct_nicu_episodes_with_provider"),
        _pct_h(C("nicu_low_paid_cases"), episodes).alias("pct_nicu_low_paid"),
        _pct_h(C("nicu_inappropriate_cases"), episodes).alias("pct_nicu_inappropriate"),
        _pct_h(C("claims_with_null_diagnosis"), C("total_claims_processed")).alias("pct_claims_null_diagnosis"),
        _pct_h(C("newborns_previous_period"), newborns).alias("pct_previous_period"),
        _pct_h(C("newborns_current_period"), newborns).alias("pct_current_period"),
        F.lit(cfg.config_hash()).alias("config_hash"), text(info.pipeline_version).alias("pipeline_version"),
        text(info.data_source_version).alias("data_source_version"), text(info.sql_engine).alias("sql_engine"),
        F.lit(info.processing_duration_seconds).cast("long").alias("processing_duration_seconds"),
        F.lit(info.data_quality_score).cast("double").alias("data_quality_score"), text(info.notes).alias("notes"),
        text(info.created_by).alias("created_by"))
    return out.drop(*[x for x in out.columns if x.startswith("_")])


def run_summary(ident: NewbornIdent) -> DataFrame:
    """One row: NICU and all newborns, NICU cost and days, averages and rate (0 where there is none)."""
    nicu = ident.nicu_ident.agg(F.count(F.lit(1)).alias("TOTAL_NICU"), F.sum("TOTAL_NICU_COST").alias("TOTAL_COST"),
                                F.sum(F.col("LOS").cast("long")).alias("TOTAL_LOS"))
    born = ident.newborns.agg(F.count(F.lit(1)).alias("TOTAL_NEWBORNS"))
    rows = nicu.unionByName(born, allowMissingColumns=True)
    one = rows.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("TOTAL_NICU", "TOTAL_NEWBORNS", "TOTAL_COST", "TOTAL_LOS")])
    n = F.col("TOTAL_NICU")
    mean = lambda c: F.when(n > 0, F.col(c).cast("double") / n).otherwise(0.0)
    return one.select("*", mean("TOTAL_COST").alias("AVG_NICU_COST"), mean("TOTAL_LOS").alias("AVG_LOS"),
                      _pct_h(n, F.col("TOTAL_NEWBORNS")).alias("NICU_RATE_PCT"))


def metrics_checks(history: DataFrame) -> DataFrame:
    """Rows violating the table constraints (percent range, unique key)."""
    bad_pct = ~(F.col("nicu_rate_pct").between(0, 100) & F.col("pct_professional_fees").between(0, 100)
                & F.col("pct_facility_cost").between(0, 100))
    dup = (history.groupBy("run_id", "client_name").agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).select("run_id", "client_name", F.lit("DUPLICATE_KEY").alias("violation")))
    rng = history.filter(bad_pct).select("run_id", "client_name", F.lit("PERCENT_RANGE").alias("violation"))
    return rng.unionByName(dup)


def period_compare(history: DataFrame) -> DataFrame:
    """Previous/Current rows per run with a guarded NICU rate."""
    def part(label, nb, nicu):
        return history.select("run_id", "client_name", F.lit(label).alias("period"),
                              F.col(nb).alias("newborns"), F.col(nicu).alias("nicu_episodes"),
                              _pct_h(F.col(nicu), F.col(nb)).alias("nicu_rate_pct"))
    return (part("Previous Period", "newborns_previous_period", "nicu_episodes_previous")
            .unionByName(part("Current Period", "newborns_current_period", "nicu_episodes_current")))


def trend_query(history: DataFrame, client: str) -> DataFrame:
    return (history.filter(F.col("client_name") == client)
            .select("client_name", "run_date", "birth_window_start", "birth_window_end",
                    "total_newborns_identified", "total_nicu_episodes", "nicu_rate_pct",
                    "avg_nicu_cost_per_episode", "avg_nicu_los_days", "pct_nicu_inappropriate", "pct_nicu_low_paid")
            .orderBy(F.col("run_date").desc()))


def history_violations(history: DataFrame) -> DataFrame:
    """Rows that the history's constraints refuse: no key, or a percentage out of range."""
    keyless = history.filter(F.col("run_id").isNull() | F.col("client_name").isNull())
    return (metrics_checks(history).select("run_id", "client_name", "violation")
            .unionByName(keyless.select("run_id", "client_name", F.lit("NULL_KEY").alias("violation"))))


def write_history(row: DataFrame, history_path: str) -> None:
    """Add a run's row to the history under its key (run, client): the same run again replaces its row.

    The row is checked against the constraints first; a violating one is refused
    and the history stays as it is.  Each key has a folder of its own, which an
    overwrite of partitions replaces as a whole."""
    held: list[str] = []
    row = sinks.materialize(row, stored=held)
    try:
        bad = [r.violation for r in history_violations(row).select("violation").distinct().collect()]
        if bad:
            raise ValueError(f"history row refused: {', '.join(sorted(bad))}")
        key = F.sha2(F.concat_ws("\x00", "run_id", "client_name"), 256)
        (row.withColumn("history_key", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("history_key").parquet(history_path))
    finally:
        sinks.drop_stored(row.sparkSession, held)


def metrics_job(run: EpisodeRun, ps_membership: DataFrame, w: StudyWindow, cfg: ClaimsConfig, info: RunInfo,
                history_path: str) -> dict[str, DataFrame]:
    """Write the run's row into the history, and return history, checks, trend and period comparison over it."""
    spark = ps_membership.sparkSession
    write_history(run_metrics(run, ps_membership, w, cfg, info), history_path)
    history = spark.read.parquet(history_path).drop("history_key")
    return {"history": history, "checks": metrics_checks(history), "trend": trend_query(history, info.client),
            "compare": period_compare(history)}
