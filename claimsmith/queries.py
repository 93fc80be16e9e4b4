"""Query registry: one callable per operator key, ``(spark, sf_dir) -> DataFrame``.

Each query runs its operator over the claims-shaped views of the given
tables (``sources.fixtures``), so its work grows with the input.  Outputs
are normalised (exact decimals -> double after summation, small integers ->
bigint) so they compare cleanly with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith import config as K
from claimsmith.config import FIXTURE_AS_OF, FIXTURE_WINDOW, ClaimsConfig
from claimsmith.functions import exprs as X
from claimsmith.operators import classify, codes
from claimsmith.operators.joins import join_trimmed
from claimsmith.operators.periods import (
    by_study_year, enrollment_periods, latest_demographics, membership_latest, membership_periods, study_window,
    study_window_frame, usable_months, with_overlaps,
)
from claimsmith.operators.windows import latest_per_key
from claimsmith.plans import episodes as EP
from claimsmith.plans import metrics as M
from claimsmith.plans import profile as P
from claimsmith.plans import request_job as RJ
from claimsmith.plans import requests as R
from claimsmith.plans import sos as S
from claimsmith.plans import states as ST
from claimsmith.session import compile_wide_rows, ensure_checkpoint_dir, scratch_dir
from claimsmith.sources import fixtures as FX
from claimsmith.sources import layout as LO
from claimsmith.sources import sinks as SK
from claimsmith.sources import tables as TB

CFG = ClaimsConfig()
W = FIXTURE_WINDOW
AMT = "ALLW_AMT"
RUN_INFO = M.RunInfo("run-0001", "DEMO", FIXTURE_AS_OF, dt.datetime(2001, 12, 31, 6), W.runout_end,
                     {"medicaid": ("AUTOMOBILE",), "commercial": ("BUILDING", "FURNITURE")},
                     pipeline_version="2", data_source_version="fixtures", created_by="claimsmith")
REQUEST_FLAGS = [p[2] for p in FX.REQUEST_PRODUCTS]


def normalize(df: DataFrame) -> DataFrame:
    """Decimals -> double, byte/short/int -> bigint (output types only)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Ctx:
    """Lazily built inputs and intermediate plans for one query call."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        self.spark, self.sf = spark, sf_dir
        ensure_checkpoint_dir(spark)
        compile_wide_rows(spark)
        self.cut = SK.materialize if materialize else None

    @cached_property
    def claims(self):
        return FX.fx_claims(self.spark, self.sf)

    @cached_property
    def members(self):
        return FX.fx_membership(self.spark, self.sf)

    @cached_property
    def requests(self):
        return FX.fx_requests(self.spark, self.sf)

    @cached_property
    def initiatives(self):
        return FX.fx_initiatives(self.spark, self.sf)

    @cached_property
    def ps(self):
        return membership_periods(self.members, W, "DEMO")

    @cached_property
    def run(self) -> EP.EpisodeRun:
        return EP.newborn_episodes(self.claims, self.ps, W, CFG, materialize=self.cut)

    @cached_property
    def windowed(self):
        return EP.filter_study_window(self.claims, W)

    @cached_property
    def claims1(self):
        """Cohort claims projected and joined to eligibility (pre flags)."""
        cohort = codes.cohort_keys(self.windowed, CFG)
        c0 = EP.project_claims(codes.cohort_semi_join(self.windowed, cohort))
        return classify.claim_type(EP.merge_eligibility(c0, EP.elig_latest(self.ps)))

    @cached_property
    def sos_period(self):
        """The twelve months that the claims themselves give."""
        row = study_window_frame(self.claims, 12, 3).first()
        return row["WINDOW_START"], row["WINDOW_END"]

    @cached_property
    def sos_lines(self):
        start, end = self.sos_period
        mem = membership_latest(self.members, start, end, "DEMO")
        pull = S.sos_event_id(S.sos_data_pull(self.claims, mem, FX.xref_proc(self.spark), start, end))
        return self.cut(pull) if self.cut else pull  # read once per branch of the roll-up

    @cached_property
    def products(self):
        return R.transform_products(self.requests, self.initiatives, FX.REQUEST_PRODUCTS, FIXTURE_AS_OF,
                                    FX.CLIENT_TYPES)

    @cached_property
    def claims_profile(self):
        return P.profile_table(self.claims, P.CLAIMS_EXPECTED, "FA_MEDICAL")

    @cached_property
    def code_freq(self):
        return P.code_frequency(self.claims, CFG)

    @cached_property
    def history(self):
        return SK.materialize(M.run_metrics(self.run, self.ps, W, CFG, RUN_INFO))  # one row


def _stay_intervals(ctx: Ctx) -> DataFrame:
    """The job's own intervals, each with its first line's stay number, by the scan for hot members."""
    return EP.stay_intervals(ctx.run.newborn_claims, CFG, spread=True)


def _write_read(ctx: Ctx, df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    path = scratch_dir(ctx.spark, name)
    if fmt == "parquet":
        SK.sink_overwrite(df, path)
        return ctx.spark.read.parquet(path)
    SK.export_report(df, path, fmt)
    if fmt == "json":
        return ctx.spark.read.schema(df.schema).json(path)
    return ctx.spark.read.csv(path, header=True, inferSchema=True)


# ---------------------------------------------------------------------------
# Query functions, grouped as in SURVEY section 2.
# ---------------------------------------------------------------------------
def q_scan_table(ctx):
    name = K.table_name("medical", CFG)
    ctx.claims.createOrReplaceTempView(name)
    return TB.scan_table(ctx.spark, "medical", CFG).select("INDV_ID", "CLM_AUD_NBR", "LINE_KEY", "SRVC_FROM_DT",
                                                          "NET_PD_AMT")


def q_scan_sql_bounds(ctx):
    return TB.scan_sql_bounds(ctx.claims)


def q_scan_csv_upper(ctx):
    src = ctx.requests.select(F.col("ID").alias("id"), F.col("TITLE").alias("title"),
                              F.col("REQUEST_DATE").alias("request_date"), F.col("CLIENT").alias("client"))
    path = scratch_dir(ctx.spark, "csv_in")
    src.write.option("header", True).csv(path)
    return TB.scan_csv_upper(ctx.spark, path)


def q_scan_optional(ctx):
    src = ctx.requests.select(
        "ID", F.when(F.col("ID") % 10 == 0, F.lit("not a date"))
        .when(F.col("ID") % 10 == 5, F.date_format("STATUS_CHANGE_DATE", "M/d/yyyy H:mm:ss"))
        .otherwise(F.col("STATUS_CHANGE_DATE").cast("string")).alias("status_change_date"))
    path = scratch_dir(ctx.spark, "optional_in")
    src.write.option("header", True).csv(path)
    missing = TB.scan_optional(ctx.spark, path + "-absent", "ID long, STATUS_CHANGE_DATE timestamp")
    return missing.unionByName(TB.scan_optional(ctx.spark, path, "ID long, STATUS_CHANGE_DATE timestamp"))


def q_ref_codes(ctx):
    return TB.ref_codes(ctx.claims, "RVNU_CD", "CODE")


def q_empty_typed(ctx):
    none_cfg = ClaimsConfig(newborn_rev_codes=("XXXX",), newborn_icd_codes=("XXXX",),
                            nicu_msdrg_codes=("XXX",), nicu_aprdrg_codes=("XXX",))
    cohort = codes.cohort_keys(ctx.windowed, none_cfg)
    claims = EP.project_claims(codes.cohort_semi_join(ctx.windowed, cohort))
    return TB.empty_typed(ctx.spark, claims) if claims.isEmpty() else claims


def q_sink_overwrite(ctx):
    return _write_read(ctx, ctx.ps, "ps_membership")


def q_upsert_merge(ctx):
    target, source = FX.fx_upsert(ctx.spark, ctx.sf)
    if not SK.duplicate_keys(source, "o_orderkey").isEmpty():
        raise ValueError("duplicate source keys")
    merged, _ = SK.upsert_merge(target, source, "o_orderkey")
    return merged.withColumnRenamed("_ACTION", "MERGE_ACTION")


def q_full_refresh(ctx):
    path, _, _ = SK.full_refresh(ctx.spark, ctx.run.hosp, None)
    return ctx.spark.read.parquet(path)


def q_schema_evolve(ctx):
    target, source = FX.fx_upsert(ctx.spark, ctx.sf)
    return SK.schema_evolve(target, source)


def q_typed_table(ctx):
    return SK.typed_table(FX.fx_orders_v2(ctx.spark, ctx.sf))


def q_normalize_dates(ctx):
    out, _ = SK.normalize_dates(ctx.requests.select("ID", "REQUEST_DATE", "STATUS_CHANGE_DATE", "CLOSED_DATE", "RECEIVED_DATE",
                                                    "NICU_START"))
    return out


def q_audit_append(ctx):
    """Audit rows of a refresh run of the request job (but for its duration)."""
    base = scratch_dir(ctx.spark, "requests")
    _request_run(ctx, ctx.requests, base, "run-0001", incremental=False)
    return ctx.spark.read.parquet(base + "/audit").drop("DURATION_SECONDS")


def _request_run(ctx, requests, base, run_id, **options):
    return RJ.request_job(ctx.spark, requests, ctx.initiatives, FX.REQUEST_PRODUCTS, FX.CLIENT_TYPES, FIXTURE_AS_OF, base,
                          base + "/audit", run_id, dt.datetime(2001, 12, 31), created_by="claimsmith", **options)


def q_export_report(ctx):
    return _write_read(ctx, ctx.code_freq, "drg_freq", "json")


def q_materialize(ctx):
    return SK.materialize(ctx.run.tagged).select("INDV_ID", "CLM_AUD_NBR", "LINE_KEY", "CLAIM_TYPE", "NET_PD_AMT")


def q_filter_study_window(ctx):
    return ctx.windowed.select("INDV_ID", "LINE_KEY", "SRVC_FROM_DT", "PROCESS_DT")


def q_filter_in_codes(ctx):
    cond = codes.any_column_in(codes.DIAG_COLS, CFG.newborn_icd_codes) | X.prefix("RVNU_CD").isin("017")
    return ctx.claims.filter(cond).select("INDV_ID", "CLM_AUD_NBR", "LINE_KEY")


def q_project_claims(ctx):
    return EP.project_claims(ctx.claims)


def q_select_existing(ctx):
    want = ["INDV_ID", "STUDY_YR", "LOB", "PRDCT_CD", "NOT_A_COLUMN"]
    df = ctx.ps
    if "LOB" not in df.columns and "PRDCT_CD" in df.columns:
        df = df.withColumn("LOB", F.col("PRDCT_CD"))
    return df.select(*[c for c in want if c in df.columns])


def q_claim_type(ctx):
    return classify.claim_type(EP.project_claims(ctx.claims)).select("LINE_KEY", "CLAIM_TYPE")


def q_provider_category(ctx):
    return ctx.claims.select("LINE_KEY", classify.provider_category_expr().alias("PROV_CAT"))


def q_map_values(ctx):
    return classify.map_values(ctx.requests, "CLIENT_TYPE_DETAIL", FX.CLIENT_TYPES).select(
        "ID", "CLIENT_TYPE_DETAIL")


def q_fill_flags(ctx):
    return classify.fill_flags(ctx.requests, REQUEST_FLAGS).select("ID", "NICU", "MATERNITY", "KIDNEY", "`CAR-T`")


def q_flag_list_text(ctx):
    return R.clean_requests(ctx.requests, REQUEST_FLAGS, FX.CLIENT_TYPES).select("ID", "PRODUCTS_REQUESTED")


def q_high_cost_flag(ctx):
    flagged = classify.high_cost_flag(ctx.claims, threshold=CFG.high_cost_threshold)
    return classify.drop_flagged(flagged).select("LINE_KEY", "NET_PD_AMT", "HIGH_COST")


def q_resolve_columns(ctx):
    f = R.resolve_columns(ctx.requests)
    return ctx.requests.select(*[v.alias(k) for k, v in f.items()])


def q_stay_type_flags(ctx):
    nh = EP.stay_claims(ctx.run.newborn_claims, ctx.run.hosp, CFG)
    return classify.stay_type_flags(nh, W.start, W.mid).select(
        "INDV_ID", "LINE_KEY", "ADMIT", "DSCHRG", "STAY_TYPE", "IN_DAYS", "STUDY_YR", "ADMIT_GAP")


def q_cost_flags(ctx):
    return ctx.run.nicu_rollup.select("INDV_ID", "ADMIT", "DSCHRG", "ALL_FACILITY_COST", "LOW_PAID_NICU",
                                      "INAPPROPRIATE_NICU")


def q_cost_per_day(ctx):
    return ctx.run.final.select("INDV_ID", "ADMIT", "DSCHRG", "STAY_TYPE", "COST_PER_DAY")


def q_discharge_rank(ctx):
    return ctx.claims.select("LINE_KEY", "DSCHRG_STS", classify.discharge_rank_expr().alias("DISCHARGE_RANK"))


def q_lob_contract_labels(ctx):
    return ctx.run.newborns_pre.select("INDV_ID", "BTH_DT", "EP_BIRTH_TYPE", "BABY_TYPE", "CONTRACT")


def q_rename_drop(ctx):
    return (ctx.claims.withColumnRenamed("LST_SRVC_DT", "SRVC_THRU_DT").withColumnRenamed("PROV_NPI", "PROVID")
            .drop("BTH_DT", "COV_AMT", "ALLW_AMT", "BILL_TYPE", "PROV_ZIP_CD")
            .select("INDV_ID", "LINE_KEY", "SRVC_THRU_DT", "PROVID"))


def q_filter_since_delivery(ctx):
    return ctx.run.newborn_claims.select("INDV_ID", "LINE_KEY", "DELIVERY_DT", "SRVC_FROM_DT", "HIGH_COST")


def q_filter_stay_claims(ctx):
    return EP.stay_lines(ctx.run.newborn_claims).select("INDV_ID", "LINE_KEY", "DELIVERY_DT", "ADMIT_DT_FIL", "DISCH_DT_FIL")


def q_split_professional_facility(ctx):
    return classify.split_professional_facility(ctx.sos_lines).select("LINE_KEY", "PROV_CAT", "LINE_GROUP")


def q_filter_long_drg(ctx):
    return ctx.run.nicu_rollup.filter((F.col("STAY_TYPE") == "Long Stay") & (F.col("CONTRACT") == "DRG")).select(
        "INDV_ID", "ADMIT", "DSCHRG", "FINAL_DRG_CD", "ALL_FACILITY_COST")


# 2.4 joins
def q_join_inner_using(ctx):
    src = usable_months(ctx.members)
    return enrollment_periods(src).join(latest_demographics(src, ("GENDER", "BTH_DT", "STATE")), "INDV_ID")


def q_join_left_eligibility(ctx):
    return ctx.claims1.select("INDV_ID", "LINE_KEY", "GENDER", "BTH_DT", "BUS_LINE_CD", "PRDCT_CD", "STATE")


def q_flag_any_of_columns(ctx):
    """By reference tables, over the job's claims."""
    flags = ("NEWBORN_ICD", "SINGLE", "TWIN", "MULTIPLE")
    ref = FX.ref_flag_table(ctx.spark, CFG, flags)
    tables = {f: ref.filter(F.col("FLAG") == f) for f in flags}
    return codes.flag_any_of_columns(ctx.claims1, tables).select("LINE_KEY", *flags)


def q_flag_code(ctx):
    out = codes.flag_code(ctx.claims, "RVNU_CD", FX.ref_codes_df(ctx.spark, CFG.newborn_rev_codes), "NEWBORN_REV")
    return codes.flag_code(out, "RVNU_CD", FX.ref_codes_df(ctx.spark, CFG.nicu_rev_codes), "NICU_REV").select("LINE_KEY", "NEWBORN_REV", "NICU_REV")


def q_flag_code_prefix(ctx):
    out = codes.flag_code_prefix(ctx.claims, "DERIV_DRG_CD", FX.ref_codes_df(ctx.spark, CFG.nicu_msdrg_codes), "NICU_MSDRG")
    return codes.flag_code_prefix(out, "DERIV_DRG_CD", FX.ref_codes_df(ctx.spark, CFG.nicu_aprdrg_codes), "NICU_APRDRG").select(
        "LINE_KEY", "NICU_MSDRG", "NICU_APRDRG")


def q_cohort_semi_join(ctx):
    cohort = codes.cohort_keys(ctx.windowed, CFG)
    return codes.cohort_semi_join(ctx.windowed, cohort).select("INDV_ID", "LINE_KEY")


def q_cohort_or_join(ctx):
    return codes.cohort_or_join(ctx.windowed, CFG)


def q_range_join_stay(ctx):
    return EP.stay_claims(ctx.run.newborn_claims, ctx.run.hosp, CFG).select("INDV_ID", "LINE_KEY", "ADMIT", "DSCHRG")


def q_range_join_nicu(ctx):
    return ctx.run.nicu_claims.claims.select("INDV_ID", "LINE_KEY", "ADMIT", "DSCHRG", "LOS")


def q_interval_join_readmit(ctx):
    return EP.readmissions(ctx.run.ident.nicu_ident, ctx.run.hosp, CFG)


def q_join_features(ctx):
    return ctx.run.nicu_rollup.select("INDV_ID", "ADMIT", "DSCHRG", "ALL_PROFFEE", "MANAGEABLE_PROFFEE",
                                      "CRITICAL_CARE_PROFFEE", "FACILITY_RM_COST", "READMIT", "NAS", "GA_CAT",
                                      "BW_CAT", "FINAL_REV_CD", "FINAL_DRG_CD", "PROVID")


def q_join_crosswalk(ctx):
    return ctx.sos_lines.select("LINE_KEY", "INDV_ID", "GENDER", "PROC_CD", "PROC_CD_DESC", "PROCEDURE_SPECIALTY",
                                "INCLUDE_IN_ORDERING", "ELIGIBLE")


def q_join_padded_key(ctx):
    from claimsmith.operators.joins import join_padded_key
    prim = S.primary_lines(ctx.sos_lines, AMT, CFG).select(S.EVENT, "MBR_ZIP_CD")
    return join_padded_key(prim, FX.xref_cbsa(ctx.spark, ctx.sf), "MBR_ZIP_CD", "ELIG_ZIP_CD").select(
        S.EVENT, "MBR_ZIP_CD", "CBSA", "CBSA_NM")


def q_join_enrich_nullsafe(ctx):
    return ctx.products.select("ID", "PRODUCT", "SALESFORCE_ID", "HAS_VALUE")


def q_join_trimmed(ctx):
    return join_trimmed(ctx.run.ident.newborns, ctx.run.nicu_rollup, EP.STAY_KEYS).drop(
        "MANAGEABLE_SVC_DAYS", "CRITICAL_CARE_DAYS")


def q_join_provider_dim(ctx):
    return ctx.run.nicu_claims.provider


# 2.5 aggregations
def q_agg_member_months(ctx):
    return ctx.ps


def q_agg_newborn_flags(ctx):
    return ctx.run.newborns_pre


def q_agg_stay(ctx):
    return ctx.run.hosp.select("INDV_ID", "DELIVERY_DT", "HOSP_STAY", "PAID_AMT")


def q_agg_episode(ctx):
    return ctx.run.ident.episodes


def q_agg_newborn(ctx):
    return ctx.run.ident.newborns


def _fees(ctx):
    return EP.stay_fee_features(ctx.run.nicu_claims.claims, CFG)


def q_agg_prof_fees(ctx):
    return _fees(ctx).filter(F.col("ALL_PROFFEE").isNotNull()).select(*EP.STAY_KEYS, "ALL_PROFFEE")


def q_agg_manageable_fees(ctx):
    return _fees(ctx).filter(F.col("MANAGEABLE_PROFFEE").isNotNull()).select(
        *EP.STAY_KEYS, "MANAGEABLE_PROFFEE", "MANAGEABLE_SVC_DAYS")


def q_agg_critical_fees(ctx):
    return _fees(ctx).filter(F.col("CRITICAL_CARE_PROFFEE").isNotNull()).select(
        *EP.STAY_KEYS, "CRITICAL_CARE_PROFFEE", "CRITICAL_CARE_DAYS")


def q_agg_room_board(ctx):
    return _fees(ctx).filter(F.col("FACILITY_RM_COST").isNotNull()).select(*EP.STAY_KEYS, "FACILITY_RM_COST")


def q_agg_min_rev_code(ctx):
    return ctx.run.nicu_claims.rev_features.select(*EP.STAY_KEYS, "FINAL_REV_CD")


def q_agg_min_drg(ctx):
    return ctx.run.nicu_claims.drg_min


def q_agg_median_cost(ctx):
    from claimsmith.operators.aggregates import exact_median
    n = ctx.run.nicu_rollup.filter((F.col("STAY_TYPE") == "Long Stay") & (F.col("CONTRACT") == "DRG"))
    med = exact_median(n.withColumn("_cents", (F.col("ALL_FACILITY_COST") * 100).cast("bigint")),
                       ["FINAL_DRG_CD"], "_cents", "_M")
    return med.select("FINAL_DRG_CD", (F.col("_M") / 100.0).alias("MEDIAN_ALL_FACILITY_COST"))


def q_agg_summary(ctx):
    return M.run_summary(ctx.run.ident)


def q_agg_count_by_group(ctx):
    return ctx.run.ident.newborns.groupBy("STUDY_YR").agg(F.count(F.lit(1)).alias("COUNT"))


def q_agg_not_in_ranking(ctx):
    return (S.event_buckets(ctx.sos_lines, AMT, CFG).filter(F.col("COVERED_NOT_IN_RANKING").isNotNull())
            .select(S.EVENT, "COVERED_NOT_IN_RANKING"))


def q_agg_rank_buckets(ctx):
    return S.event_buckets(ctx.sos_lines, AMT, CFG).drop("COVERED_NOT_IN_RANKING", "_HAS_PRIMARY")


def q_agg_episode_rollup(ctx):
    return S.sos_rollup(ctx.sos_lines, FX.xref_cbsa(ctx.spark, ctx.sf), AMT, CFG)


def q_profile_columns(ctx):
    return ctx.claims_profile[0].drop("null_pct_h", "populated_pct_h")


def q_profile_alerts(ctx):
    return ctx.claims_profile[1]


def q_profile_summary(ctx):
    return ctx.claims_profile[2]


def q_key_field_population(ctx):
    return P.key_field_population(ctx.claims_profile[0])[0]


def q_code_frequency(ctx):
    return ctx.code_freq


def _by_load(ctx, name, columns, add):
    """A state that three loads of claims were added to, each by its own rows only.

    The claims are built once and stored by load, with the ``columns`` that the state reads."""
    state = ST.DistinctState(ctx.spark, scratch_dir(ctx.spark, name), name)
    load, held = F.pmod(F.xxhash64("CLM_AUD_NBR"), F.lit(3)).cast("int"), []
    claims = SK.materialize(ctx.claims.select(*[x for x in ctx.claims.columns if x in columns], load.alias("_load")), stored=held, partition_by=("_load",))
    for i in range(3):
        add(state, f"load-{i}", claims.where(F.col("_load") == i).drop("_load"))
    SK.drop_stored(ctx.spark, held)
    return state


def q_code_frequency_by_load(ctx):
    columns = {"DERIV_DRG_CD", "INDV_ID", "SRVC_FROM_DT", "RVNU_CD", *codes.DIAG_COLS}
    return ST.code_frequency(_by_load(ctx, "codes", columns, lambda *a: ST.add_code_load(*a, CFG)))


def q_profile_columns_by_load(ctx):
    state = _by_load(ctx, "profile", P.CLAIMS_EXPECTED, lambda *a: ST.add_profile_load(*a, P.CLAIMS_EXPECTED))
    return ST.profile_columns(state, P.CLAIMS_EXPECTED, "FA_MEDICAL").drop("null_pct_h", "populated_pct_h")


def q_code_type_breakdown(ctx):
    return P.code_type_breakdown(ctx.code_freq, CFG)


def q_code_frequency_stats(ctx):
    return P.code_frequency_stats(ctx.code_freq, CFG)


def q_null_counts(ctx):
    return P.null_counts(ctx.products, ["SALESFORCE_ID", "HAS_VALUE", "COMPLETE_DATE", "STATUS_CHANGE_DATE"])


def q_run_metrics(ctx):
    return ctx.history


def _faulty_history(ctx):
    """The run's row twice, and an earlier run whose rate left its range."""
    earlier = ctx.history.withColumn("run_id", F.lit("run-0000")).withColumn("nicu_rate_pct", F.col("nicu_rate_pct") + 100.5)
    return ctx.history.unionByName(ctx.history).unionByName(earlier)


def q_metrics_checks(ctx):
    return M.metrics_checks(_faulty_history(ctx))


# 2.6 windows
def q_latest_per_key(ctx):
    return latest_demographics(usable_months(ctx.members))


def q_preferred_per_key(ctx):
    return EP.elig_latest(ctx.ps)


def q_first_value_date(ctx):
    return ctx.run.newborns_pre.select("INDV_ID", "BTH_DT", "SVC_DATE", "DELIVERY_DT")


def q_sessionize_gap(ctx):
    return _stay_intervals(ctx).select("INDV_ID", "DELIVERY_DT", "ADMIT_DT_FIL", "DISCH_DT_FIL", "NEW_STAY")


def q_running_sum(ctx):
    return _stay_intervals(ctx).select("INDV_ID", "DELIVERY_DT", "ADMIT_DT_FIL", "DISCH_DT_FIL", "HOSP_STAY")


def q_dedup_claim(ctx):
    return ctx.run.ident.claim_base.select("INDV_ID", "DELIVERY_DT", "CLM_AUD_NBR", "LINE_KEY", "ADMIT", "DSCHRG")


def q_last_discharge_status(ctx):
    return ctx.run.nicu_claims.last_status


def q_best_provider(ctx):
    return ctx.run.nicu_claims.provider.select(*EP.STAY_KEYS, "PROVID", "HOSPPAID", "HOSPADMIT", "HOSPDISCHG", "HOSPLOS")


def q_first_category(ctx):
    return EP.first_category(EP.diagnosis_long(ctx.run.nicu_claims.claims), FX.ref_category_df(ctx.spark, CFG.birthweight_icd, "BW_CAT"), "BW_CAT")


def q_second_value(ctx):
    return ctx.run.nicu_claims.rev_features


def q_rank_by_amount(ctx):
    return S.ranked_lines(ctx.sos_lines, AMT).select(S.EVENT, "LINE_KEY", AMT, "ELIGIBLE", "RANK")


def q_primary_line(ctx):
    return S.primary_lines(ctx.sos_lines, AMT, CFG).select(S.EVENT, "LINE_KEY", AMT)


# 2.7 sorts / limits
def q_sort_desc(ctx):
    return ctx.code_freq.orderBy(F.col("MEMBER_COUNT").desc(), F.col("DRG"))


def q_sample_distinct(ctx):
    return P.sample_values(P.distinct_values(ctx.claims, ctx.claims.columns), 5, CFG.rank_salt_buckets)


def q_preview_limit(ctx):
    return ctx.run.hosp.orderBy(F.col("PAID_AMT").desc(), F.col("INDV_ID"), F.col("HOSP_STAY")).limit(10)


def q_top_code(ctx):
    return ctx.code_freq.agg(F.min_by("DRG", F.struct(-F.col("MEMBER_COUNT"), F.col("DRG"))).alias("TOP_CODE"),
                             F.max("MEMBER_COUNT").alias("MEMBER_COUNT"))


def q_sort_alerts(ctx):
    return ctx.claims_profile[1].orderBy("severity_order", "column_name")


# 2.8 set ops / reshaping
def q_cohort_union(ctx):
    ref = lambda v: FX.ref_codes_df(ctx.spark, v)
    return codes.cohort_keys_by_tables(ctx.windowed, ref(CFG.newborn_rev_codes), ref(CFG.newborn_icd_codes),
                                       ref(CFG.nicu_msdrg_codes), ref(CFG.nicu_aprdrg_codes))


def _overlaps(ctx):
    return with_overlaps(enrollment_periods(usable_months(ctx.members)), W)


def q_union_periods(ctx):
    return by_study_year(_overlaps(ctx)).drop("MMYR1", "MMYR2")


def q_unpivot_codes(ctx):
    return EP.diagnosis_long(ctx.run.nicu_claims.claims)


def q_period_compare(ctx):
    return M.period_compare(ctx.history)


def q_trend_query(ctx):
    return M.trend_query(ctx.history, "DEMO")


def q_distinct_rows(ctx):
    return ctx.members.select("INDV_ID", "MEM_EFF_DT", "MEM_EXP_DT").distinct()


def q_missing_columns(ctx):
    """Expected columns that the table lacks, and how many rows lack them."""
    miss = P.missing_columns(ctx.claims, P.CLAIMS_EXPECTED)
    return ctx.claims.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(F.array(*map(F.lit, miss))).alias("column_name"), "n_rows")


def q_explode_products(ctx):
    return R.explode_products(R.clean_requests(ctx.requests, REQUEST_FLAGS, FX.CLIENT_TYPES), FX.REQUEST_PRODUCTS)


# 2.9 scalar functions
def q_scalar_dates(ctx):
    m = ctx.members
    return m.select(
        "ROW_KEY",
        X.yyyymm_to_date("YEARMO").alias("MM_DATE"),
        F.datediff("MEM_EXP_DT", "MEM_EFF_DT").alias("DAYS"),
        X.months_crossed("MEM_EFF_DT", "MEM_EXP_DT").alias("MONTHS_CROSSED"),
        X.years_crossed("BTH_DT", "MEM_EFF_DT").alias("YEARS_CROSSED"),
        X.strict_greatest("MEM_EFF_DT", "BTH_DT").alias("STRICT_GREATEST"),
        X.strict_least("MEM_EXP_DT", X.lit_date(W.end)).alias("STRICT_LEAST"),
        F.date_add("MEM_EFF_DT", 4).alias("PLUS_4"),
        F.date_format("MEM_EFF_DT", "yyyy-MM-dd").alias("ISO_TEXT"),
        F.date_format("MEM_EFF_DT", "MMM yyyy").alias("MONTH_LABEL"),
        F.lpad(F.month("MEM_EFF_DT").cast("string"), 2, "0").alias("MONTH_2"),
        F.datediff(X.lit_date(FIXTURE_AS_OF), "MEM_EFF_DT").alias("DAYS_TO_CLOCK"))


def q_scalar_strings(ctx):
    c = ctx.claims
    return c.select(
        "LINE_KEY",
        X.event_id("INDV_ID", "SRVC_FROM_DT").alias("EVENT_ID"),
        X.prefix("RVNU_CD").alias("REV3"),
        F.substring("DERIV_DRG_CD", 1, 3).alias("DRG3"),
        X.is_in("DIAG_1_CD", CFG.newborn_icd_codes).alias("IN_CODES"),
        X.code_between("RVNU_CD", "0100", "0210").alias("REV_BETWEEN"),
        F.col("RVNU_CD").startswith("045").alias("REV_STARTS"),
        F.col("RVNU_CD").rlike(K.FACILITY_REV_PATTERN).alias("REV_RLIKE"),
        F.length("DSCHRG_STS").alias("STS_LEN"),
        X.number_text(X.try_number("RVNU_CD")).alias("REV_NUM_TEXT"),
        F.concat(F.col("INDV_ID"), F.lit("-"), F.col("PROC_CD")).alias("CONCAT_NULL"),
        X.null_safe_concat(K.REQUEST_URL_PREFIX, "CLM_AUD_NBR").alias("URL"))


def q_scalar_numbers(ctx):
    c = ctx.claims
    return c.select(
        "LINE_KEY",
        F.coalesce(F.col("ADMIT_DT"), F.col("SRVC_FROM_DT")).alias("COALESCED"),
        F.when(F.col("NET_PD_AMT") > 1000, "big").otherwise("small").alias("SIZE"),
        F.abs(F.datediff("ADMIT_DT", "DISCH_DT")).alias("ABS_DAYS"),
        X.try_number("PROC_CD").alias("PROC_NUM"),
        F.round(F.col("NET_PD_AMT"), 0).alias("ROUNDED"),
        M._pct_h(F.length("LINE_KEY"), F.lit(7)).alias("PCT"))


# 2.10 temporal
def q_study_window_24m(ctx):
    li = TB.read_table(ctx.spark, ctx.sf, "lineitem")
    return study_window_frame(li, 24, 3, from_col="l_shipdate", process_col="l_shipdate")


def q_study_window_12m(ctx):
    li = TB.read_table(ctx.spark, ctx.sf, "lineitem")
    return study_window_frame(li, 12, 3, from_col="l_shipdate", process_col="l_shipdate")


def q_overlap_months(ctx):
    return _overlaps(ctx)


def q_membership_periods(ctx):
    return ctx.ps


def q_membership_latest(ctx):
    return membership_latest(ctx.members, *ctx.sos_period, "DEMO")


def q_clip_and_los(ctx):
    return ctx.run.hosp


def q_fill_dates(ctx):
    from claimsmith.operators.periods import fill_dates
    return fill_dates(EP.project_claims(ctx.claims)).select("LINE_KEY", "ADMIT_DT_FIL", "DISCH_DT_FIL")


def q_request_metrics(ctx):
    return ctx.products


# 2.11 composite jobs
def q_tag_reference_flags(ctx):
    return ctx.run.tagged.select("INDV_ID", "LINE_KEY", "CLAIM_TYPE", "NEWBORN_ICD", "SINGLE", "TWIN", "MULTIPLE",
                                 "NEWBORN_REV", "NICU_REV", "NICU_MSDRG", "NICU_APRDRG")


def q_newborn_rollup(ctx):
    return ctx.run.newborn_claims.select("INDV_ID", "LINE_KEY", "EP_BIRTH_TYPE", "DELIVERY_DT", "IN_DAYS",
                                         "BABY_TYPE", "CONTRACT", "BIRTH_PRI", "BIRTH_TYPE", "HIGH_COST")


def q_hospital_rollup(ctx):
    return ctx.run.hosp


def q_newborn_ident(ctx):
    return ctx.run.ident.newborns


def q_nicu_claims(ctx):
    return ctx.run.nicu_claims.claims.select("INDV_ID", "LINE_KEY", "ADMIT", "DSCHRG", "DELIVERY_DT", "LOS",
                                             "NET_PD_AMT", "LAST_DISCHARGE_STATUS")


def q_nicu_rollup(ctx):
    return ctx.run.nicu_rollup


def q_nas_flag(ctx):
    return _fees(ctx).filter(F.col("NAS")).select(*EP.STAY_KEYS, "NAS")


def q_newborns_final(ctx):
    return ctx.run.final


def q_newborn_end_to_end(ctx):
    w = study_window(ctx.claims, 24, 3)
    return EP.newborn_episodes(ctx.claims, membership_periods(ctx.members, w, "DEMO"), w, CFG,
                               materialize=ctx.cut).final


def q_newborn_by_tables(ctx):
    """The job with its codes from reference tables and its claims laid out by service month."""
    path = scratch_dir(ctx.spark, "claims_by_month")
    LO.write_by_month(ctx.claims, path, files=max(1, int(ctx.spark.conf.get("spark.sql.shuffle.partitions")) // 12))
    row = LO.month_bounds(ctx.spark, path).first()
    claims = ctx.spark.read.parquet(path)
    if row["MIN_FROMDATE"] is None:
        raise ValueError("claims without service dates")
    tables = codes.CodeTables({f: FX.ref_codes_df(ctx.spark, c) for f, c in CFG.code_sets().items()},
                              FX.ref_category_df(ctx.spark, CFG.gest_age_icd, "GA_CAT"), FX.ref_category_df(ctx.spark, CFG.birthweight_icd, "BW_CAT"))
    return EP.newborn_episodes(claims, ctx.ps, W, CFG, materialize=ctx.cut, tables=tables).final


def q_sos_data_pull(ctx):
    return ctx.sos_lines.drop(S.EVENT)


def q_sos_event_id(ctx):
    return ctx.sos_lines.select("LINE_KEY", "INDV_ID", "SRVC_FROM_DT", S.EVENT)


def q_sos_rollup(ctx):
    return S.sos_rollup(ctx.sos_lines, FX.xref_cbsa(ctx.spark, ctx.sf), AMT, CFG)


def q_request_etl(ctx):
    """A refresh run over the odd requests, then a merge run over all: the merged
    list, the product rows and the audit rows of both runs, by section."""
    base = scratch_dir(ctx.spark, "requests")
    _request_run(ctx, ctx.requests.filter(F.col("ID") % 2 == 1), base, "run-0001", incremental=False)
    last = _request_run(ctx, ctx.requests, base, "run-0002")  # starts from what the first run published
    raw = ctx.spark.read.parquet(last.requests_path).select("ID", "TITLE", "CLIENT", "MARKET", "REQUESTOR", "OVERALL_STATUS",
                                                             "PRODUCTS_REQUESTED", "SALESFORCE_ID", "PTRR")
    parts = [raw, ctx.spark.read.parquet(last.products_path), ctx.spark.read.parquet(base + "/audit").drop("DURATION_SECONDS")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [p.withColumn("SECTION", F.lit(n)) for n, p in zip(("REQUESTS", "PRODUCTS", "AUDIT"), parts)])


def q_qa_report(ctx):
    """The whole QA job over both tables, its parts by section."""
    parts = P.qa_job({"FA_MEDICAL": (ctx.claims, P.CLAIMS_EXPECTED), "FA_MEMBERSHIP": (ctx.members, P.MEMBERSHIP_EXPECTED)},
                     ctx.claims, CFG)
    out = [df.withColumn("section", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out).drop("null_pct_h", "populated_pct_h")


def q_metrics_job(ctx):
    """An earlier run and two loads of one run id into a history, which keeps one row a run:
    rows, violations, trend and comparison of the job."""
    path = scratch_dir(ctx.spark, "history")
    M.write_history(ctx.history.withColumn("run_id", F.lit("run-0000")), path)
    M.write_history(ctx.history, path)
    job = M.metrics_job(ctx.run, ctx.ps, W, CFG, RUN_INFO, path)
    history = job["history"].select("run_id", "client_name", "run_date", F.col("total_newborns_identified").alias("newborns"),
                                    F.col("total_nicu_episodes").alias("nicu_episodes"), "nicu_rate_pct")
    trend = job["trend"].select("client_name", "run_date", F.col("total_newborns_identified").alias("newborns"),
                                F.col("total_nicu_episodes").alias("nicu_episodes"), "nicu_rate_pct")
    parts = [history, job["checks"], trend, job["compare"]]
    out = [p.withColumn("section", F.lit(n)) for n, p in zip(("history", "checks", "trend", "compare"), parts)]
    cols = ["section", "run_id", "client_name", "run_date", "period", "newborns", "nicu_episodes", "nicu_rate_pct", "violation"]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out).select(*cols)


# Generic (column-parametrised) uses on the plain tables.
def q_sessionize_events(ctx):
    from claimsmith.operators.windows import sessionize_events
    ev = TB.read_table(ctx.spark, ctx.sf, "events").select("event_id", "user_id", "ts")
    return sessionize_events(ev, "user_id", "ts", 1800)


def q_latest_order_per_customer(ctx):
    od = TB.read_table(ctx.spark, ctx.sf, "orders")
    return latest_per_key(od, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderkey", "o_orderdate", "o_totalprice"])


def q_top_priority(ctx):
    od = TB.read_table(ctx.spark, ctx.sf, "orders")
    freq = od.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("N_ORDERS"))
    return freq.agg(F.min_by("o_orderpriority", F.struct(-F.col("N_ORDERS"), F.col("o_orderpriority"))).alias("TOP_CODE"),
                    F.max("N_ORDERS").alias("N_ORDERS"))


def q_profile_orders(ctx):
    od = TB.read_table(ctx.spark, ctx.sf, "orders")
    expected = {c: (c in ("o_orderkey", "o_custkey"), True, c) for c in od.columns}
    return P.profile_columns(od, expected, "ORDERS").drop("null_pct_h", "populated_pct_h")


def q_agg_claim_type_counts(ctx):
    return ctx.run.tagged.groupBy("CLAIM_TYPE").agg(F.count(F.lit(1)).alias("COUNT"))


QUERY_FUNCS = {name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)}


def queries() -> dict:
    """key -> callable(spark, sf_dir) -> DataFrame (normalised output)."""
    def wrap(fn):
        def run(spark, sf_dir):
            return normalize(fn(Ctx(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERY_FUNCS.items()}
