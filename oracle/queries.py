"""Oracle SQL (DuckDB) per query key, over the pre-registered base tables.

Every statement is ``WITH <fixture + workload CTEs> <select>``.  Money is
summed exactly as DECIMAL and cast to DOUBLE at the end; integer outputs
are BIGINT, matching the normalised Spark outputs.
"""

from __future__ import annotations

from oracle.ctes import AS_OF, PROFILE_CTES, REQUEST_CTES, SOS_CTES
from oracle.episodes import E, EPISODE_CTES, MID, NEWBORN_ICD, PREV_HIGH, RO, S, any_diag, inlist, overlap
from oracle.fixtures import FIXTURE_CTES

PREFIX = "WITH " + ",".join([FIXTURE_CTES, EPISODE_CTES, SOS_CTES, REQUEST_CTES, PROFILE_CTES])

D = "DOUBLE"
STAY = "INDV_ID, ADMIT, DSCHRG"


def dbl(*cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def big(*cols):
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)


NB_IDENT_COLS = ("INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE, ADMIT, DSCHRG, "
                 "CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, CAST(LOS AS BIGINT) AS LOS, BABY_TYPE, BIRTH_TYPE, CONTRACT")
HOSP_COLS = ("INDV_ID, DELIVERY_DT, CAST(HOSP_STAY AS BIGINT) AS HOSP_STAY, ADMIT, DSCHRG, "
             "CAST(PAID_AMT AS DOUBLE) AS PAID_AMT, CAST(OUT_END_DATE AS BIGINT) AS OUT_END_DATE, CAST(LOS AS BIGINT) AS LOS")
NICU_ROLLUP_COLS = (
    "INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE, ADMIT, DSCHRG, BABY_TYPE, BIRTH_TYPE, "
    "CONTRACT, CAST(TOTAL_NICU_COST AS DOUBLE) AS TOTAL_NICU_COST, CAST(LOS AS BIGINT) AS LOS, "
    "CAST(ALL_PROFFEE AS DOUBLE) AS ALL_PROFFEE, CAST(MANAGEABLE_PROFFEE AS DOUBLE) AS MANAGEABLE_PROFFEE, "
    "CAST(CRITICAL_CARE_PROFFEE AS DOUBLE) AS CRITICAL_CARE_PROFFEE, CAST(FACILITY_RM_COST AS DOUBLE) AS FACILITY_RM_COST, "
    "NAS, CAST(READMIT AS BIGINT) AS READMIT, CAST(READMIT_PAID_AMT AS DOUBLE) AS READMIT_PAID_AMT, "
    "CAST(READMIT_LOS AS BIGINT) AS READMIT_LOS, GA_CAT, BW_CAT, FINAL_REV_CD, REV_LEVELING, FINAL_DRG_CD, PROVID, "
    "PROV_TIN, PROV_FULL_NM, PROV_STATE, CAST(ALL_FACILITY_COST AS DOUBLE) AS ALL_FACILITY_COST, LOW_PAID_NICU, "
    "INAPPROPRIATE_NICU")
FINAL_COLS = (
    "INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE, ADMIT, DSCHRG, "
    "CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, CAST(LOS AS BIGINT) AS LOS, BABY_TYPE, BIRTH_TYPE, CONTRACT, "
    "FINAL_DRG_CD, CAST(TOTAL_NICU_COST AS DOUBLE) AS TOTAL_NICU_COST, CAST(ALL_PROFFEE AS DOUBLE) AS ALL_PROFFEE, "
    "CAST(MANAGEABLE_PROFFEE AS DOUBLE) AS MANAGEABLE_PROFFEE, CAST(CRITICAL_CARE_PROFFEE AS DOUBLE) AS CRITICAL_CARE_PROFFEE, "
    "CAST(FACILITY_RM_COST AS DOUBLE) AS FACILITY_RM_COST, NAS, CAST(READMIT AS BIGINT) AS READMIT, "
    "CAST(READMIT_PAID_AMT AS DOUBLE) AS READMIT_PAID_AMT, CAST(READMIT_LOS AS BIGINT) AS READMIT_LOS, GA_CAT, BW_CAT, "
    "FINAL_REV_CD, REV_LEVELING, PROVID, PROV_TIN, PROV_FULL_NM, PROV_STATE, "
    "CAST(ALL_FACILITY_COST AS DOUBLE) AS ALL_FACILITY_COST, LOW_PAID_NICU, INAPPROPRIATE_NICU, "
    "MEDIAN_ALL_FACILITY_COST, COST_PER_DAY")
PS_COLS = ("INDV_ID, STUDY_YR, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE, CAST(AGE AS BIGINT) AS AGE, CLIENT_NAME, "
           "PREVIOUS_PERIOD, CURRENT_PERIOD, MEMBER_MONTHS")
SOS_PULL_COLS = ("INDV_ID, LINE_KEY, BUS_LINE_CD, REL_CD, BTH_DT, GENDER, SBSCR_ID, MBR_ZIP_CD, MBR_STATE, PROCESS_DT, "
                 "PL_OF_SRVC_CD, BILL_TYPE, SRVC_FROM_DT, PROC_CD, PROC_CD_DESC, PROCEDURE_SPECIALTY, "
                 "INCLUDE_IN_ORDERING, ELIGIBLE, RVNU_CD, PROV_NPI, PROV_FULL_NM, PROV_STATE, PROV_ZIP_CD, "
                 "CAST(COV_AMT AS DOUBLE) AS COV_AMT, CAST(ALLW_AMT AS DOUBLE) AS ALLW_AMT, PROV_CAT")
REQ_METRIC_COLS = ("ID, TITLE, REQUEST_DATE, CLIENT, MARKET, REQUESTOR, CLIENT_TYPE, OVERALL_STATUS, PRODUCTS_REQUESTED, "
                   "SALESFORCE_ID, PRODUCT, PRODUCT_CATEGORY, START_DATE, COMPLETE_DATE, STATUS, STATUS_CHANGE_DATE, "
                   "CLOSED_DATE, PTRR, HAS_VALUE, DAYS_OPEN, PRODUCT_TAT, COMPLETED_PRODUCT, REQUEST_TYPE, "
                   "REQUEST_YEAR, PRODUCT_OPEN, DAYS_ON_STATUS, NEEDS_ATTENTION, URL")
PROFILE_OUT = ("table_name, column_name, description, critical, key_field, data_type, total_rows, null_count, "
               "null_pct, populated_count, populated_pct, distinct_count, sample_values")
CLAIM_PROJ = ("INDV_ID, CLM_AUD_NBR, LINE_KEY, SRVC_FROM_DT, LST_SRVC_DT AS SRVC_THRU_DT, PROCESS_DT, ADMIT_DT, "
              "DISCH_DT, DIAG_1_CD, DIAG_2_CD, DIAG_3_CD, DIAG_4_CD, DIAG_5_CD, PROC_1_CD, PROC_2_CD, PROC_3_CD, "
              "PROC_CD, DSCHRG_STS, CAST(SBMT_CHRG_AMT AS DOUBLE) AS BILLED, substring(DERIV_DRG_CD, 1, 3) AS DRG, "
              "CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, PL_OF_SRVC_CD, RVNU_CD, PROV_NPI AS PROVID, PROV_TIN, "
              "PROV_FULL_NM, PROV_STATE, PROV_TYP_CD")
CLAIM_TYPE_EXPR = __import__("oracle.episodes", fromlist=["CLAIM_TYPE"]).CLAIM_TYPE
DISCHARGE_RANK = __import__("oracle.episodes", fromlist=["DISCHARGE_RANK"]).DISCHARGE_RANK

_CFG_HASH = __import__("claimsmith.config", fromlist=["ClaimsConfig"]).ClaimsConfig().config_hash()

CODE_FREQ = f"""(SELECT DERIV_DRG_CD AS DRG, count(DISTINCT INDV_ID) AS MEMBER_COUNT, min(SRVC_FROM_DT) AS MIN_DATE,
    max(SRVC_FROM_DT) AS MAX_DATE FROM fx_claims
  WHERE (coalesce(RVNU_CD IN ('0170', '0171', '0172', '0173', '0174'), FALSE) OR {any_diag(NEWBORN_ICD)})
    AND DERIV_DRG_CD IS NOT NULL GROUP BY DERIV_DRG_CD)"""
DRG_TYPE = ("CASE WHEN DRG IS NULL THEN 'Unknown' WHEN substring(trim(DRG), 1, 3) IN ('593') THEN 'MS-DRG' "
            "WHEN substring(trim(DRG), 1, 3) IN ('790') THEN 'APR-DRG' ELSE 'Other' END")

STAY_INTERVALS = """(SELECT INDV_ID, DELIVERY_DT, ADMIT_DT_FIL, DISCH_DT_FIL, CAST(arg_min(NEW_STAY, LINE_KEY) AS BIGINT) AS NEW_STAY,
    CAST(arg_min(HOSP_STAY, LINE_KEY) AS BIGINT) AS HOSP_STAY FROM h3 GROUP BY INDV_ID, DELIVERY_DT, ADMIT_DT_FIL, DISCH_DT_FIL)"""


def pct_h_sql(num, den):
    return f"CASE WHEN {den} > 0 THEN CAST(({num} * 20000 + {den}) // ({den} * 2) AS DOUBLE) / 100.0 ELSE 0.0 END"


def avg_sql(total, n):
    return f"CASE WHEN {n} > 0 THEN CAST({total} AS DOUBLE) / {n} END"


DISCHARGE_RANK_L = DISCHARGE_RANK.replace("DSCHRG_STS", "LAST_DISCHARGE_STATUS")

RUN_METRICS = f"""(WITH mm AS (
  SELECT INDV_ID, bool_or(STUDY_YR = 'Previous') AS IN_PREV, bool_or(STUDY_YR = 'Current') AS IN_CUR,
    sum(MEMBER_MONTHS) AS MM, sum(CASE WHEN STUDY_YR = 'Previous' THEN MEMBER_MONTHS END) AS MM_PREV,
    sum(CASE WHEN STUDY_YR = 'Current' THEN MEMBER_MONTHS END) AS MM_CUR,
    bool_or(GENDER = 'M') AS G_M, bool_or(GENDER = 'F') AS G_F, bool_or(GENDER IS NULL) AS G_U,
    bool_or(BTH_DT IS NULL) AS NULL_BTH, bool_or(PRDCT_CD IS NULL) AS NULL_LOB,
    bool_or(BUS_LINE_CD = 'AUTOMOBILE') AS L_MED, bool_or(BUS_LINE_CD IN ('BUILDING', 'FURNITURE')) AS L_COM,
    bool_or(BUS_LINE_CD IS NULL OR BUS_LINE_CD NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')) AS L_OTH
    FROM ps_membership GROUP BY INDV_ID),
 m AS (SELECT count(*) AS total_members_enrolled, CAST(sum(MM) AS BIGINT) AS total_member_months,
    count_if(IN_PREV) AS members_previous_period, count_if(IN_CUR) AS members_current_period,
    CAST(sum(MM_PREV) AS BIGINT) AS member_months_previous, CAST(sum(MM_CUR) AS BIGINT) AS member_months_current,
    count_if(G_M) AS members_by_gender_m, count_if(G_F) AS members_by_gender_f, count_if(G_U) AS members_by_gender_unknown,
    count_if(NULL_BTH) AS members_with_null_birth_date, count_if(G_U) AS members_with_null_gender,
    count_if(NULL_LOB) AS members_with_missing_lob, count_if(L_MED) AS member_count_medicaid,
    count_if(L_COM) AS member_count_commercial, count_if(L_OTH) AS member_count_other_lob,
    (SELECT count(DISTINCT STATE) FROM ps_membership) AS unique_states_count,
    (SELECT count(DISTINCT BUS_LINE_CD) FROM ps_membership) AS unique_business_lines_count,
    (SELECT count(DISTINCT PRDCT_CD) FROM ps_membership) AS unique_product_codes_count FROM mm),
 nb AS (SELECT count(*) AS total_newborns_identified,
    count_if(STUDY_YR = 'Previous') AS newborns_previous_period, count_if(STUDY_YR = 'Current') AS newborns_current_period,
    count_if(BIRTH_TYPE = 'Single') AS newborns_single_birth, count_if(BIRTH_TYPE = 'Twin') AS newborns_twin_birth,
    count_if(BIRTH_TYPE = 'Multiple') AS newborns_multiple_birth, count_if(BABY_TYPE = 'Normal Newborn') AS newborns_normal,
    count_if(BABY_TYPE = 'NICU') AS newborns_with_any_nicu, count_if(STAY_TYPE = 'Short Stay') AS newborns_short_stay,
    count_if(STAY_TYPE = 'Long Stay') AS newborns_long_stay, CAST(sum(LOS) AS BIGINT) AS total_newborn_los_days,
    sum(NET_PD_AMT) AS nb_paid, count_if(BUS_LINE_CD = 'AUTOMOBILE') AS newborns_medicaid,
    count_if(BUS_LINE_CD IN ('BUILDING', 'FURNITURE')) AS newborns_commercial,
    count_if(BUS_LINE_CD IS NULL OR BUS_LINE_CD NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')) AS newborns_other_lob,
    count_if(date_diff('day', DELIVERY_DT, ADMIT) <= 4) AS newborns_admitted_in_init_days,
    count_if(EXISTS (SELECT 1 FROM hosp h WHERE h.INDV_ID = n.INDV_ID AND h.ADMIT = n.ADMIT AND h.DSCHRG = n.DSCHRG
                     AND h.OUT_END_DATE = 1)) AS newborns_discharge_clipped FROM newborn_ident n),
 nr AS (SELECT count(*) AS newborns_with_readmission, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_readmissions_count,
    sum(paid) AS nb_readm, CAST(coalesce(sum(days), 0) AS BIGINT) AS total_readmission_los_days FROM (
      SELECT n.INDV_ID, n.ADMIT, n.DSCHRG, count(DISTINCT h.ADMIT) AS n, sum(h.PAID_AMT) AS paid, sum(h.LOS) AS days
      FROM (SELECT DISTINCT INDV_ID, ADMIT, DSCHRG FROM newborn_ident) n JOIN hosp h ON n.INDV_ID = h.INDV_ID
      WHERE h.ADMIT > n.DSCHRG AND date_diff('day', n.DSCHRG, h.ADMIT) <= 30 GROUP BY ALL)),
 how AS (SELECT count_if(HAS_NICU_REV = 1) AS nicu_identified_by_rev, count_if(HAS_NICU_MSDRG = 1) AS nicu_identified_by_msdrg,
    count_if(HAS_NICU_APRDRG = 1) AS nicu_identified_by_aprdrg FROM newborns_pre),
 svc AS (SELECT (SELECT CAST(sum(MANAGEABLE_SVC_DAYS) AS BIGINT) FROM man_aggs) AS total_manageable_service_days,
    (SELECT CAST(sum(CRITICAL_CARE_DAYS) AS BIGINT) FROM crit_aggs) AS total_critical_care_service_days),
 hs AS (SELECT count(*) AS total_hospital_episodes, CAST(sum(OUT_END_DATE) AS BIGINT) AS episodes_discharge_clipped,
    CAST(sum(LOS) AS BIGINT) AS hosp_los, count(DISTINCT INDV_ID) AS newborns_with_hospital_stay,
    count(*) AS total_hospital_episodes_created, count_if(LOS < 1) AS episodes_with_los_lt_1,
    count_if(date_diff('day', DELIVERY_DT, ADMIT) > 0) AS episodes_with_admit_gap,
    (SELECT count(*) FROM claim_base) AS cb_claims FROM hosp),
 dsc AS (SELECT count_if(LAST_DISCHARGE_STATUS IN ('01', '06')) AS nicu_discharge_routine,
    count_if(LAST_DISCHARGE_STATUS IN ('02','05','66','43','62','63','65')) AS nicu_discharge_transfer,
    count_if(LAST_DISCHARGE_STATUS = '20') AS nicu_discharge_expired,
    count_if(NOT (LAST_DISCHARGE_STATUS IN ('01','06','20','02','05','66','43','62','63','65'))
             AND g <> 9) AS nicu_discharge_other,
    count_if(NOT (LAST_DISCHARGE_STATUS IN ('01','06','20','02','05','66','43','62','63','65'))
             AND g = 9) AS nicu_discharge_invalid
  FROM (SELECT LAST_DISCHARGE_STATUS, {DISCHARGE_RANK_L} AS g FROM last_status)),
 nc AS (SELECT count(*) AS total_nicu_episodes,
    count_if(STUDY_YR = 'Previous') AS nicu_episodes_previous, count_if(STUDY_YR = 'Current') AS nicu_episodes_current,
    count_if(BIRTH_TYPE = 'Single') AS nicu_single_birth, count_if(BIRTH_TYPE = 'Twin') AS nicu_twin_birth,
    count_if(BIRTH_TYPE = 'Multiple') AS nicu_multiple_birth, count_if(CONTRACT = 'DRG') AS nicu_drg_contract,
    count_if(CONTRACT = 'Per-Diem') AS nicu_per_diem_contract,
    count_if(CONTRACT IS NULL OR CONTRACT NOT IN ('DRG', 'Per-Diem')) AS nicu_other_contract, CAST(sum(LOS) AS BIGINT) AS total_nicu_los_days,
    median(CAST(LOS AS DOUBLE)) AS median_nicu_los_days, CAST(max(LOS) AS BIGINT) AS max_nicu_los_days,
    CAST(min(LOS) AS BIGINT) AS min_nicu_los_days, sum(TOTAL_NICU_COST) AS nicu_cost,
    median(CAST(TOTAL_NICU_COST * 100 AS BIGINT)) / 100.0 AS median_nicu_cost_per_episode,
    CAST(max(TOTAL_NICU_COST) AS DOUBLE) AS max_nicu_cost_per_episode,
    sum(ALL_PROFFEE) AS prof, sum(MANAGEABLE_PROFFEE) AS man, sum(CRITICAL_CARE_PROFFEE) AS crit,
    sum(ALL_FACILITY_COST) AS fac, sum(FACILITY_RM_COST) AS room,
    count_if(REV_LEVELING) AS nicu_episodes_with_rev_leveling,
    count_if(FINAL_REV_CD IN ('170', '171', '172', '173')) AS nicu_rev_level_1,
    count_if(FINAL_REV_CD IN ('174', '175')) AS nicu_rev_level_2,
    count_if(FINAL_REV_CD IN ('176', '177')) AS nicu_rev_level_3,
    count_if(FINAL_REV_CD IN ('178', '179')) AS nicu_rev_level_4, count_if(FINAL_REV_CD IS NULL) AS nicu_rev_unknown,
    count_if(READMIT > 0) AS nicu_episodes_with_readmit, CAST(sum(READMIT) AS BIGINT) AS total_nicu_readmissions,
    sum(READMIT_PAID_AMT) AS readm_paid,
    CAST(sum(READMIT_LOS) AS BIGINT) AS total_nicu_readmit_los_days,
    count_if(LOW_PAID_NICU) AS nicu_low_paid_cases,
    CAST(sum(CASE WHEN LOW_PAID_NICU THEN TOTAL_NICU_COST END) AS DOUBLE) AS total_low_paid_nicu_cost,
    count_if(INAPPROPRIATE_NICU) AS nicu_inappropriate_cases,
    CAST(sum(CASE WHEN INAPPROPRIATE_NICU THEN TOTAL_NICU_COST END) AS DOUBLE) AS total_inappropriate_nicu_cost,
    count_if(PROVID IS NOT NULL) AS nicu_episodes_with_npi, count_if(PROV_TIN IS NOT NULL) AS nicu_episodes_with_tin,
    count(DISTINCT PROVID) AS unique_nicu_providers_npi, count(DISTINCT PROV_TIN) AS unique_nicu_providers_tin,
    count(DISTINCT PROV_STATE) AS unique_nicu_provider_states,
    count_if(BW_CAT IS NULL) AS nicu_birth_weight_unknown, count_if(BW_CAT = 'Low') AS nicu_birth_weight_low,
    count_if(BW_CAT = 'Very Low') AS nicu_birth_weight_very_low, count_if(GA_CAT IS NULL) AS nicu_gest_age_unknown,
    count_if(GA_CAT = 'Preterm') AS nicu_gest_age_preterm, count_if(BW_CAT = 'Normal') AS nicu_birth_weight_normal,
    count_if(BW_CAT = 'Extremely Low') AS nicu_birth_weight_extremely_low, count_if(GA_CAT = 'Term') AS nicu_gest_age_term,
    count_if(GA_CAT = 'Very Preterm') AS nicu_gest_age_very_preterm,
    count_if(GA_CAT = 'Extremely Preterm') AS nicu_gest_age_extremely_preterm FROM nicu_rollup),
 cl AS (SELECT count(*) AS total_claims_processed, count_if(CLAIM_TYPE = 'IP') AS total_ip_claims,
    count_if(CLAIM_TYPE = 'OP') AS total_op_claims, count_if(NET_PD_AMT > 500000) AS claims_excluded_high_cost,
    count_if(DIAG_1_CD IS NULL) AS claims_with_null_diagnosis, count_if(NEWBORN_ICD) AS claims_matched_newborn_icd,
    count_if(NEWBORN_REV) AS claims_matched_newborn_rev, count_if(NICU_REV) AS claims_matched_nicu_rev,
    count_if(NICU_MSDRG) AS claims_matched_nicu_msdrg, count_if(NICU_APRDRG) AS claims_matched_nicu_aprdrg FROM tagged)
 SELECT 'run-0001' AS run_id, DATE '2001-12-31' AS run_date, 'DEMO' AS client_name,
   DATE '1999-08-01' AS birth_window_start, DATE '2000-08-01' AS birth_window_mid,
   DATE '2001-07-31' AS birth_window_end, DATE '2001-10-31' AS runout_end_date,
   TIMESTAMP '2001-12-31 06:00:00' AS etl_timestamp, DATE '2001-10-31' AS data_cutoff_date, '2' AS pipeline_version,
   'fixtures' AS data_source_version, 'spark' AS sql_engine, CAST(NULL AS BIGINT) AS processing_duration_seconds,
   CAST(NULL AS DOUBLE) AS data_quality_score, CAST(NULL AS VARCHAR) AS notes, 'claimsmith' AS created_by,
   m.*, nb.* EXCLUDE (nb_paid), nr.* EXCLUDE (nb_readm), how.*, svc.*, hs.* EXCLUDE (hosp_los, cb_claims),
   nc.* EXCLUDE (nicu_cost, prof, man, crit, fac, room, readm_paid), cl.*,
   {pct_h_sql('newborns_admitted_in_init_days', 'total_newborns_identified')} AS pct_admitted_in_init_days,
   CAST(nb_readm AS DOUBLE) AS total_readmission_paid_amt, {avg_sql('nb_readm', 'total_readmissions_count')} AS avg_readmission_paid_amt,
   CAST(readm_paid AS DOUBLE) AS total_nicu_readmit_paid_amt, {avg_sql('readm_paid', 'total_nicu_readmissions')} AS avg_nicu_readmit_paid_amt,
   {avg_sql('man', 'total_nicu_episodes')} AS avg_manageable_proffee, {avg_sql('crit', 'total_nicu_episodes')} AS avg_critical_care_proffee,
   {avg_sql('fac', 'total_nicu_episodes')} AS avg_facility_cost, {avg_sql('room', 'total_nicu_episodes')} AS avg_facility_room_cost,
   {pct_h_sql('CAST(room * 100 AS BIGINT)', 'CAST(fac * 100 AS BIGINT)')} AS pct_room_of_facility,
   {pct_h_sql('nicu_episodes_with_npi', 'total_nicu_episodes')} AS pct_nicu_episodes_with_provider,
   dsc.*, {avg_sql('cb_claims', 'total_hospital_episodes')} AS avg_claims_per_episode,
   {avg_sql('total_member_months', 'total_members_enrolled')} AS avg_member_months_per_member,
   {pct_h_sql('total_nicu_episodes', 'total_newborns_identified')} AS nicu_rate_pct,
   CAST(nb_paid AS DOUBLE) AS total_newborn_paid_amt,
   {avg_sql('nb_paid', 'total_newborns_identified')} AS avg_newborn_paid_amt,
   {avg_sql('total_newborn_los_days', 'total_newborns_identified')} AS avg_newborn_los_days,
   {avg_sql('total_hospital_episodes', 'total_newborns_identified')} AS avg_episodes_per_newborn,
   {pct_h_sql('episodes_discharge_clipped', 'total_hospital_episodes')} AS pct_episodes_discharge_clipped,
   {avg_sql('hosp_los', 'total_hospital_episodes')} AS avg_los_all_episodes,
   {avg_sql('total_nicu_los_days', 'total_nicu_episodes')} AS avg_nicu_los_days,
   CAST(nicu_cost AS DOUBLE) AS total_nicu_cost,
   {avg_sql('nicu_cost', 'total_nicu_episodes')} AS avg_nicu_cost_per_episode,
   {avg_sql('nicu_cost', 'total_nicu_los_days')} AS avg_nicu_cost_per_day,
   CAST(prof AS DOUBLE) AS total_professional_fees,
   {avg_sql('prof', 'total_nicu_episodes')} AS avg_professional_fees,
   {pct_h_sql('CAST(prof * 100 AS BIGINT)', 'CAST(nicu_cost * 100 AS BIGINT)')} AS pct_professional_fees,
   CAST(man AS DOUBLE) AS total_manageable_proffee, CAST(crit AS DOUBLE) AS total_critical_care_proffee,
   CAST(fac AS DOUBLE) AS total_facility_cost,
   {pct_h_sql('CAST(fac * 100 AS BIGINT)', 'CAST(nicu_cost * 100 AS BIGINT)')} AS pct_facility_cost,
   CAST(room AS DOUBLE) AS total_facility_room_cost,
   {pct_h_sql('nicu_episodes_with_rev_leveling', 'total_nicu_episodes')} AS pct_episodes_with_rev_leveling,
   {pct_h_sql('nicu_low_paid_cases', 'total_nicu_episodes')} AS pct_nicu_low_paid,
   {pct_h_sql('nicu_inappropriate_cases', 'total_nicu_episodes')} AS pct_nicu_inappropriate,
   {pct_h_sql('claims_with_null_diagnosis', 'total_claims_processed')} AS pct_claims_null_diagnosis,
   {pct_h_sql('newborns_previous_period', 'total_newborns_identified')} AS pct_previous_period,
   {pct_h_sql('newborns_current_period', 'total_newborns_identified')} AS pct_current_period,
   '{_CFG_HASH}' AS config_hash
 FROM m, nb, nr, how, svc, hs, nc, cl, dsc)"""

KEY_FIELDS = """VALUES ('SRVC_FROM_DT', 'DATE FIELDS'), ('SRVC_THRU_DT', 'DATE FIELDS'),
        ('PROCESS_DT', 'DATE FIELDS'), ('ADMIT_DT', 'DATE FIELDS'), ('DSCHRG_DT', 'DATE FIELDS'),
        ('DIAG_1_CD', 'DIAGNOSIS CODES'), ('DIAG_2_CD', 'DIAGNOSIS CODES'), ('DIAG_3_CD', 'DIAGNOSIS CODES'),
        ('DIAG_4_CD', 'DIAGNOSIS CODES'), ('DIAG_5_CD', 'DIAGNOSIS CODES'), ('PROC_1_CD', 'PROCEDURE CODES'),
        ('PROC_2_CD', 'PROCEDURE CODES'), ('PROC_3_CD', 'PROCEDURE CODES'), ('SBMT_CHRG_AMT', 'AMOUNT FIELDS'),
        ('NET_PD_AMT', 'AMOUNT FIELDS'), ('DRG_OTLR_COST', 'AMOUNT FIELDS'), ('DRG', 'CODE FIELDS'),
        ('RVNU_CD', 'CODE FIELDS')"""
QA_JOB = f"""SELECT 'profile' AS section, {PROFILE_OUT} FROM claims_profile UNION ALL BY NAME
  SELECT 'profile' AS section, {PROFILE_OUT} FROM members_profile UNION ALL BY NAME
  SELECT 'alerts' AS section, column_name, severity, message, table_name,
    CAST(CASE WHEN severity = 'CRITICAL' THEN 0 ELSE 1 END AS BIGINT) AS severity_order
  FROM (SELECT *, 'FA_MEDICAL' AS table_name FROM claims_alerts UNION ALL SELECT *, 'FA_MEMBERSHIP' FROM members_alerts) UNION ALL BY NAME
  SELECT 'summary' AS section, 'FA_MEDICAL' AS table_name, (SELECT count(*) FROM fx_claims) AS total_rows, CAST(31 AS BIGINT) AS expected_columns,
    CAST(24 AS BIGINT) AS found_columns, CAST(7 AS BIGINT) AS missing_columns, coalesce(count_if(severity = 'CRITICAL'), 0) AS critical_alerts,
    coalesce(count_if(severity = 'WARNING'), 0) AS warnings, coalesce(count_if(severity = 'CRITICAL'), 0) = 0 AS passed FROM claims_alerts UNION ALL BY NAME
  SELECT 'summary' AS section, 'FA_MEMBERSHIP' AS table_name, (SELECT count(*) FROM fx_membership) AS total_rows, CAST(8 AS BIGINT) AS expected_columns,
    CAST(8 AS BIGINT) AS found_columns, CAST(0 AS BIGINT) AS missing_columns, coalesce(count_if(severity = 'CRITICAL'), 0) AS critical_alerts,
    coalesce(count_if(severity = 'WARNING'), 0) AS warnings, coalesce(count_if(severity = 'CRITICAL'), 0) = 0 AS passed FROM members_alerts UNION ALL BY NAME
  SELECT 'key_fields' AS section, 'FA_MEDICAL' AS table_name, category, p.column_name, populated_pct, populated_count,
    CASE WHEN populated_pct_h >= 9000 THEN 'good' WHEN populated_pct_h >= 5000 THEN 'fair' ELSE 'poor' END AS status
  FROM claims_profile p JOIN ({KEY_FIELDS}) AS k(column_name, category) ON p.column_name = k.column_name WHERE p.key_field UNION ALL BY NAME
  SELECT 'frequency' AS section, DRG, MEMBER_COUNT, MIN_DATE, MAX_DATE, {DRG_TYPE} AS DRG_TYPE FROM {CODE_FREQ} UNION ALL BY NAME
  SELECT 'breakdown' AS section, {DRG_TYPE} AS DRG_TYPE, count(DRG) AS DRG_COUNT, CAST(sum(MEMBER_COUNT) AS BIGINT) AS TOTAL_MEMBERS
  FROM {CODE_FREQ} GROUP BY ALL UNION ALL BY NAME
  SELECT 'statistics' AS section, * FROM (CODE_STATS)"""

BODIES = {
    # 2.1 sources
    "scan_table": "SELECT INDV_ID, CLM_AUD_NBR, LINE_KEY, SRVC_FROM_DT, CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT FROM fx_claims",
    "scan_sql_bounds": "SELECT min(SRVC_FROM_DT) AS MIN_FROMDATE, max(SRVC_FROM_DT) AS MAX_FROMDATE, max(PROCESS_DT) AS MAX_PAIDDATE FROM fx_claims WHERE SRVC_FROM_DT IS NOT NULL AND PROCESS_DT IS NOT NULL",
    "scan_csv_upper": "SELECT ID, TITLE, REQUEST_DATE, CLIENT FROM fx_requests",
    "scan_optional": "SELECT ID, CASE WHEN ID % 10 = 0 OR STATUS_CHANGE_DATE IS NULL THEN NULL ELSE CAST(STATUS_CHANGE_DATE AS TIMESTAMP) END AS STATUS_CHANGE_DATE FROM fx_requests",
    "ref_codes": "SELECT DISTINCT CAST(RVNU_CD AS VARCHAR) AS CODE FROM fx_claims",
    "empty_typed": f"SELECT {CLAIM_PROJ} FROM fx_claims WHERE FALSE",
    # 2.2 sinks
    "sink_overwrite": f"SELECT {PS_COLS} FROM ps_membership",
    "upsert_merge": """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
        CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
        CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
        CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
        CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
        s.SRC_NOTE,
        CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 'UPDATED'
             WHEN s.o_orderkey IS NOT NULL THEN 'INSERTED' ELSE 'KEPT' END AS MERGE_ACTION
      FROM up_target t FULL OUTER JOIN up_source s ON t.o_orderkey = s.o_orderkey""",
    "full_refresh": f"SELECT {HOSP_COLS} FROM hosp",
    "schema_evolve": "SELECT *, CAST(NULL AS VARCHAR) AS SRC_NOTE FROM up_target UNION ALL SELECT * FROM up_source",
    "typed_table": """SELECT CAST(CAST(o_orderkey AS DECIMAL(38,0)) AS DOUBLE) AS o_orderkey,
        CAST(CAST(o_custkey AS DECIMAL(38,0)) AS DOUBLE) AS o_custkey, o_orderstatus,
        CAST(CAST(o_totalprice AS DECIMAL(38,6)) AS DOUBLE) AS o_totalprice, o_orderpriority, SRC_NOTE FROM orders_v2""",
    "normalize_dates": """SELECT ID, strftime(REQUEST_DATE, '%Y-%m-%d') AS REQUEST_DATE,
        strftime(STATUS_CHANGE_DATE, '%Y-%m-%d') AS STATUS_CHANGE_DATE, strftime(CLOSED_DATE, '%Y-%m-%d') AS CLOSED_DATE,
        CASE WHEN ID % 4 IN (0, 1) THEN strftime(REQUEST_DATE, '%Y-%m-%d') END AS RECEIVED_DATE, NICU_START FROM fx_requests""",
    "audit_append": """SELECT 'run-0001' AS RUN_ID, TIMESTAMP '2001-12-31 00:00:00' AS RUN_TIMESTAMP, t.TABLE_NAME,
        'FULL_REFRESH' AS LOAD_TYPE, t.ROWS_EXTRACTED, t.ROWS_TRANSFORMED, t.ROWS_TRANSFORMED AS ROWS_INSERTED,
        CAST(0 AS BIGINT) AS ROWS_UPDATED, 'SUCCESS' AS STATUS, CAST(NULL AS VARCHAR) AS ERROR_MESSAGE,
        'claimsmith' AS CREATED_BY
      FROM (SELECT 'REQUESTS' AS TABLE_NAME, (SELECT count(*) FROM fx_requests) AS ROWS_EXTRACTED,
                   (SELECT count(*) FROM fx_requests) AS ROWS_TRANSFORMED
            UNION ALL SELECT 'PRODUCTS', (SELECT count(*) FROM fx_requests), (SELECT count(*) FROM req_prod)) t""",
    "export_report": f"SELECT * FROM {CODE_FREQ}",
    "materialize": "SELECT INDV_ID, CLM_AUD_NBR, LINE_KEY, CLAIM_TYPE, CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT FROM tagged",
    # 2.3 projections / filters / classification
    "filter_study_window": "SELECT INDV_ID, LINE_KEY, SRVC_FROM_DT, PROCESS_DT FROM windowed",
    "filter_in_codes": f"SELECT INDV_ID, CLM_AUD_NBR, LINE_KEY FROM fx_claims WHERE {any_diag(NEWBORN_ICD)} OR substring(RVNU_CD, 1, 3) IN ('017')",
    "project_claims": f"SELECT {CLAIM_PROJ} FROM fx_claims",
    "select_existing": "SELECT INDV_ID, STUDY_YR, PRDCT_CD AS LOB, PRDCT_CD FROM ps_membership",
    "claim_type": f"SELECT LINE_KEY, {CLAIM_TYPE_EXPR} AS CLAIM_TYPE FROM (SELECT *, substring(DERIV_DRG_CD, 1, 3) AS DRG FROM fx_claims)",
    "provider_category": f"SELECT c.LINE_KEY, {__import__('oracle.ctes', fromlist=['PROV_CAT']).PROV_CAT} AS PROV_CAT FROM fx_claims c",
    "map_values": f"SELECT ID, coalesce({__import__('oracle.ctes', fromlist=['CLIENT_TYPE']).CLIENT_TYPE}, CLIENT_TYPE_DETAIL) AS CLIENT_TYPE_DETAIL FROM fx_requests",
    "fill_flags": 'SELECT ID, coalesce(NICU, FALSE) AS NICU, coalesce(MATERNITY, FALSE) AS MATERNITY, coalesce(KIDNEY, FALSE) AS KIDNEY, coalesce("CAR-T", FALSE) AS "CAR-T" FROM fx_requests',
    "flag_list_text": "SELECT ID, PRODUCTS_REQUESTED FROM req_clean",
    "high_cost_flag": "SELECT LINE_KEY, CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, NET_PD_AMT > 500000 AS HIGH_COST FROM fx_claims WHERE NOT (NET_PD_AMT > 500000)",
    "resolve_columns": """SELECT ID, TITLE, REQUEST_DATE, CLIENT, MARKET, REQUESTOR, CLIENT_TYPE_DETAIL AS CLIENT_TYPE,
        OVERALL_STATUS, PRODUCTS_REQUESTED, SALESFORCE_ID, STATUS_CHANGE_DATE, CLOSED_DATE, PTRR FROM fx_requests""",
    "stay_type_flags": "SELECT INDV_ID, LINE_KEY, ADMIT, DSCHRG, STAY_TYPE, IN_DAYS, STUDY_YR, CAST(ADMIT_GAP AS BIGINT) AS ADMIT_GAP FROM nh",
    "cost_flags": "SELECT INDV_ID, ADMIT, DSCHRG, CAST(ALL_FACILITY_COST AS DOUBLE) AS ALL_FACILITY_COST, LOW_PAID_NICU, INAPPROPRIATE_NICU FROM nicu_rollup",
    "cost_per_day": "SELECT INDV_ID, ADMIT, DSCHRG, STAY_TYPE, COST_PER_DAY FROM newborns_final",
    "discharge_rank": f"SELECT LINE_KEY, DSCHRG_STS, CAST({DISCHARGE_RANK} AS BIGINT) AS DISCHARGE_RANK FROM fx_claims",
    "lob_contract_labels": "SELECT INDV_ID, BTH_DT, EP_BIRTH_TYPE, BABY_TYPE, CONTRACT FROM newborns_pre",
    "rename_drop": "SELECT INDV_ID, LINE_KEY, LST_SRVC_DT AS SRVC_THRU_DT, PROV_NPI AS PROVID FROM fx_claims",
    "filter_since_delivery": "SELECT INDV_ID, LINE_KEY, DELIVERY_DT, SRVC_FROM_DT, HIGH_COST FROM newborn_claims",
    "filter_stay_claims": "SELECT INDV_ID, LINE_KEY, DELIVERY_DT, ADMIT_DT_FIL, DISCH_DT_FIL FROM h1",
    "split_professional_facility": "SELECT LINE_KEY, PROV_CAT, LINE_GROUP FROM sos_grouped",
    "filter_long_drg": "SELECT INDV_ID, ADMIT, DSCHRG, FINAL_DRG_CD, CAST(ALL_FACILITY_COST AS DOUBLE) AS ALL_FACILITY_COST FROM nicu_rollup WHERE STAY_TYPE = 'Long Stay' AND CONTRACT = 'DRG'",
    # 2.4 joins
    "join_inner_using": "SELECT e.INDV_ID, e.MEM_EFF_DT, e.MEM_EXP_DT, d.GENDER, d.BTH_DT, d.STATE FROM mem_enroll e JOIN mem_demo d ON e.INDV_ID = d.INDV_ID",
    "join_left_eligibility": "SELECT INDV_ID, LINE_KEY, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE FROM claims1",
    "flag_any_of_columns": "SELECT LINE_KEY, NEWBORN_ICD, SINGLE, TWIN, MULTIPLE FROM tagged",
    "flag_code": "SELECT LINE_KEY, coalesce(RVNU_CD IN ('0170', '0171', '0172', '0173', '0174'), FALSE) AS NEWBORN_REV, coalesce(RVNU_CD IN ('0173', '0174'), FALSE) AS NICU_REV FROM fx_claims",
    "flag_code_prefix": "SELECT LINE_KEY, coalesce(substring(DERIV_DRG_CD, 1, 3) IN ('593'), FALSE) AS NICU_MSDRG, coalesce(substring(DERIV_DRG_CD, 1, 3) IN ('790'), FALSE) AS NICU_APRDRG FROM fx_claims",
    "cohort_semi_join": "SELECT INDV_ID, LINE_KEY FROM windowed WHERE INDV_ID IN (SELECT INDV_ID FROM cohort)",
    "cohort_or_join": "SELECT INDV_ID FROM cohort",
    "range_join_stay": "SELECT INDV_ID, LINE_KEY, ADMIT, DSCHRG FROM nh0",
    "range_join_nicu": "SELECT INDV_ID, LINE_KEY, ADMIT, DSCHRG, CAST(LOS AS BIGINT) AS LOS FROM nicu_claims0",
    "interval_join_readmit": "SELECT INDV_ID, ADMIT, DSCHRG, READMIT, CAST(READMIT_PAID_AMT AS DOUBLE) AS READMIT_PAID_AMT, READMIT_LOS FROM readm",
    "join_features": """SELECT INDV_ID, ADMIT, DSCHRG, CAST(ALL_PROFFEE AS DOUBLE) AS ALL_PROFFEE,
        CAST(MANAGEABLE_PROFFEE AS DOUBLE) AS MANAGEABLE_PROFFEE, CAST(CRITICAL_CARE_PROFFEE AS DOUBLE) AS CRITICAL_CARE_PROFFEE,
        CAST(FACILITY_RM_COST AS DOUBLE) AS FACILITY_RM_COST, CAST(READMIT AS BIGINT) AS READMIT, NAS, GA_CAT, BW_CAT,
        FINAL_REV_CD, FINAL_DRG_CD, PROVID FROM nicu_rollup""",
    "join_crosswalk": "SELECT LINE_KEY, INDV_ID, GENDER, PROC_CD, PROC_CD_DESC, PROCEDURE_SPECIALTY, INCLUDE_IN_ORDERING, ELIGIBLE FROM sos_pull",
    "join_padded_key": """SELECT p.OUTPATIENT_EVENT_ID, p.MBR_ZIP_CD, x.CBSA, x.CBSA_NM FROM sos_prim p
        LEFT JOIN xref_cbsa x ON lpad(CAST(p.MBR_ZIP_CD AS VARCHAR), 5, '0') = lpad(CAST(x.ELIG_ZIP_CD AS VARCHAR), 5, '0')""",
    "join_enrich_nullsafe": "SELECT ID, PRODUCT, SALESFORCE_ID, HAS_VALUE FROM req_enriched",
    "join_trimmed": f"""SELECT n.INDV_ID, n.BTH_DT, n.DELIVERY_DT, n.BUS_LINE_CD, n.LOB, n.STUDY_YR, n.STAY_TYPE, n.ADMIT,
        n.DSCHRG, CAST(n.NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, CAST(n.LOS AS BIGINT) AS LOS, n.BABY_TYPE, n.BIRTH_TYPE,
        n.CONTRACT, CAST(r.TOTAL_NICU_COST AS DOUBLE) AS TOTAL_NICU_COST, CAST(r.ALL_PROFFEE AS DOUBLE) AS ALL_PROFFEE,
        CAST(r.MANAGEABLE_PROFFEE AS DOUBLE) AS MANAGEABLE_PROFFEE, CAST(r.CRITICAL_CARE_PROFFEE AS DOUBLE) AS CRITICAL_CARE_PROFFEE,
        CAST(r.FACILITY_RM_COST AS DOUBLE) AS FACILITY_RM_COST, r.NAS, CAST(r.READMIT AS BIGINT) AS READMIT,
        CAST(r.READMIT_PAID_AMT AS DOUBLE) AS READMIT_PAID_AMT, CAST(r.READMIT_LOS AS BIGINT) AS READMIT_LOS, r.GA_CAT,
        r.BW_CAT, r.FINAL_REV_CD, r.REV_LEVELING, r.FINAL_DRG_CD, r.PROVID, r.PROV_TIN, r.PROV_FULL_NM, r.PROV_STATE,
        CAST(r.ALL_FACILITY_COST AS DOUBLE) AS ALL_FACILITY_COST, r.LOW_PAID_NICU, r.INAPPROPRIATE_NICU
      FROM newborn_ident n LEFT JOIN nicu_rollup r ON n.INDV_ID = r.INDV_ID AND n.ADMIT = r.ADMIT AND n.DSCHRG = r.DSCHRG""",
    "join_provider_dim": """SELECT INDV_ID, ADMIT, DSCHRG, DELIVERY_DT, CAST(LOS AS BIGINT) AS LOS, PROVID,
        CAST(HOSPPAID AS DOUBLE) AS HOSPPAID, HOSPADMIT, HOSPDISCHG, CAST(HOSPLOS AS BIGINT) AS HOSPLOS, PROV_TIN,
        PROV_FULL_NM, PROV_STATE FROM nicu_provider""",
    # 2.5 aggregations
    "agg_member_months": f"SELECT {PS_COLS} FROM ps_membership",
    "agg_newborn_flags": """SELECT INDV_ID, BTH_DT, SVC_DATE, CAST(HAS_NICU_REV AS BIGINT) AS HAS_NICU_REV,
        CAST(HAS_NICU_MSDRG AS BIGINT) AS HAS_NICU_MSDRG, CAST(HAS_NICU_APRDRG AS BIGINT) AS HAS_NICU_APRDRG,
        EP_BIRTH_TYPE, IN_DAYS, BABY_TYPE, CONTRACT, DELIVERY_DT FROM newborns_pre""",
    "agg_stay": "SELECT INDV_ID, DELIVERY_DT, CAST(HOSP_STAY AS BIGINT) AS HOSP_STAY, CAST(PAID_AMT AS DOUBLE) AS PAID_AMT FROM hosp",
    "agg_episode": """SELECT INDV_ID, BTH_DT, DELIVERY_DT, ADMIT, DSCHRG, CAST(LOS AS BIGINT) AS LOS, STAY_TYPE, BIRTH_TYPE,
        CONTRACT, BUS_LINE_CD, LOB, STUDY_YR, CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, BABY_TYPE FROM episodes""",
    "agg_newborn": f"SELECT {NB_IDENT_COLS} FROM newborn_ident",
    "agg_prof_fees": f"SELECT {STAY}, CAST(ALL_PROFFEE AS DOUBLE) AS ALL_PROFFEE FROM all_prof",
    "agg_manageable_fees": f"SELECT {STAY}, CAST(MANAGEABLE_PROFFEE AS DOUBLE) AS MANAGEABLE_PROFFEE, MANAGEABLE_SVC_DAYS FROM man_aggs",
    "agg_critical_fees": f"SELECT {STAY}, CAST(CRITICAL_CARE_PROFFEE AS DOUBLE) AS CRITICAL_CARE_PROFFEE, CRITICAL_CARE_DAYS FROM crit_aggs",
    "agg_room_board": f"SELECT {STAY}, CAST(FACILITY_RM_COST AS DOUBLE) AS FACILITY_RM_COST FROM room",
    "agg_min_rev_code": f"SELECT {STAY}, FINAL_REV_CD FROM rev_min",
    "agg_min_drg": f"SELECT {STAY}, FINAL_DRG_CD FROM drg_min",
    "agg_median_cost": "SELECT FINAL_DRG_CD, MEDIAN_ALL_FACILITY_COST FROM drg_median",
    "agg_summary": f"""SELECT TOTAL_NICU, TOTAL_NEWBORNS, CAST(TOTAL_COST AS DOUBLE) AS TOTAL_COST, TOTAL_LOS,
        CASE WHEN TOTAL_NICU > 0 THEN CAST(TOTAL_COST AS DOUBLE) / TOTAL_NICU ELSE 0.0 END AS AVG_NICU_COST,
        CASE WHEN TOTAL_NICU > 0 THEN CAST(TOTAL_LOS AS DOUBLE) / TOTAL_NICU ELSE 0.0 END AS AVG_LOS,
        {pct_h_sql('TOTAL_NICU', 'TOTAL_NEWBORNS')} AS NICU_RATE_PCT
      FROM (SELECT (SELECT count(*) FROM nicu_ident) AS TOTAL_NICU, (SELECT count(*) FROM newborn_ident) AS TOTAL_NEWBORNS,
                   coalesce((SELECT sum(TOTAL_NICU_COST) FROM nicu_ident), 0) AS TOTAL_COST,
                   CAST(coalesce((SELECT sum(LOS) FROM nicu_ident), 0) AS BIGINT) AS TOTAL_LOS)""",
    "agg_count_by_group": "SELECT STUDY_YR, count(*) AS COUNT FROM newborn_ident GROUP BY STUDY_YR",
    "agg_not_in_ranking": "SELECT OUTPATIENT_EVENT_ID, CAST(COVERED_NOT_IN_RANKING AS DOUBLE) AS COVERED_NOT_IN_RANKING FROM sos_not_in",
    "agg_rank_buckets": """SELECT OUTPATIENT_EVENT_ID, CAST(NOT_ELIGIBLE_COVERED_AMT AS DOUBLE) AS NOT_ELIGIBLE_COVERED_AMT,
        CAST(SECONDARY_COVERED_AMT AS DOUBLE) AS SECONDARY_COVERED_AMT, CAST(TERTIARY_COVERED_AMT AS DOUBLE) AS TERTIARY_COVERED_AMT,
        CAST(ALLOTH_COVERED_AMT AS DOUBLE) AS ALLOTH_COVERED_AMT FROM sos_buckets""",
    "agg_episode_rollup": "SELECT * REPLACE (CAST(ALLW_AMT AS DOUBLE) AS ALLW_AMT, CAST(PRIMARY_COVERED_AMT AS DOUBLE) AS PRIMARY_COVERED_AMT, CAST(SECONDARY_COVERED_AMT AS DOUBLE) AS SECONDARY_COVERED_AMT, CAST(TERTIARY_COVERED_AMT AS DOUBLE) AS TERTIARY_COVERED_AMT, CAST(ALLOTH_COVERED_AMT AS DOUBLE) AS ALLOTH_COVERED_AMT, CAST(NOT_ELIGIBLE_COVERED_AMT AS DOUBLE) AS NOT_ELIGIBLE_COVERED_AMT, CAST(COVERED_NOT_IN_RANKING AS DOUBLE) AS COVERED_NOT_IN_RANKING, CAST(EPISODE_COVERED AS DOUBLE) AS EPISODE_COVERED) FROM sos_rollup",
    "profile_columns": f"SELECT {PROFILE_OUT} FROM claims_profile",
    "profile_alerts": """SELECT column_name, severity, message, 'FA_MEDICAL' AS table_name,
        CAST(CASE WHEN severity = 'CRITICAL' THEN 0 ELSE 1 END AS BIGINT) AS severity_order FROM claims_alerts""",
    "profile_summary": """SELECT 'FA_MEDICAL' AS table_name, (SELECT count(*) FROM fx_claims) AS total_rows,
        CAST(31 AS BIGINT) AS expected_columns, CAST(24 AS BIGINT) AS found_columns, CAST(7 AS BIGINT) AS missing_columns,
        count_if(severity = 'CRITICAL') AS critical_alerts, count_if(severity = 'WARNING') AS warnings,
        count_if(severity = 'CRITICAL') = 0 AS passed FROM claims_alerts""",
    "key_field_population": """SELECT category, count(*) AS n_fields,
        count_if(populated_pct_h >= 9000) AS n_good, count_if(populated_pct_h >= 5000 AND populated_pct_h < 9000) AS n_fair,
        count_if(populated_pct_h < 5000) AS n_poor,
        CAST((2 * sum(populated_pct_h) + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 AS avg_populated_pct,
        CAST(min(populated_pct_h) AS DOUBLE) / 100.0 AS min_populated_pct, CAST(max(populated_pct_h) AS DOUBLE) / 100.0 AS max_populated_pct
      FROM claims_profile p JOIN (VALUES ('SRVC_FROM_DT', 'DATE FIELDS'), ('SRVC_THRU_DT', 'DATE FIELDS'),
        ('PROCESS_DT', 'DATE FIELDS'), ('ADMIT_DT', 'DATE FIELDS'), ('DSCHRG_DT', 'DATE FIELDS'),
        ('DIAG_1_CD', 'DIAGNOSIS CODES'), ('DIAG_2_CD', 'DIAGNOSIS CODES'), ('DIAG_3_CD', 'DIAGNOSIS CODES'),
        ('DIAG_4_CD', 'DIAGNOSIS CODES'), ('DIAG_5_CD', 'DIAGNOSIS CODES'), ('PROC_1_CD', 'PROCEDURE CODES'),
        ('PROC_2_CD', 'PROCEDURE CODES'), ('PROC_3_CD', 'PROCEDURE CODES'), ('SBMT_CHRG_AMT', 'AMOUNT FIELDS'),
        ('NET_PD_AMT', 'AMOUNT FIELDS'), ('DRG_OTLR_COST', 'AMOUNT FIELDS'), ('DRG', 'CODE FIELDS'),
        ('RVNU_CD', 'CODE FIELDS')) AS c(column_name, category) USING (column_name)
      WHERE p.key_field GROUP BY category""",
    "code_frequency": f"SELECT * FROM {CODE_FREQ}",
    "code_type_breakdown": f"SELECT {DRG_TYPE} AS DRG_TYPE, count(DRG) AS DRG_COUNT, CAST(sum(MEMBER_COUNT) AS BIGINT) AS TOTAL_MEMBERS FROM {CODE_FREQ} GROUP BY 1",
    "code_frequency_stats": f"""SELECT count(*) AS TOTAL_CODES, count_if({DRG_TYPE} = 'MS-DRG') AS MS_DRG_CODES,
        count_if({DRG_TYPE} = 'APR-DRG') AS APR_DRG_CODES, count_if({DRG_TYPE} = 'Other') AS OTHER_CODES,
        avg(MEMBER_COUNT) AS AVG_MEMBERS_PER_CODE, median(CAST(MEMBER_COUNT AS DOUBLE)) AS MEDIAN_MEMBERS_PER_CODE,
        arg_min(DRG, (-MEMBER_COUNT, DRG)) AS TOP_CODE, max(MEMBER_COUNT) AS TOP_CODE_MEMBERS,
        min(MIN_DATE) AS FIRST_DATE, max(MAX_DATE) AS LAST_DATE FROM {CODE_FREQ}""",
    "null_counts": """SELECT count_if(SALESFORCE_ID IS NULL) AS NULL_SALESFORCE_ID, count_if(HAS_VALUE IS NULL) AS NULL_HAS_VALUE,
        count_if(COMPLETE_DATE IS NULL) AS NULL_COMPLETE_DATE, count_if(STATUS_CHANGE_DATE IS NULL) AS NULL_STATUS_CHANGE_DATE,
        count(DISTINCT PRODUCT) AS DISTINCT_PRODUCTS, min(REQUEST_DATE) AS MIN_DATE, max(REQUEST_DATE) AS MAX_DATE
      FROM req_metrics""",
    "run_metrics": f"SELECT * FROM {RUN_METRICS}",
    "metrics_checks": f"""SELECT 'run-0000' AS run_id, client_name, 'PERCENT_RANGE' AS violation FROM {RUN_METRICS}
        WHERE NOT (nicu_rate_pct + 100.5 BETWEEN 0 AND 100)
        UNION ALL SELECT run_id, client_name, 'DUPLICATE_KEY' FROM {RUN_METRICS}""",
    # 2.6 windows
    "latest_per_key": "SELECT * FROM mem_demo",
    "preferred_per_key": "SELECT * FROM elig",
    "first_value_date": "SELECT INDV_ID, BTH_DT, SVC_DATE, DELIVERY_DT FROM newborns_pre",
    "sessionize_gap": f"SELECT INDV_ID, DELIVERY_DT, ADMIT_DT_FIL, DISCH_DT_FIL, NEW_STAY FROM {STAY_INTERVALS}",
    "running_sum": f"SELECT INDV_ID, DELIVERY_DT, ADMIT_DT_FIL, DISCH_DT_FIL, HOSP_STAY FROM {STAY_INTERVALS}",
    "dedup_claim": "SELECT INDV_ID, DELIVERY_DT, CLM_AUD_NBR, LINE_KEY, ADMIT, DSCHRG FROM claim_base",
    "last_discharge_status": "SELECT * FROM last_status",
    "best_provider": "SELECT INDV_ID, ADMIT, DSCHRG, PROVID, CAST(HOSPPAID AS DOUBLE) AS HOSPPAID, HOSPADMIT, HOSPDISCHG, CAST(HOSPLOS AS BIGINT) AS HOSPLOS FROM prov_best",
    "first_category": "SELECT INDV_ID, ADMIT, DSCHRG, BW_CAT FROM bw",
    "second_value": """SELECT f.*, CAST(s.REV_NUM_2 AS VARCHAR) AS SECOND_REV_CD FROM rev_features f
        LEFT JOIN rev_second s ON f.INDV_ID = s.INDV_ID AND f.ADMIT = s.ADMIT AND f.DSCHRG = s.DSCHRG""",
    "rank_by_amount": "SELECT OUTPATIENT_EVENT_ID, LINE_KEY, CAST(ALLW_AMT AS DOUBLE) AS ALLW_AMT, ELIGIBLE, RANK FROM sos_ranked",
    "primary_line": "SELECT OUTPATIENT_EVENT_ID, LINE_KEY, CAST(ALLW_AMT AS DOUBLE) AS ALLW_AMT FROM sos_prim",
    # 2.7 sorts / limits
    "sort_desc": f"SELECT * FROM {CODE_FREQ} ORDER BY MEMBER_COUNT DESC, DRG",
    "sample_distinct": """SELECT column_name, value, SAMPLE_RANK FROM (
        SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value) AS SAMPLE_RANK FROM (
          SELECT DISTINCT column_name, value FROM (
            UNPIVOT (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM fx_claims) ON COLUMNS(*) INTO NAME column_name VALUE value)))
        WHERE SAMPLE_RANK <= 5""",
    "preview_limit": f"SELECT {HOSP_COLS} FROM hosp ORDER BY PAID_AMT DESC, INDV_ID, HOSP_STAY LIMIT 10",
    "top_code": f"SELECT arg_min(DRG, (-MEMBER_COUNT, DRG)) AS TOP_CODE, max(MEMBER_COUNT) AS MEMBER_COUNT FROM {CODE_FREQ}",
    "sort_alerts": """SELECT column_name, severity, message, 'FA_MEDICAL' AS table_name,
        CAST(CASE WHEN severity = 'CRITICAL' THEN 0 ELSE 1 END AS BIGINT) AS severity_order FROM claims_alerts
        ORDER BY severity_order, column_name""",
    # 2.8 set ops / reshaping
    "cohort_union": "SELECT INDV_ID FROM cohort",
    "union_periods": """SELECT INDV_ID, MEM_EFF_DT, MEM_EXP_DT, 'Previous' AS STUDY_YR, CAST(MMYR1 AS BIGINT) AS MEMBER_MONTHS
        FROM mem_base2 WHERE MMYR1 > 0 UNION ALL
        SELECT INDV_ID, MEM_EFF_DT, MEM_EXP_DT, 'Current', CAST(MMYR2 AS BIGINT) FROM mem_base2 WHERE MMYR2 > 0""",
    "unpivot_codes": "SELECT * FROM diag_tmp",
    "period_compare": f"""SELECT run_id, client_name, 'Previous Period' AS period, newborns_previous_period AS newborns,
        nicu_episodes_previous AS nicu_episodes, {pct_h_sql('nicu_episodes_previous', 'newborns_previous_period')} AS nicu_rate_pct
        FROM {RUN_METRICS} UNION ALL
        SELECT run_id, client_name, 'Current Period', newborns_current_period, nicu_episodes_current,
        {pct_h_sql('nicu_episodes_current', 'newborns_current_period')} FROM {RUN_METRICS}""",
    "trend_query": f"""SELECT client_name, run_date, birth_window_start, birth_window_end, total_newborns_identified,
        total_nicu_episodes, nicu_rate_pct, avg_nicu_cost_per_episode, avg_nicu_los_days, pct_nicu_inappropriate,
        pct_nicu_low_paid FROM {RUN_METRICS} WHERE client_name = 'DEMO' ORDER BY run_date DESC""",
    "distinct_rows": "SELECT DISTINCT INDV_ID, MEM_EFF_DT, MEM_EXP_DT FROM fx_membership",
    "missing_columns": "SELECT column_name, (SELECT count(*) FROM fx_claims) AS n_rows FROM (VALUES ('SRVC_THRU_DT'), ('DSCHRG_DT'), ('DRG'), ('DRG_TYPE'), ('DRG_OTLR_FLG'), ('DRG_OTLR_COST'), ('PROVID')) AS t(column_name)",
    "explode_products": "SELECT * FROM req_prod",
    # 2.9 scalar
    "scalar_dates": f"""SELECT ROW_KEY, CAST(strptime(YEARMO || '01', '%Y%m%d') AS DATE) AS MM_DATE,
        date_diff('day', MEM_EFF_DT, MEM_EXP_DT) AS DAYS,
        (year(MEM_EXP_DT) - year(MEM_EFF_DT)) * 12 + month(MEM_EXP_DT) - month(MEM_EFF_DT) AS MONTHS_CROSSED,
        year(MEM_EFF_DT) - year(BTH_DT) AS YEARS_CROSSED,
        CASE WHEN MEM_EFF_DT IS NULL OR BTH_DT IS NULL THEN NULL ELSE greatest(MEM_EFF_DT, BTH_DT) END AS STRICT_GREATEST,
        CASE WHEN MEM_EXP_DT IS NULL THEN NULL ELSE least(MEM_EXP_DT, DATE '2001-07-31') END AS STRICT_LEAST,
        MEM_EFF_DT + 4 AS PLUS_4, strftime(MEM_EFF_DT, '%Y-%m-%d') AS ISO_TEXT, strftime(MEM_EFF_DT, '%b %Y') AS MONTH_LABEL,
        lpad(CAST(month(MEM_EFF_DT) AS VARCHAR), 2, '0') AS MONTH_2,
        date_diff('day', MEM_EFF_DT, {AS_OF}) AS DAYS_TO_CLOCK FROM fx_membership""",
    "scalar_strings": f"""SELECT LINE_KEY,
        INDV_ID || lpad(CAST(year(SRVC_FROM_DT) AS VARCHAR), 4, '0') || lpad(CAST(month(SRVC_FROM_DT) AS VARCHAR), 2, '0')
          || lpad(CAST(day(SRVC_FROM_DT) AS VARCHAR), 2, '0') AS EVENT_ID,
        substring(RVNU_CD, 1, 3) AS REV3, substring(DERIV_DRG_CD, 1, 3) AS DRG3,
        DIAG_1_CD IN {inlist(NEWBORN_ICD)} AS IN_CODES, RVNU_CD BETWEEN '0100' AND '0210' AS REV_BETWEEN,
        starts_with(RVNU_CD, '045') AS REV_STARTS, regexp_matches(RVNU_CD, '^(01|02|03|05|06|049|045)') AS REV_RLIKE,
        CAST(length(DSCHRG_STS) AS BIGINT) AS STS_LEN, CAST(TRY_CAST(RVNU_CD AS DECIMAL(38,0)) AS VARCHAR) AS REV_NUM_TEXT,
        INDV_ID || '-' || PROC_CD AS CONCAT_NULL,
        CASE WHEN CLM_AUD_NBR IS NOT NULL THEN 'https://requests.example.org/DispForm.aspx?ID=' || CLM_AUD_NBR END AS URL
      FROM fx_claims""",
    "scalar_numbers": f"""SELECT LINE_KEY, coalesce(ADMIT_DT, SRVC_FROM_DT) AS COALESCED,
        CASE WHEN NET_PD_AMT > 1000 THEN 'big' ELSE 'small' END AS SIZE,
        abs(date_diff('day', DISCH_DT, ADMIT_DT)) AS ABS_DAYS, CAST(TRY_CAST(PROC_CD AS DECIMAL(38,0)) AS DOUBLE) AS PROC_NUM,
        CAST(round(NET_PD_AMT, 0) AS DOUBLE) AS ROUNDED, {pct_h_sql('length(LINE_KEY)', '7')} AS PCT FROM fx_claims""",
    # 2.10 temporal
    "study_window_24m": """SELECT MIN_FROMDATE, MAX_FROMDATE, MAX_PAIDDATE, N_MONTHS, RUNOUT_END, RUNOUT_START, WINDOW_END,
        WINDOW_START, WINDOW_MID, N_MONTHS >= 24 AS ENOUGH_MONTHS FROM sw24""",
    "study_window_12m": """SELECT MIN_FROMDATE, MAX_FROMDATE, MAX_PAIDDATE, N_MONTHS, RUNOUT_END, RUNOUT_START, WINDOW_END,
        WINDOW_START, WINDOW_MID, N_MONTHS >= 12 AS ENOUGH_MONTHS FROM sw12""",
    "overlap_months": "SELECT INDV_ID, MEM_EFF_DT, MEM_EXP_DT, CAST(MMYR1 AS BIGINT) AS MMYR1, CAST(MMYR2 AS BIGINT) AS MMYR2 FROM mem_base2",
    "membership_periods": f"SELECT {PS_COLS} FROM ps_membership",
    "membership_latest": "SELECT * FROM sos_mem",
    "clip_and_los": f"SELECT {HOSP_COLS} FROM hosp",
    "fill_dates": "SELECT LINE_KEY, coalesce(ADMIT_DT, SRVC_FROM_DT) AS ADMIT_DT_FIL, coalesce(DISCH_DT, LST_SRVC_DT) AS DISCH_DT_FIL FROM fx_claims",
    "request_metrics": f"SELECT {REQ_METRIC_COLS} FROM req_metrics",
    # 2.11 composite
    "tag_reference_flags": "SELECT INDV_ID, LINE_KEY, CLAIM_TYPE, NEWBORN_ICD, SINGLE, TWIN, MULTIPLE, NEWBORN_REV, NICU_REV, NICU_MSDRG, NICU_APRDRG FROM tagged",
    "newborn_rollup": "SELECT INDV_ID, LINE_KEY, EP_BIRTH_TYPE, DELIVERY_DT, IN_DAYS, BABY_TYPE, CONTRACT, CAST(BIRTH_PRI AS BIGINT) AS BIRTH_PRI, BIRTH_TYPE, HIGH_COST FROM newborn_claims",
    "hospital_rollup": f"SELECT {HOSP_COLS} FROM hosp",
    "newborn_ident": f"SELECT {NB_IDENT_COLS} FROM newborn_ident",
    "nicu_claims": "SELECT INDV_ID, LINE_KEY, ADMIT, DSCHRG, DELIVERY_DT, CAST(LOS AS BIGINT) AS LOS, CAST(NET_PD_AMT AS DOUBLE) AS NET_PD_AMT, LAST_DISCHARGE_STATUS FROM nicu_claims",
    "nicu_rollup": f"SELECT {NICU_ROLLUP_COLS} FROM nicu_rollup",
    "nas_flag": f"SELECT {STAY}, NAS FROM nas",
    "newborns_final": f"SELECT {FINAL_COLS} FROM newborns_final",
    "newborn_by_tables": f"SELECT {FINAL_COLS} FROM newborns_final",
    "newborn_end_to_end": f"SELECT {FINAL_COLS} FROM newborns_final",  # over the window of the claims, see oracle_sql
    "sos_data_pull": f"SELECT {SOS_PULL_COLS} FROM sos_pull",
    "sos_event_id": "SELECT LINE_KEY, INDV_ID, SRVC_FROM_DT, OUTPATIENT_EVENT_ID FROM sos_ev",
    "sos_rollup": "SELECT * REPLACE (CAST(ALLW_AMT AS DOUBLE) AS ALLW_AMT, CAST(PRIMARY_COVERED_AMT AS DOUBLE) AS PRIMARY_COVERED_AMT, CAST(SECONDARY_COVERED_AMT AS DOUBLE) AS SECONDARY_COVERED_AMT, CAST(TERTIARY_COVERED_AMT AS DOUBLE) AS TERTIARY_COVERED_AMT, CAST(ALLOTH_COVERED_AMT AS DOUBLE) AS ALLOTH_COVERED_AMT, CAST(NOT_ELIGIBLE_COVERED_AMT AS DOUBLE) AS NOT_ELIGIBLE_COVERED_AMT, CAST(COVERED_NOT_IN_RANKING AS DOUBLE) AS COVERED_NOT_IN_RANKING, CAST(EPISODE_COVERED AS DOUBLE) AS EPISODE_COVERED) FROM sos_rollup",
    "request_etl": """SELECT 'PRODUCTS' AS SECTION, ID, TITLE, strftime(REQUEST_DATE, '%Y-%m-%d') AS REQUEST_DATE, CLIENT, MARKET, REQUESTOR,
        CLIENT_TYPE, OVERALL_STATUS, PRODUCTS_REQUESTED, SALESFORCE_ID, PRODUCT, PRODUCT_CATEGORY,
        strftime(START_DATE, '%Y-%m-%d') AS START_DATE, strftime(COMPLETE_DATE, '%Y-%m-%d') AS COMPLETE_DATE, STATUS,
        strftime(STATUS_CHANGE_DATE, '%Y-%m-%d') AS STATUS_CHANGE_DATE, strftime(CLOSED_DATE, '%Y-%m-%d') AS CLOSED_DATE,
        PTRR, HAS_VALUE, DAYS_OPEN, PRODUCT_TAT, COMPLETED_PRODUCT, REQUEST_TYPE, REQUEST_YEAR, PRODUCT_OPEN,
        DAYS_ON_STATUS, NEEDS_ATTENTION, URL FROM req_metrics
        UNION ALL BY NAME SELECT 'REQUESTS' AS SECTION, ID, TITLE, CLIENT, MARKET, REQUESTOR, OVERALL_STATUS, PRODUCTS_REQUESTED,
          SALESFORCE_ID, PTRR FROM req_clean
        UNION ALL BY NAME SELECT 'AUDIT' AS SECTION, RUN_ID, TIMESTAMP '2001-12-31 00:00:00' AS RUN_TIMESTAMP, TABLE_NAME, LOAD_TYPE,
          ROWS_EXTRACTED, ROWS_TRANSFORMED, ROWS_INSERTED, ROWS_UPDATED, 'SUCCESS' AS STATUS, CAST(NULL AS VARCHAR) AS ERROR_MESSAGE,
          'claimsmith' AS CREATED_BY FROM (
          SELECT 'run-0001' AS RUN_ID, 'REQUESTS' AS TABLE_NAME, 'FULL_REFRESH' AS LOAD_TYPE, odd AS ROWS_EXTRACTED, odd AS ROWS_TRANSFORMED,
            odd AS ROWS_INSERTED, CAST(0 AS BIGINT) AS ROWS_UPDATED FROM n
          UNION ALL SELECT 'run-0001', 'PRODUCTS', 'FULL_REFRESH', odd, odd_products, odd_products, 0 FROM n
          UNION ALL SELECT 'run-0002', 'REQUESTS', 'INCREMENTAL', every, every, every - odd, odd FROM n
          UNION ALL SELECT 'run-0002', 'PRODUCTS', 'FULL_REFRESH', every, products, products, 0 FROM n)""",
    "metrics_job": f"""SELECT * FROM (WITH h AS (SELECT * FROM {RUN_METRICS}), hh AS (SELECT * FROM h UNION ALL SELECT * REPLACE ('run-0000' AS run_id) FROM h)
        SELECT 'history' AS section, run_id, client_name, run_date, CAST(NULL AS VARCHAR) AS period,
          total_newborns_identified AS newborns, total_nicu_episodes AS nicu_episodes, nicu_rate_pct, CAST(NULL AS VARCHAR) AS violation FROM hh
        UNION ALL SELECT 'trend', NULL, client_name, run_date, NULL, total_newborns_identified, total_nicu_episodes, nicu_rate_pct, NULL FROM hh
        UNION ALL SELECT 'compare', run_id, client_name, NULL, 'Previous Period', newborns_previous_period, nicu_episodes_previous,
          {pct_h_sql('nicu_episodes_previous', 'newborns_previous_period')}, NULL FROM hh
        UNION ALL SELECT 'compare', run_id, client_name, NULL, 'Current Period', newborns_current_period, nicu_episodes_current,
          {pct_h_sql('nicu_episodes_current', 'newborns_current_period')}, NULL FROM hh)""",
}

ORDERS_PROFILE_COLS = [
    ("o_orderkey", True, True, "o_orderkey", "LongType()"),
    ("o_custkey", True, True, "o_custkey", "LongType()"),
    ("o_orderstatus", False, True, "o_orderstatus", "StringType()"),
    ("o_totalprice", False, True, "o_totalprice", "DoubleType()"),
    ("o_orderdate", False, True, "o_orderdate", "TimestampNTZType()"),
    ("o_orderpriority", False, True, "o_orderpriority", "StringType()"),
]
BODIES.update({
    "sessionize_events": """SELECT event_id, user_id, ts, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS SESSION_ID FROM (
          SELECT event_id, user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
              OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 1800000000
              THEN 1 ELSE 0 END AS new FROM events)""",
    "latest_order_per_customer": """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1""",
    "top_priority": """SELECT arg_min(o_orderpriority, (-N_ORDERS, o_orderpriority)) AS TOP_CODE, max(N_ORDERS) AS N_ORDERS
        FROM (SELECT o_orderpriority, count(*) AS N_ORDERS FROM orders GROUP BY o_orderpriority)""",
    "profile_orders": "SELECT " + PROFILE_OUT + " FROM (" + "\nUNION ALL\n".join(
        __import__("oracle.ctes", fromlist=["_profile_one"])._profile_one("ORDERS", "orders", *c)
        for c in ORDERS_PROFILE_COLS) + ")",
    "agg_claim_type_counts": "SELECT CLAIM_TYPE, count(*) AS COUNT FROM tagged GROUP BY CLAIM_TYPE",
})

REQUEST_COUNTS = """n AS (SELECT count(*) AS every, count_if(ID % 2 = 1) AS odd, (SELECT count(*) FROM req_prod) AS products,
    (SELECT count_if(ID % 2 = 1) FROM req_prod) AS odd_products FROM fx_requests)"""
EXTRA_CTES = f""",{REQUEST_COUNTS},
mem_base2 AS (SELECT INDV_ID, MEM_EFF_DT, MEM_EXP_DT,
    {overlap('MEM_EFF_DT', 'MEM_EXP_DT', "DATE '1999-08-01'", "DATE '2000-07-31'")} AS MMYR1,
    {overlap('MEM_EFF_DT', 'MEM_EXP_DT', "DATE '2000-08-01'", "DATE '2001-07-31'")} AS MMYR2
  FROM (SELECT DISTINCT INDV_ID, MEM_EFF_DT, MEM_EXP_DT FROM fx_membership
        WHERE INDV_ID IS NOT NULL AND YEARMO IS NOT NULL)),
sw_bounds AS (SELECT CAST(min(l_shipdate) AS DATE) AS MIN_FROMDATE, CAST(max(l_shipdate) AS DATE) AS MAX_FROMDATE,
                     CAST(max(l_shipdate) AS DATE) AS MAX_PAIDDATE FROM lineitem WHERE l_shipdate IS NOT NULL),
sw_base AS (SELECT *, (year(MAX_FROMDATE) - year(MIN_FROMDATE)) * 12 + month(MAX_FROMDATE) - month(MIN_FROMDATE) + 1 AS N_MONTHS,
                   CAST(date_trunc('month', MAX_FROMDATE) AS DATE) - 1 AS RUNOUT_END FROM sw_bounds),
sw_base2 AS (SELECT *, CAST(RUNOUT_END - INTERVAL 3 MONTH AS DATE) + 1 AS RUNOUT_START FROM sw_base),
sw24 AS (SELECT *, CAST(WINDOW_END - INTERVAL 24 MONTH AS DATE) + 1 AS WINDOW_START,
                CAST(CAST(WINDOW_END - INTERVAL 24 MONTH AS DATE) + 1 + INTERVAL 12 MONTH AS DATE) AS WINDOW_MID
         FROM (SELECT *, RUNOUT_START - 1 AS WINDOW_END FROM sw_base2)),
sw12 AS (SELECT *, CAST(WINDOW_END - INTERVAL 12 MONTH AS DATE) + 1 AS WINDOW_START,
                CAST(CAST(WINDOW_END - INTERVAL 12 MONTH AS DATE) + 1 + INTERVAL 12 MONTH AS DATE) AS WINDOW_MID
         FROM (SELECT *, RUNOUT_START - 1 AS WINDOW_END FROM sw_base2))
"""


# The study window derived from the claims themselves, for the whole chain.
CLAIM_WINDOW = """
cw0 AS (SELECT CAST(date_trunc('month', max(SRVC_FROM_DT)) AS DATE) - 1 AS RO FROM fx_claims
        WHERE SRVC_FROM_DT IS NOT NULL AND PROCESS_DT IS NOT NULL),
cw1 AS (SELECT RO, CAST(RO - INTERVAL 3 MONTH AS DATE) AS WE FROM cw0),
cw2 AS (SELECT RO, WE, CAST(WE - INTERVAL 24 MONTH AS DATE) + 1 AS WS FROM cw1),
cw AS (SELECT RO, WE, WS, CAST(WS + INTERVAL 12 MONTH AS DATE) AS MID FROM cw2)"""


def claim_window_prefix() -> str:
    """The episode chain with the fixed window's dates replaced by the derived ones."""
    chain = EPISODE_CTES
    for fixed, derived in ((PREV_HIGH, "(SELECT MID - 1 FROM cw)"), (S, "(SELECT WS FROM cw)"), (MID, "(SELECT MID FROM cw)"),
                           (E, "(SELECT WE FROM cw)"), (RO, "(SELECT RO FROM cw)")):
        chain = chain.replace(fixed, derived)
    return "WITH " + ",".join([FIXTURE_CTES, CLAIM_WINDOW, chain]) + "\n"


for _whole in ("code_frequency", "profile_columns"):  # by load: the same rows
    BODIES[_whole + "_by_load"] = BODIES[_whole]
BODIES["qa_report"] = QA_JOB.replace("CODE_STATS", BODIES["code_frequency_stats"])


def oracle_sql() -> dict:
    out = {k: PREFIX + EXTRA_CTES + "\n" + v for k, v in BODIES.items()}
    return out | {"newborn_end_to_end": claim_window_prefix() + BODIES["newborn_end_to_end"]}
