"""DuckDB CTEs for the site-of-service, request and profile workloads."""

from __future__ import annotations

from oracle.fixtures import q

SOS_S, SOS_E = "(SELECT WS FROM sos_window)", "(SELECT WE FROM sos_window)"
AS_OF = "DATE '2001-12-31'"
URL = "https://requests.example.org/DispForm.aspx?ID="


def _num_in(col, lo, hi):
    return f"(regexp_matches({col}, '^\\d+$') AND TRY_CAST({col} AS INTEGER) >= {lo} AND TRY_CAST({col} AS INTEGER) <= {hi})"


PROV_CAT = f"""CASE WHEN regexp_matches(c.RVNU_CD, '^(01|02|03|05|06|049|045)') THEN 'Facility'
      WHEN regexp_matches(c.RVNU_CD, '^(04|07|08|09)') THEN 'Professional'
      WHEN c.PL_OF_SRVC_CD IN ('21','22','23','31','32','33','34') THEN 'Facility'
      WHEN c.PL_OF_SRVC_CD IN ('11','12','20','49','50') THEN 'Professional'
      WHEN {_num_in('c.PROC_CD', 10000, 69999)} THEN 'Professional'
      WHEN {_num_in('c.PROC_CD', 70000, 79999)} THEN 'Professional'
      WHEN {_num_in('c.PROC_CD', 80000, 89999)} THEN 'Facility'
      ELSE 'Unknown' END"""

EVENT_ID = ("INDV_ID || lpad(CAST(year(SRVC_FROM_DT) AS VARCHAR), 4, '0') || lpad(CAST(month(SRVC_FROM_DT) AS VARCHAR), 2, '0')"
            " || lpad(CAST(day(SRVC_FROM_DT) AS VARCHAR), 2, '0')")

SOS_DIMS = ["BUS_LINE_CD", "OUTPATIENT_EVENT_ID", "CBSA", "CBSA_NM", "SBSCR_ID", "REL_CD", "INDV_ID", "GENDER",
            "MBR_STATE", "MBR_ZIP_CD", "PROCESS_DT", "PL_OF_SRVC_CD", "BILL_TYPE", "SRVC_FROM_DT", "PROC_CD",
            "PROC_CD_DESC", "PROCEDURE_SPECIALTY", "INCLUDE_IN_ORDERING", "ELIGIBLE", "PROV_NPI", "PROV_FULL_NM",
            "PROV_STATE", "PROV_ZIP_CD", "PROV_CAT", "ALLW_AMT"]
BUCKETS = ["SECONDARY_COVERED_AMT", "TERTIARY_COVERED_AMT", "ALLOTH_COVERED_AMT", "NOT_ELIGIBLE_COVERED_AMT",
           "COVERED_NOT_IN_RANKING"]

SOS_CTES = f"""
sos_window AS (SELECT WE, CAST(WE - INTERVAL 12 MONTH AS DATE) + 1 AS WS FROM (
  SELECT CAST(CAST(date_trunc('month', max(SRVC_FROM_DT)) AS DATE) - 1 - INTERVAL 3 MONTH AS DATE) AS WE FROM fx_claims
  WHERE SRVC_FROM_DT IS NOT NULL AND PROCESS_DT IS NOT NULL)),
sos_mem_src AS (SELECT *, CAST(strptime(MM || '01', '%Y%m%d') AS DATE) AS MM_DATE
                FROM fx_membership WHERE INDV_ID IS NOT NULL AND MM IS NOT NULL),
sos_mem AS (SELECT INDV_ID, SBSCR_ID, GENDER, BTH_DT, BUS_LINE_CD, PRODUCT, STATE, REL_CD, MBR_ZIP_CD, MM_DATE,
                   'DEMO' AS CLIENT_NAME, strftime({SOS_S}, '%b %Y') || ' - ' || strftime({SOS_E}, '%b %Y') AS STUDY_PERIOD FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID ORDER BY MM_DATE DESC NULLS LAST, ROW_KEY DESC) AS rn
  FROM sos_mem_src WHERE MM_DATE >= {SOS_S} AND MM_DATE <= {SOS_E}) WHERE rn = 1),
sos_pull AS (
  SELECT c.INDV_ID, c.LINE_KEY, m.BUS_LINE_CD, m.REL_CD, m.BTH_DT, m.GENDER, m.SBSCR_ID,
         substring(m.MBR_ZIP_CD, 1, 5) AS MBR_ZIP_CD, m.STATE AS MBR_STATE, c.PROCESS_DT, c.PL_OF_SRVC_CD,
         c.BILL_TYPE, c.SRVC_FROM_DT, c.PROC_CD, x.PROC_CD_DESC, x.ASGN_SPCLTY AS PROCEDURE_SPECIALTY,
         x.INCLD_ORDRNG AS INCLUDE_IN_ORDERING, x.ASC_ELIG AS ELIGIBLE, c.RVNU_CD, c.PROV_NPI, c.PROV_FULL_NM,
         c.PROV_STATE, substring(c.PROV_ZIP_CD, 1, 5) AS PROV_ZIP_CD, c.COV_AMT, c.ALLW_AMT, {PROV_CAT} AS PROV_CAT
  FROM fx_claims c LEFT JOIN sos_mem m ON c.INDV_ID = m.INDV_ID LEFT JOIN xref_proc x ON c.PROC_CD = x.PROC_CD
  WHERE c.SRVC_FROM_DT >= {SOS_S} AND c.LST_SRVC_DT <= {SOS_E} AND c.PL_OF_SRVC_CD IN ('22','24','19','99')),
sos_ev AS (SELECT *, {EVENT_ID} AS OUTPATIENT_EVENT_ID FROM sos_pull),
sos_grouped AS (SELECT *, CASE WHEN PROV_CAT = 'Professional' THEN 'PROFESSIONAL'
                               WHEN INCLUDE_IN_ORDERING = 'Y' THEN 'RANKABLE'
                               WHEN INCLUDE_IN_ORDERING <> 'Y' THEN 'NOT_RANKED' END AS LINE_GROUP FROM sos_ev),
sos_ranked AS (SELECT *, row_number() OVER (PARTITION BY OUTPATIENT_EVENT_ID ORDER BY ALLW_AMT DESC NULLS LAST,
                                            LINE_KEY ASC) AS RANK
               FROM sos_ev WHERE PROV_CAT <> 'Professional' AND INCLUDE_IN_ORDERING = 'Y' AND ALLW_AMT <> 0),
sos_not_in AS (SELECT OUTPATIENT_EVENT_ID, sum(ALLW_AMT) AS COVERED_NOT_IN_RANKING FROM sos_ev
               WHERE PROV_CAT <> 'Professional' AND INCLUDE_IN_ORDERING <> 'Y' GROUP BY OUTPATIENT_EVENT_ID),
sos_not_elig AS (SELECT OUTPATIENT_EVENT_ID, sum(ALLW_AMT) AS NOT_ELIGIBLE_COVERED_AMT FROM sos_ranked
                 WHERE ELIGIBLE <> 'Y' GROUP BY OUTPATIENT_EVENT_ID),
sos_sec AS (SELECT OUTPATIENT_EVENT_ID, sum(ALLW_AMT) AS SECONDARY_COVERED_AMT FROM sos_ranked
            WHERE ELIGIBLE = 'Y' AND RANK = 2 GROUP BY OUTPATIENT_EVENT_ID),
sos_ter AS (SELECT OUTPATIENT_EVENT_ID, sum(ALLW_AMT) AS TERTIARY_COVERED_AMT FROM sos_ranked
            WHERE ELIGIBLE = 'Y' AND RANK = 3 GROUP BY OUTPATIENT_EVENT_ID),
sos_oth AS (SELECT OUTPATIENT_EVENT_ID, sum(ALLW_AMT) AS ALLOTH_COVERED_AMT FROM sos_ranked
            WHERE ELIGIBLE = 'Y' AND RANK NOT IN (1, 2, 3) GROUP BY OUTPATIENT_EVENT_ID),
sos_buckets AS (SELECT e.OUTPATIENT_EVENT_ID, a.COVERED_NOT_IN_RANKING, b.NOT_ELIGIBLE_COVERED_AMT,
                       s.SECONDARY_COVERED_AMT, t.TERTIARY_COVERED_AMT, o.ALLOTH_COVERED_AMT
  FROM (SELECT DISTINCT OUTPATIENT_EVENT_ID FROM sos_ev) e
  LEFT JOIN sos_not_in a USING (OUTPATIENT_EVENT_ID) LEFT JOIN sos_not_elig b USING (OUTPATIENT_EVENT_ID)
  LEFT JOIN sos_sec s USING (OUTPATIENT_EVENT_ID) LEFT JOIN sos_ter t USING (OUTPATIENT_EVENT_ID)
  LEFT JOIN sos_oth o USING (OUTPATIENT_EVENT_ID)),
sos_prim AS (SELECT * FROM sos_ranked WHERE RANK = 1 AND ELIGIBLE = 'Y'),
sos_base AS (SELECT p.*, {", ".join("b." + x for x in BUCKETS)}, x.CBSA, x.CBSA_NM
  FROM sos_prim p LEFT JOIN sos_buckets b ON p.OUTPATIENT_EVENT_ID = b.OUTPATIENT_EVENT_ID
  LEFT JOIN xref_cbsa x ON lpad(CAST(p.MBR_ZIP_CD AS VARCHAR), 5, '0') = lpad(CAST(x.ELIG_ZIP_CD AS VARCHAR), 5, '0')),
sos_rollup AS (SELECT {", ".join(SOS_DIMS)}, count(DISTINCT OUTPATIENT_EVENT_ID) AS VOLUME,
    sum(ALLW_AMT) AS PRIMARY_COVERED_AMT, {", ".join(f"sum({x}) AS {x}" for x in BUCKETS)},
    sum(coalesce(ALLW_AMT, 0) + {" + ".join(f"coalesce({x}, 0)" for x in BUCKETS)}) AS EPISODE_COVERED
  FROM sos_base GROUP BY {", ".join(SOS_DIMS)})"""

CLIENT_TYPE = ("CASE CLIENT_TYPE_DETAIL WHEN '1' THEN 'Kind A' WHEN '2' THEN 'Kind B' WHEN '3' THEN 'Kind C' "
               "WHEN '4' THEN 'Kind D' WHEN '5' THEN 'Kind E' WHEN '6' THEN 'Kind F' WHEN '7' THEN 'None' WHEN '8' THEN 'None' END")
# Flags in the order of the products.
FLAGS = [("NICU", "Nicu"), ("MATERNITY", "Maternity"), ("KIDNEY", "Kidney"), ('"CAR-T"', "Car-T")]
FLAG_TEXT = "concat_ws(', ', " + ", ".join(f"CASE WHEN coalesce({f}, FALSE) THEN '{t}' END" for f, t in FLAGS) + ")"
PRODUCTS = [("NICU", "Clinical", "NICU", "NICU_START", "NICU_END", "NICU_STATUS"),
            ("Maternity", "Clinical", "MATERNITY", "MATERNITY_START", "MATERNITY_END", "MATERNITY_STATUS"),
            ("Kidney", "Specialty", "KIDNEY", "KIDNEY_START", "KIDNEY_END", "KIDNEY_STATUS"),
            ("CAR-T", "Specialty", '"CAR-T"', "CAR_T_START", "CAR_T_END", "CAR_T_STATUS")]


def elapsed(a, b):
    """Whole days elapsed, floored."""
    return f"CAST(floor((epoch_us(CAST({b} AS TIMESTAMP)) - epoch_us(CAST({a} AS TIMESTAMP))) / 86400000000.0) AS BIGINT)"


def _prod_select(p):
    name, cat, flag, start, end, status = p
    return (f"SELECT ID, TITLE, REQUEST_DATE, CLIENT, MARKET, REQUESTOR, CLIENT_TYPE_DETAIL AS CLIENT_TYPE, "
            f"OVERALL_STATUS, PRODUCTS_REQUESTED, SALESFORCE_ID, {q(name)} AS PRODUCT, {q(cat)} AS PRODUCT_CATEGORY, "
            f"{start} AS START_DATE, {end} AS COMPLETE_DATE, {status} AS STATUS, STATUS_CHANGE_DATE, CLOSED_DATE, PTRR "
            f"FROM req_clean WHERE {flag}")


REQUEST_CTES = f"""
req_clean AS (SELECT * REPLACE (
    coalesce({CLIENT_TYPE}, CLIENT_TYPE_DETAIL) AS CLIENT_TYPE_DETAIL,
    coalesce(NICU, FALSE) AS NICU, coalesce(MATERNITY, FALSE) AS MATERNITY, coalesce(KIDNEY, FALSE) AS KIDNEY,
    coalesce("CAR-T", FALSE) AS "CAR-T",
    coalesce(PRODUCTS_REQUESTED, CASE WHEN {FLAG_TEXT} = '' THEN 'None' ELSE {FLAG_TEXT} END) AS PRODUCTS_REQUESTED)
  FROM fx_requests),
req_prod AS ({" UNION ALL ".join(_prod_select(p) for p in PRODUCTS)}),
req_enriched AS (SELECT p.*, i.HAS_VALUE FROM req_prod p
                 LEFT JOIN fx_initiatives i ON p.SALESFORCE_ID IS NOT DISTINCT FROM i.SALESFORCE_ID),
req_metrics AS (SELECT ID, TITLE, CAST(REQUEST_DATE AS TIMESTAMP) AS REQUEST_DATE, CLIENT, MARKET, REQUESTOR,
    CLIENT_TYPE, OVERALL_STATUS, PRODUCTS_REQUESTED, SALESFORCE_ID, PRODUCT, PRODUCT_CATEGORY,
    CAST(START_DATE AS TIMESTAMP) AS START_DATE, CAST(COMPLETE_DATE AS TIMESTAMP) AS COMPLETE_DATE, STATUS,
    CAST(STATUS_CHANGE_DATE AS TIMESTAMP) AS STATUS_CHANGE_DATE, CAST(CLOSED_DATE AS TIMESTAMP) AS CLOSED_DATE, PTRR,
    HAS_VALUE,
    {elapsed('REQUEST_DATE', AS_OF)} AS DAYS_OPEN,
    {elapsed('START_DATE', 'COMPLETE_DATE')} AS PRODUCT_TAT,
    coalesce(STATUS IN ('Complete', 'Completed'), FALSE) AS COMPLETED_PRODUCT,
    CASE WHEN regexp_matches(TITLE, '\\[(.*?)\\]') THEN regexp_extract(TITLE, '\\[(.*?)\\]', 1) END AS REQUEST_TYPE,
    year(REQUEST_DATE) AS REQUEST_YEAR,
    coalesce(STATUS IN ('Not Started', 'In Progress', 'Waiting'), FALSE) AS PRODUCT_OPEN,
    coalesce({elapsed('STATUS_CHANGE_DATE', AS_OF)}, 0) AS DAYS_ON_STATUS,
    coalesce(STATUS IN ('Not Started', 'In Progress', 'Waiting'), FALSE)
      AND coalesce({elapsed('STATUS_CHANGE_DATE', AS_OF)}, 0) > 14 AS NEEDS_ATTENTION,
    CASE WHEN ID IS NOT NULL THEN '{URL}' || CAST(ID AS VARCHAR) END AS URL
  FROM req_enriched)"""

# ---------------------------------------------------------------------------
# Profile of fx_claims: expected columns that exist, with their Spark types.
# ---------------------------------------------------------------------------
CLAIMS_PROFILE_COLS = [
    ("INDV_ID", True, False, "Individual/Member ID", "StringType()"),
    ("CLM_AUD_NBR", True, False, "Claim audit number (unique claim ID)", "StringType()"),
    ("SRVC_FROM_DT", True, True, "Service from date", "DateType()"),
    ("LST_SRVC_DT", True, True, "Service through date", "DateType()"),
    ("PROCESS_DT", True, True, "Claim process date", "DateType()"),
    ("ADMIT_DT", False, True, "Hospital admission date", "DateType()"),
    ("DIAG_1_CD", True, True, "Primary diagnosis code", "StringType()"),
    ("DIAG_2_CD", False, True, "Secondary diagnosis code", "StringType()"),
    ("DIAG_3_CD", False, True, "Tertiary diagnosis code", "StringType()"),
    ("DIAG_4_CD", False, True, "Fourth diagnosis code", "StringType()"),
    ("DIAG_5_CD", False, True, "Fifth diagnosis code", "StringType()"),
    ("PROC_1_CD", False, True, "Primary procedure code", "StringType()"),
    ("PROC_2_CD", False, True, "Secondary procedure code", "StringType()"),
    ("PROC_3_CD", False, True, "Tertiary procedure code", "StringType()"),
    ("PROC_CD", False, False, "CPT/procedure code", "StringType()"),
    ("DSCHRG_STS", False, False, "Discharge status", "StringType()"),
    ("SBMT_CHRG_AMT", False, True, "Submitted charge amount", "DecimalType(18,2)"),
    ("NET_PD_AMT", True, True, "Net paid amount", "DecimalType(18,2)"),
    ("PL_OF_SRVC_CD", False, False, "Place of service code", "StringType()"),
    ("RVNU_CD", False, True, "Revenue code", "StringType()"),
    ("PROV_TIN", False, False, "Provider TIN", "StringType()"),
    ("PROV_FULL_NM", False, False, "Provider full name", "StringType()"),
    ("PROV_STATE", False, False, "Provider state", "StringType()"),
    ("PROV_TYP_CD", False, False, "Provider type code", "StringType()"),
]
CLAIMS_MISSING = [
    ("SRVC_THRU_DT", True, "Service through date"), ("DSCHRG_DT", False, "Hospital discharge date"),
    ("DRG", False, "Diagnosis Related Group code"), ("DRG_TYPE", False, "DRG type (MS-DRG, APR-DRG)"),
    ("DRG_OTLR_FLG", False, "DRG outlier flag"), ("DRG_OTLR_COST", False, "DRG outlier cost"),
    ("PROVID", False, "Provider NPI"),
]
MEMBERSHIP_PROFILE_COLS = [
    ("INDV_ID", True, False, "Individual/Member ID", "StringType()"),
    ("GENDER", False, False, "Member gender", "StringType()"),
    ("BTH_DT", True, False, "Member birth date", "DateType()"),
    ("MEM_EFF_DT", True, False, "Member effective date", "DateType()"),
    ("MEM_EXP_DT", True, False, "Member expiration date", "DateType()"),
    ("PRDCT_CD", False, False, "Product code", "StringType()"),
    ("STATE", False, False, "Member state", "StringType()"),
    ("BUS_LINE_CD", False, False, "Business line code", "StringType()"),
]


def h_pct(num, den):
    return f"(CASE WHEN {den} > 0 THEN ({num} * 20000 + {den}) // ({den} * 2) ELSE 0 END)"


def _profile_one(table, src, name, crit, key, desc, dtype):
    return f"""SELECT '{table}' AS table_name, '{name}' AS column_name, {q(desc)} AS description,
    {str(crit).upper()} AS critical, {str(key).upper()} AS key_field, '{dtype}' AS data_type,
    count(*) AS total_rows, count(*) - count({name}) AS null_count,
    CAST({h_pct(f"(count(*) - count({name}))", "count(*)")} AS DOUBLE) / 100.0 AS null_pct,
    {h_pct(f"(count(*) - count({name}))", "count(*)")} AS null_pct_h,
    count({name}) AS populated_count,
    CAST({h_pct(f"count({name})", "count(*)")} AS DOUBLE) / 100.0 AS populated_pct,
    {h_pct(f"count({name})", "count(*)")} AS populated_pct_h,
    CASE WHEN count({name}) > 0
         THEN count(DISTINCT {name}) + CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END END AS distinct_count,
    (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM {src}
       WHERE {name} IS NOT NULL ORDER BY v LIMIT 5)) AS sample_values
  FROM {src}"""


def profile_cte(cte_name, table, src, cols):
    return f"{cte_name} AS (" + "\nUNION ALL\n".join(_profile_one(table, src, *c) for c in cols) + ")"


def _tenths(num, den):
    t = f"(({num}) * 2000 + ({den})) // (({den}) * 2)"
    return f"CAST({t} // 10 AS VARCHAR) || '.' || CAST({t} % 10 AS VARCHAR)"


def alert_cte(cte_name, profile, missing):
    head = ("SELECT * FROM (VALUES " + ", ".join(
        f"({q(n)}, '{'CRITICAL' if crit else 'WARNING'}', {q(f'Missing column: {n} - {d}')})" for n, crit, d in missing)
        + ") AS t(column_name, severity, message) UNION ALL ") if missing else ""
    return f"{cte_name} AS ({head}" + f"""SELECT column_name,
        CASE WHEN critical AND null_count * 100 > total_rows * 50 THEN 'CRITICAL'
             WHEN critical AND null_count * 100 > total_rows * 10 THEN 'WARNING'
             WHEN null_count = total_rows THEN 'WARNING' END AS severity,
        CASE WHEN critical AND null_count * 100 > total_rows * 10
             THEN 'Critical column ' || column_name || ' has ' || {_tenths('null_count', 'total_rows')} || '% NULLs'
             ELSE 'Column ' || column_name || ' is completely NULL' END AS message
      FROM {profile} WHERE total_rows > 0 AND (
        (critical AND null_count * 100 > total_rows * 10) OR null_count = total_rows))"""


PROFILE_CTES = ",\n".join([
    profile_cte("claims_profile", "FA_MEDICAL", "fx_claims", CLAIMS_PROFILE_COLS),
    profile_cte("members_profile", "FA_MEMBERSHIP", "fx_membership", MEMBERSHIP_PROFILE_COLS),
    alert_cte("claims_alerts", "claims_profile", CLAIMS_MISSING),
    alert_cte("members_alerts", "members_profile", []),
])
