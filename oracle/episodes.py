"""DuckDB SQL for the newborn/NICU chain, written the direct way (line-level
windows, row_number picks, EXISTS for claim flags) as an independent check
of the Spark plans."""

from __future__ import annotations

S, MID, PREV_HIGH, E, RO = "DATE '1999-08-01'", "DATE '2000-08-01'", "DATE '2000-07-31'", "DATE '2001-07-31'", "DATE '2001-10-31'"
DIAG = ["DIAG_1_CD", "DIAG_2_CD", "DIAG_3_CD", "DIAG_4_CD", "DIAG_5_CD"]


def inlist(vals) -> str:
    return "(" + ", ".join("'" + v + "'" for v in vals) + ")"


def any_diag(codes, alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return "(" + " OR ".join(f"coalesce({p}{d} IN {inlist(codes)}, FALSE)" for d in DIAG) + ")"


def sgreatest(a, b):
    return f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL ELSE greatest({a}, {b}) END)"


def sleast(a, b):
    return f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL ELSE least({a}, {b}) END)"


def months_crossed(a, b):
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def overlap(eff, exp, lo, hi):
    s, e = sgreatest(eff, lo), sleast(exp, hi)
    return f"(CASE WHEN {e} < {s} THEN 0 ELSE {months_crossed(s, e)} + 1 END)"


NEWBORN_REV = ["0170", "0171", "0172", "0173", "0174"]
NICU_REV = ["0173", "0174"]
NEWBORN_ICD = ["Z3800", "Z3830", "Z3861"]
SINGLE, TWIN, MULTIPLE = ["Z3800"], ["Z3830"], ["Z3861"]
MSDRG, APRDRG = ["593"], ["790"]
MANAGEABLE = ["99233", "99479", "99480", "99478", "99231", "99232", "99462"]
CRITICAL = ["99468", "99469", "99471", "99472"]
ROOM = ["011", "012", "013", "014", "015", "016", "017", "020"]

CLAIM_TYPE = f"""CASE WHEN PL_OF_SRVC_CD = '21' OR RVNU_CD BETWEEN '0100' AND '0210' OR RVNU_CD = '0987'
      OR PROC_CD BETWEEN '99221' AND '99239' OR PROC_CD BETWEEN '99251' AND '99255'
      OR PROC_CD BETWEEN '99261' AND '99263' OR DRG IS NOT NULL THEN 'IP'
    WHEN PL_OF_SRVC_CD = '23' OR PROC_CD IN ('99281','99282','99283','99284','99285','99286','99287','99288')
      OR starts_with(RVNU_CD, '045') OR RVNU_CD = '0981' THEN 'ER' ELSE 'OP' END"""

DISCHARGE_RANK = """CASE WHEN DSCHRG_STS = '20' THEN 0 WHEN DSCHRG_STS = '07' THEN 1
    WHEN DSCHRG_STS IN ('02','05','66','43','62','63','65') THEN 2 WHEN DSCHRG_STS = '30' THEN 3
    WHEN DSCHRG_STS IN ('01','06') THEN 4
    WHEN length(DSCHRG_STS) < 2 OR DSCHRG_STS IN ('04','41','50','51','70','03','64')
      OR DSCHRG_STS BETWEEN '08' AND '19' OR DSCHRG_STS BETWEEN '21' AND '29' OR DSCHRG_STS BETWEEN '31' AND '39'
      OR DSCHRG_STS BETWEEN '44' AND '49' OR DSCHRG_STS BETWEEN '52' AND '60' OR DSCHRG_STS BETWEEN '67' AND '69'
      OR DSCHRG_STS BETWEEN '71' AND '99' THEN 6 ELSE 9 END"""

LOS = "(CASE WHEN DSCHRG = ADMIT THEN 1 ELSE date_diff('day', ADMIT, DSCHRG) END)"


def bt_label(x):
    return f"(CASE WHEN {x} = 3 THEN 'Multiple' WHEN {x} = 2 THEN 'Twin' WHEN {x} = 1 THEN 'Single' ELSE 'Unknown' END)"


EPISODE_CTES = f"""
mem_src AS (SELECT *, CAST(strptime(YEARMO || '01', '%Y%m%d') AS DATE) AS MM_DATE
            FROM fx_membership WHERE INDV_ID IS NOT NULL AND YEARMO IS NOT NULL),
mem_demo AS (SELECT INDV_ID, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID ORDER BY MM_DATE DESC NULLS LAST, ROW_KEY DESC) AS rn
  FROM mem_src) WHERE rn = 1),
mem_enroll AS (SELECT DISTINCT INDV_ID, MEM_EFF_DT, MEM_EXP_DT FROM mem_src),
mem_base AS (
  SELECT e.INDV_ID, e.MEM_EFF_DT, e.MEM_EXP_DT, d.GENDER, d.BTH_DT, d.BUS_LINE_CD, d.PRDCT_CD, d.STATE,
    {overlap('e.MEM_EFF_DT', 'e.MEM_EXP_DT', S, PREV_HIGH)} AS MMYR1,
    {overlap('e.MEM_EFF_DT', 'e.MEM_EXP_DT', MID, E)} AS MMYR2,
    CASE WHEN d.BTH_DT IS NULL THEN NULL ELSE year({E}) - year(d.BTH_DT) END AS AGE,
    'DEMO' AS CLIENT_NAME, 'Aug 1999 - Jul 2000' AS PREVIOUS_PERIOD, 'Aug 2000 - Jul 2001' AS CURRENT_PERIOD
  FROM mem_enroll e JOIN mem_demo d ON e.INDV_ID = d.INDV_ID),
ps_membership AS (
  SELECT INDV_ID, STUDY_YR, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE, AGE, CLIENT_NAME,
         PREVIOUS_PERIOD, CURRENT_PERIOD, CAST(sum(MEMBER_MONTHS) AS BIGINT) AS MEMBER_MONTHS
  FROM (SELECT *, 'Previous' AS STUDY_YR, MMYR1 AS MEMBER_MONTHS FROM mem_base WHERE MMYR1 > 0
        UNION ALL
        SELECT *, 'Current' AS STUDY_YR, MMYR2 AS MEMBER_MONTHS FROM mem_base WHERE MMYR2 > 0)
  GROUP BY INDV_ID, STUDY_YR, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE, AGE, CLIENT_NAME,
           PREVIOUS_PERIOD, CURRENT_PERIOD),
elig AS (SELECT INDV_ID, GENDER, BTH_DT, BUS_LINE_CD, PRDCT_CD, STATE FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID ORDER BY CASE WHEN STUDY_YR = 'Current' THEN 0 ELSE 1 END,
      BTH_DT DESC NULLS LAST, BUS_LINE_CD DESC NULLS LAST, PRDCT_CD DESC NULLS LAST, STATE DESC NULLS LAST,
      GENDER DESC NULLS LAST) AS rn
  FROM ps_membership) WHERE rn = 1),
windowed AS (SELECT * FROM fx_claims
  WHERE SRVC_FROM_DT BETWEEN {S} AND {E} AND PROCESS_DT <= {RO} AND INDV_ID IS NOT NULL),
cohort AS (
  SELECT INDV_ID FROM windowed WHERE RVNU_CD IN {inlist(NEWBORN_REV)}
  UNION SELECT INDV_ID FROM windowed WHERE {any_diag(NEWBORN_ICD)}
  UNION SELECT INDV_ID FROM windowed WHERE substring(DERIV_DRG_CD, 1, 3) IN {inlist(MSDRG)}
  UNION SELECT INDV_ID FROM windowed WHERE substring(DERIV_DRG_CD, 1, 3) IN {inlist(APRDRG)}),
claims0 AS (
  SELECT INDV_ID, CLM_AUD_NBR, LINE_KEY, SRVC_FROM_DT, LST_SRVC_DT AS SRVC_THRU_DT, PROCESS_DT, ADMIT_DT,
    DISCH_DT, DIAG_1_CD, DIAG_2_CD, DIAG_3_CD, DIAG_4_CD, DIAG_5_CD, PROC_1_CD, PROC_2_CD, PROC_3_CD, PROC_CD,
    DSCHRG_STS, SBMT_CHRG_AMT AS BILLED, substring(DERIV_DRG_CD, 1, 3) AS DRG, NET_PD_AMT, PL_OF_SRVC_CD, RVNU_CD,
    PROV_NPI AS PROVID, PROV_TIN, PROV_FULL_NM, PROV_STATE, PROV_TYP_CD
  FROM windowed WHERE INDV_ID IN (SELECT INDV_ID FROM cohort)),
claims1 AS (SELECT c.*, e.GENDER, e.BTH_DT, e.BUS_LINE_CD, e.PRDCT_CD, e.STATE, {CLAIM_TYPE} AS CLAIM_TYPE
  FROM claims0 c LEFT JOIN elig e ON c.INDV_ID = e.INDV_ID),
tagged AS (
  SELECT c.*,
    EXISTS (SELECT 1 FROM claims1 x WHERE x.INDV_ID = c.INDV_ID AND x.CLM_AUD_NBR = c.CLM_AUD_NBR
            AND {any_diag(NEWBORN_ICD, 'x')}) AS NEWBORN_ICD,
    EXISTS (SELECT 1 FROM claims1 x WHERE x.INDV_ID = c.INDV_ID AND x.CLM_AUD_NBR = c.CLM_AUD_NBR
            AND {any_diag(SINGLE, 'x')}) AS SINGLE,
    EXISTS (SELECT 1 FROM claims1 x WHERE x.INDV_ID = c.INDV_ID AND x.CLM_AUD_NBR = c.CLM_AUD_NBR
            AND {any_diag(TWIN, 'x')}) AS TWIN,
    EXISTS (SELECT 1 FROM claims1 x WHERE x.INDV_ID = c.INDV_ID AND x.CLM_AUD_NBR = c.CLM_AUD_NBR
            AND {any_diag(MULTIPLE, 'x')}) AS MULTIPLE,
    coalesce(c.RVNU_CD IN {inlist(NEWBORN_REV)}, FALSE) AS NEWBORN_REV,
    coalesce(c.RVNU_CD IN {inlist(NICU_REV)}, FALSE) AS NICU_REV,
    coalesce(substring(c.DRG, 1, 3) IN {inlist(MSDRG)}, FALSE) AS NICU_MSDRG,
    coalesce(substring(c.DRG, 1, 3) IN {inlist(APRDRG)}, FALSE) AS NICU_APRDRG
  FROM claims1 c),
c0 AS (SELECT *, CASE WHEN MULTIPLE THEN 3 WHEN TWIN THEN 2 WHEN SINGLE THEN 1 ELSE 0 END AS BIRTH_PRI,
              {bt_label("CASE WHEN MULTIPLE THEN 3 WHEN TWIN THEN 2 WHEN SINGLE THEN 1 ELSE 0 END")} AS BIRTH_TYPE
       FROM tagged),
nb0 AS (SELECT INDV_ID, BTH_DT, max(BIRTH_PRI) AS MAX_PRI, min(SRVC_FROM_DT) AS SVC_DATE,
          max(CASE WHEN NICU_REV THEN 1 ELSE 0 END) AS HAS_NICU_REV,
          max(CASE WHEN NICU_MSDRG THEN 1 ELSE 0 END) AS HAS_NICU_MSDRG,
          max(CASE WHEN NICU_APRDRG THEN 1 ELSE 0 END) AS HAS_NICU_APRDRG
        FROM c0 WHERE NEWBORN_ICD OR NEWBORN_REV GROUP BY INDV_ID, BTH_DT),
newborns_pre AS (SELECT INDV_ID, BTH_DT, SVC_DATE, HAS_NICU_REV, HAS_NICU_MSDRG, HAS_NICU_APRDRG,
    {bt_label("MAX_PRI")} AS EP_BIRTH_TYPE,
    abs(date_diff('day', SVC_DATE, BTH_DT)) <= 4 AS IN_DAYS,
    CASE WHEN HAS_NICU_REV = 1 OR HAS_NICU_MSDRG = 1 OR HAS_NICU_APRDRG = 1 THEN 'NICU' ELSE 'Normal Newborn' END AS BABY_TYPE,
    CASE WHEN HAS_NICU_MSDRG = 1 OR HAS_NICU_APRDRG = 1 THEN 'DRG' ELSE 'Per-Diem' END AS CONTRACT,
    first_value(SVC_DATE) OVER (PARTITION BY INDV_ID ORDER BY SVC_DATE ASC NULLS FIRST) AS DELIVERY_DT
  FROM nb0),
newborn_claims AS (
  SELECT nb.EP_BIRTH_TYPE, nb.DELIVERY_DT, nb.IN_DAYS, nb.BABY_TYPE, nb.CONTRACT, c0.*,
         c0.NET_PD_AMT > 500000 AS HIGH_COST
  FROM newborns_pre nb LEFT JOIN c0 ON nb.INDV_ID = c0.INDV_ID
  WHERE c0.SRVC_FROM_DT >= nb.DELIVERY_DT),
h1 AS (SELECT *, coalesce(ADMIT_DT, SRVC_FROM_DT) AS ADMIT_DT_FIL, coalesce(DISCH_DT, SRVC_THRU_DT) AS DISCH_DT_FIL
       FROM newborn_claims
       WHERE CLAIM_TYPE = 'IP' AND (coalesce(ADMIT_DT, SRVC_FROM_DT) >= DELIVERY_DT OR SRVC_FROM_DT >= DELIVERY_DT)
         AND NOT HIGH_COST),
h2 AS (SELECT *, CASE WHEN lag(DISCH_DT_FIL) OVER w IS NULL
                        OR date_diff('day', lag(DISCH_DT_FIL) OVER w, ADMIT_DT_FIL) > 4 THEN 1 ELSE 0 END AS NEW_STAY
       FROM h1 WINDOW w AS (PARTITION BY INDV_ID, DELIVERY_DT ORDER BY ADMIT_DT_FIL ASC NULLS FIRST, DISCH_DT_FIL ASC NULLS FIRST,
                            LINE_KEY)),
h3 AS (SELECT *, sum(NEW_STAY) OVER (PARTITION BY INDV_ID, DELIVERY_DT ORDER BY ADMIT_DT_FIL ASC NULLS FIRST,
                  DISCH_DT_FIL ASC NULLS FIRST, LINE_KEY ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS HOSP_STAY FROM h2),
stays0 AS (SELECT INDV_ID, DELIVERY_DT, CAST(HOSP_STAY AS BIGINT) AS HOSP_STAY, min(ADMIT_DT_FIL) AS ADMIT0,
                  max(DISCH_DT_FIL) AS DSCHRG0, sum(NET_PD_AMT) AS PAID_AMT
           FROM h3 GROUP BY INDV_ID, DELIVERY_DT, HOSP_STAY),
stays1 AS (SELECT INDV_ID, DELIVERY_DT, HOSP_STAY, PAID_AMT, CAST(DSCHRG0 > {RO} AS INTEGER) AS OUT_END_DATE,
                  {sleast('DSCHRG0', RO)} AS DSCHRG, {sgreatest('ADMIT0', 'DELIVERY_DT')} AS ADMIT FROM stays0),
hosp AS (SELECT *, {LOS} AS LOS FROM stays1 WHERE {LOS} >= 1),
nh0 AS (SELECT c.INDV_ID, c.DELIVERY_DT, h.ADMIT, h.DSCHRG, h.LOS, c.CLM_AUD_NBR, c.LINE_KEY, c.SRVC_FROM_DT,
               c.SRVC_THRU_DT, c.ADMIT_DT, c.DISCH_DT, c.PROCESS_DT, c.NET_PD_AMT, c.PROC_CD, c.RVNU_CD, c.DRG,
               c.DIAG_1_CD, c.DIAG_2_CD, c.DIAG_3_CD, c.DIAG_4_CD, c.DIAG_5_CD, c.PROC_1_CD, c.PROC_2_CD,
               c.PROC_3_CD, c.BUS_LINE_CD, c.PRDCT_CD, c.BTH_DT, c.BIRTH_TYPE, c.BABY_TYPE, c.CONTRACT,
               c.DSCHRG_STS, c.PROVID, c.PROV_TIN, c.PROV_FULL_NM, c.PROV_STATE
        FROM newborn_claims c JOIN hosp h ON c.INDV_ID = h.INDV_ID AND c.DELIVERY_DT = h.DELIVERY_DT
        WHERE h.ADMIT <= c.SRVC_FROM_DT AND c.SRVC_FROM_DT <= h.DSCHRG AND NOT c.HIGH_COST),
nh AS (SELECT *, CASE WHEN LOS >= 3 THEN 'Long Stay' ELSE 'Short Stay' END AS STAY_TYPE,
              ADMIT <= DELIVERY_DT + 4 AS IN_DAYS,
              CASE WHEN DELIVERY_DT >= {S} AND DELIVERY_DT < {MID} THEN 'Previous' ELSE 'Current' END AS STUDY_YR,
              date_diff('day', DELIVERY_DT, ADMIT) AS ADMIT_GAP
       FROM nh0 WHERE date_diff('day', DELIVERY_DT, ADMIT) < 30 AND ADMIT <= DELIVERY_DT + 4),
claim_base AS (SELECT * EXCLUDE (rn), PRDCT_CD AS LOB FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID, DELIVERY_DT, CLM_AUD_NBR
      ORDER BY SRVC_THRU_DT DESC NULLS LAST, SRVC_FROM_DT DESC NULLS LAST, ADMIT DESC, DSCHRG DESC, LINE_KEY DESC) AS rn
  FROM nh) WHERE rn = 1),
episodes AS (SELECT INDV_ID, BTH_DT, DELIVERY_DT, ADMIT, DSCHRG, LOS, STAY_TYPE, BIRTH_TYPE, CONTRACT, BUS_LINE_CD,
                    LOB, STUDY_YR, sum(NET_PD_AMT) AS NET_PD_AMT, min(BABY_TYPE) AS BABY_TYPE
             FROM claim_base GROUP BY INDV_ID, BTH_DT, DELIVERY_DT, ADMIT, DSCHRG, LOS, STAY_TYPE, BIRTH_TYPE,
                                      CONTRACT, BUS_LINE_CD, LOB, STUDY_YR),
nb_ident0 AS (SELECT INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE, min(ADMIT) AS ADMIT,
                     max(DSCHRG) AS DSCHRG, sum(NET_PD_AMT) AS NET_PD_AMT,
                     max(CASE WHEN BABY_TYPE = 'NICU' THEN 1 ELSE 0 END) AS ANY_NICU,
                     max(CASE WHEN BIRTH_TYPE = 'Multiple' THEN 3 WHEN BIRTH_TYPE = 'Twin' THEN 2
                              WHEN BIRTH_TYPE = 'Single' THEN 1 ELSE 0 END) AS BT_PRI,
                     max(CASE WHEN CONTRACT = 'DRG' THEN 1 ELSE 0 END) AS ANY_DRG
              FROM episodes GROUP BY INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE),
newborn_ident AS (SELECT INDV_ID, BTH_DT, DELIVERY_DT, BUS_LINE_CD, LOB, STUDY_YR, STAY_TYPE, ADMIT, DSCHRG,
                         NET_PD_AMT, {LOS} AS LOS,
                         CASE WHEN ANY_NICU = 1 THEN 'NICU' ELSE 'Normal Newborn' END AS BABY_TYPE,
                         {bt_label('BT_PRI')} AS BIRTH_TYPE,
                         CASE WHEN ANY_DRG = 1 THEN 'DRG' ELSE 'Per-Diem' END AS CONTRACT
                  FROM nb_ident0),
nicu_ident AS (SELECT * EXCLUDE (NET_PD_AMT), NET_PD_AMT AS TOTAL_NICU_COST FROM newborn_ident WHERE BABY_TYPE = 'NICU'),
nicu_claims0 AS (SELECT c.INDV_ID, c.CLM_AUD_NBR, c.LINE_KEY, c.SRVC_FROM_DT, c.SRVC_THRU_DT, c.ADMIT_DT, c.DISCH_DT,
                        c.PROVID, c.PROC_CD, c.RVNU_CD, c.DRG, c.DSCHRG_STS, c.NET_PD_AMT, c.DIAG_1_CD, c.DIAG_2_CD,
                        c.DIAG_3_CD, c.DIAG_4_CD, c.DIAG_5_CD, c.PROC_1_CD, c.PROC_2_CD, c.PROC_3_CD,
                        c.DELIVERY_DT, c.LOS, n.ADMIT, n.DSCHRG
                 FROM claim_base c JOIN nicu_ident n ON c.INDV_ID = n.INDV_ID
                 WHERE c.SRVC_FROM_DT >= n.ADMIT AND c.SRVC_FROM_DT <= n.DSCHRG),
last_status AS (SELECT INDV_ID, ADMIT, DSCHRG, DSCHRG_STS AS LAST_DISCHARGE_STATUS FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID, ADMIT, DSCHRG ORDER BY {DISCHARGE_RANK} ASC,
      DISCH_DT DESC NULLS LAST, SRVC_FROM_DT DESC NULLS LAST, DSCHRG_STS ASC, CLM_AUD_NBR ASC, LINE_KEY ASC) AS rn
  FROM nicu_claims0 WHERE DSCHRG_STS IS NOT NULL) WHERE rn = 1),
nicu_claims AS (SELECT c.*, l.LAST_DISCHARGE_STATUS FROM nicu_claims0 c
                LEFT JOIN last_status l ON c.INDV_ID = l.INDV_ID AND c.ADMIT = l.ADMIT AND c.DSCHRG = l.DSCHRG),
prov_ep AS (SELECT INDV_ID, ADMIT, DSCHRG, DELIVERY_DT, LOS, PROVID, sum(NET_PD_AMT) AS HOSPPAID,
                   min(ADMIT_DT) AS HOSPADMIT, max(DISCH_DT) AS HOSPDISCHG
            FROM nicu_claims WHERE PROVID IS NOT NULL GROUP BY INDV_ID, ADMIT, DSCHRG, DELIVERY_DT, LOS, PROVID),
prov_ep2 AS (SELECT *, CASE WHEN HOSPDISCHG = DSCHRG THEN date_diff('day', HOSPADMIT, HOSPDISCHG)
                            ELSE date_diff('day', HOSPADMIT, HOSPDISCHG) + 1 END AS HOSPLOS FROM prov_ep),
prov_best AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID, ADMIT, DSCHRG ORDER BY HOSPDISCHG DESC NULLS LAST,
      HOSPLOS DESC NULLS LAST, HOSPPAID DESC NULLS LAST, PROVID DESC, DELIVERY_DT DESC, LOS DESC) AS rn
  FROM prov_ep2) WHERE rn = 1),
hosplist AS (SELECT DISTINCT PROVID, PROV_TIN, PROV_FULL_NM, PROV_STATE FROM newborn_claims WHERE PROVID IS NOT NULL),
nicu_provider AS (SELECT b.*, h.PROV_TIN, coalesce(h.PROV_FULL_NM, 'Unknown') AS PROV_FULL_NM,
                         coalesce(h.PROV_STATE, 'Unknown') AS PROV_STATE
                  FROM prov_best b LEFT JOIN hosplist h ON b.PROVID = h.PROVID),
rev_ep AS (SELECT DISTINCT INDV_ID, ADMIT, DSCHRG, TRY_CAST(RVNU_CD AS DECIMAL(38,0)) AS REV_NUM FROM nicu_claims
           WHERE TRY_CAST(RVNU_CD AS DECIMAL(38,0)) BETWEEN 170 AND 179),
rev_min AS (SELECT INDV_ID, ADMIT, DSCHRG, CAST(min(REV_NUM) AS VARCHAR) AS FINAL_REV_CD FROM rev_ep GROUP BY ALL),
rev_second AS (SELECT INDV_ID, ADMIT, DSCHRG, REV_NUM AS REV_NUM_2 FROM (
  SELECT *, row_number() OVER (PARTITION BY INDV_ID, ADMIT, DSCHRG ORDER BY REV_NUM) AS rn FROM rev_ep) WHERE rn = 2),
rev_features AS (SELECT m.INDV_ID, m.ADMIT, m.DSCHRG, m.FINAL_REV_CD, s.REV_NUM_2 IS NOT NULL AS REV_LEVELING
                 FROM rev_min m LEFT JOIN rev_second s
                 ON m.INDV_ID = s.INDV_ID AND m.ADMIT = s.ADMIT AND m.DSCHRG = s.DSCHRG),
drg_min AS (SELECT INDV_ID, ADMIT, DSCHRG, CAST(min(TRY_CAST(DRG AS DECIMAL(38,0))) AS VARCHAR) AS FINAL_DRG_CD
            FROM nicu_claims WHERE TRY_CAST(DRG AS DECIMAL(38,0)) BETWEEN 580 AND 640
               OR TRY_CAST(DRG AS DECIMAL(38,0)) BETWEEN 789 AND 795 GROUP BY INDV_ID, ADMIT, DSCHRG),
prof AS (SELECT * FROM nicu_claims WHERE PROC_CD IS NOT NULL),
all_prof AS (SELECT INDV_ID, ADMIT, DSCHRG, sum(NET_PD_AMT) AS ALL_PROFFEE FROM prof GROUP BY ALL),
man_aggs AS (SELECT INDV_ID, ADMIT, DSCHRG, sum(NET_PD_AMT) AS MANAGEABLE_PROFFEE,
                    count(DISTINCT INDV_ID || '-' || strftime(ADMIT, '%Y-%m-%d') || '-' || strftime(DSCHRG, '%Y-%m-%d')
                          || '-' || strftime(SRVC_FROM_DT, '%Y-%m-%d') || '-' || PROC_CD) AS MANAGEABLE_SVC_DAYS
             FROM prof WHERE PROC_CD IN {inlist(MANAGEABLE)} GROUP BY INDV_ID, ADMIT, DSCHRG),
crit_aggs AS (SELECT INDV_ID, ADMIT, DSCHRG, sum(NET_PD_AMT) AS CRITICAL_CARE_PROFFEE,
                     count(DISTINCT INDV_ID || '-' || strftime(ADMIT, '%Y-%m-%d') || '-' || strftime(DSCHRG, '%Y-%m-%d')
                           || '-' || strftime(SRVC_FROM_DT, '%Y-%m-%d')) AS CRITICAL_CARE_DAYS
              FROM prof WHERE PROC_CD IN {inlist(CRITICAL)} GROUP BY INDV_ID, ADMIT, DSCHRG),
room AS (SELECT INDV_ID, ADMIT, DSCHRG, sum(NET_PD_AMT) AS FACILITY_RM_COST FROM nicu_claims
         WHERE substring(RVNU_CD, 1, 3) IN {inlist(ROOM)} AND PROC_CD IS NULL GROUP BY INDV_ID, ADMIT, DSCHRG),
readm AS (SELECT n.INDV_ID, n.ADMIT, n.DSCHRG, count(DISTINCT h.ADMIT) AS READMIT, sum(h.PAID_AMT) AS READMIT_PAID_AMT,
                 CAST(sum(h.LOS) AS BIGINT) AS READMIT_LOS
          FROM nicu_ident n JOIN hosp h ON n.INDV_ID = h.INDV_ID
          WHERE h.ADMIT > n.DSCHRG AND date_diff('day', n.DSCHRG, h.ADMIT) <= 30
          GROUP BY n.INDV_ID, n.ADMIT, n.DSCHRG),
diag_tmp AS (SELECT DISTINCT INDV_ID, ADMIT, DSCHRG, DIAGTMP FROM (
  {" UNION ALL ".join(f"SELECT INDV_ID, ADMIT, DSCHRG, {d} AS DIAGTMP FROM nicu_claims WHERE {d} IS NOT NULL" for d in DIAG)})),
bw AS (SELECT INDV_ID, ADMIT, DSCHRG, BW_CAT FROM (
  SELECT d.*, r.BW_CAT, row_number() OVER (PARTITION BY d.INDV_ID ORDER BY r.BW_CAT, d.ADMIT, d.DSCHRG) AS rn
  FROM diag_tmp d JOIN (VALUES ('P0714', 'Low'), ('P0734', 'Very Low')) AS r(ICD_CODE, BW_CAT)
  ON d.DIAGTMP = r.ICD_CODE) WHERE rn = 1),
ga AS (SELECT INDV_ID, ADMIT, DSCHRG, GA_CAT FROM (
  SELECT d.*, r.GA_CAT, row_number() OVER (PARTITION BY d.INDV_ID ORDER BY r.GA_CAT, d.ADMIT, d.DSCHRG) AS rn
  FROM diag_tmp d JOIN (VALUES ('P0732', 'Preterm')) AS r(ICD_CODE, GA_CAT)
  ON d.DIAGTMP = r.ICD_CODE) WHERE rn = 1),
nas AS (SELECT DISTINCT INDV_ID, ADMIT, DSCHRG, TRUE AS NAS FROM diag_tmp WHERE DIAGTMP = 'P961'),
nicu_joined AS (
  SELECT n.*, ap.ALL_PROFFEE AS ap_fee, ma.MANAGEABLE_PROFFEE AS ma_fee, ca.CRITICAL_CARE_PROFFEE AS ca_fee,
         rm.FACILITY_RM_COST AS rm_cost, ra.READMIT, ra.READMIT_PAID_AMT, ra.READMIT_LOS, ns.NAS, g.GA_CAT, b.BW_CAT,
         rf.FINAL_REV_CD, rf.REV_LEVELING, dm.FINAL_DRG_CD, p.PROVID, p.PROV_TIN, p.PROV_FULL_NM, p.PROV_STATE
  FROM nicu_ident n
  LEFT JOIN all_prof ap USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN man_aggs ma USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN crit_aggs ca USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN room rm USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN readm ra USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN nas ns USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN ga g USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN bw b USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN rev_features rf USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN drg_min dm USING (INDV_ID, ADMIT, DSCHRG)
  LEFT JOIN nicu_provider p USING (INDV_ID, ADMIT, DSCHRG)),
nicu_rollup AS (
  SELECT * EXCLUDE (ap_fee, ma_fee, ca_fee, rm_cost, TOTAL_NICU_COST, LOS),
    coalesce(ap_fee, 0) AS ALL_PROFFEE, coalesce(ma_fee, 0) AS MANAGEABLE_PROFFEE,
    coalesce(ca_fee, 0) AS CRITICAL_CARE_PROFFEE, coalesce(rm_cost, 0) AS FACILITY_RM_COST,
    coalesce(TOTAL_NICU_COST, 0) AS TOTAL_NICU_COST, coalesce(LOS, 0) AS LOS,
    coalesce(TOTAL_NICU_COST, 0) - coalesce(ap_fee, 0) AS ALL_FACILITY_COST,
    CASE WHEN coalesce(LOS, 0) > 0 AND coalesce(TOTAL_NICU_COST, 0) / coalesce(LOS, 0) < 150 THEN TRUE ELSE FALSE END AS LOW_PAID_NICU,
    (CONTRACT = 'DRG') AND (coalesce(LOS, 0) <= 5) AND FINAL_REV_CD IN ('170', '171') AS INAPPROPRIATE_NICU
  FROM nicu_joined),
drg_median AS (SELECT FINAL_DRG_CD, median(CAST(ALL_FACILITY_COST * 100 AS BIGINT)) / 100.0 AS MEDIAN_ALL_FACILITY_COST
               FROM nicu_rollup WHERE STAY_TYPE = 'Long Stay' AND CONTRACT = 'DRG' GROUP BY FINAL_DRG_CD),
newborns_final AS (
  SELECT n.*, r.FINAL_DRG_CD, r.TOTAL_NICU_COST, r.ALL_PROFFEE, r.MANAGEABLE_PROFFEE, r.CRITICAL_CARE_PROFFEE,
         r.FACILITY_RM_COST, r.NAS, r.READMIT, r.READMIT_PAID_AMT, r.READMIT_LOS, r.GA_CAT, r.BW_CAT,
         r.FINAL_REV_CD, r.REV_LEVELING, r.PROVID, r.PROV_TIN, r.PROV_FULL_NM, r.PROV_STATE, r.ALL_FACILITY_COST,
         r.LOW_PAID_NICU, r.INAPPROPRIATE_NICU, m.MEDIAN_ALL_FACILITY_COST,
         CASE WHEN n.LOS > 0 THEN CAST(n.NET_PD_AMT AS DOUBLE) / n.LOS END AS COST_PER_DAY
  FROM newborn_ident n
  LEFT JOIN nicu_rollup r ON n.INDV_ID = r.INDV_ID AND n.ADMIT = r.ADMIT AND n.DSCHRG = r.DSCHRG
  LEFT JOIN drg_median m ON r.FINAL_DRG_CD = m.FINAL_DRG_CD)"""
