"""DuckDB SQL text for the fixture views (same rules as the Spark fixtures).

These CTEs are prepended to every oracle query; DuckDB only evaluates the
ones a query references.
"""

from __future__ import annotations


def amt(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def case_idx(key: str, values: list) -> str:
    parts = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} {parts} END"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


FX_CLAIMS = f"""
fx_base AS (
  SELECT o.o_custkey AS k, l.l_orderkey AS o, l.l_partkey AS p, l.l_suppkey AS s, l.l_linenumber AS n,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents,
         su.s_name, su.s_nationkey, na.n_name,
         DATE '1999-08-01' + CAST((o.o_custkey * 37) % 730 AS INTEGER) AS bth
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation na ON su.s_nationkey = na.n_nationkey),
fx_base2 AS (SELECT *, bth + CAST((o * 7 + n * 11) % 150 AS INTEGER) AS srvc FROM fx_base),
fx_claims AS (
  SELECT CAST(k AS VARCHAR) AS INDV_ID,
    CAST(o AS VARCHAR) AS CLM_AUD_NBR,
    concat_ws('-', o, n, p, s, cents) AS LINE_KEY,
    bth AS BTH_DT,
    srvc AS SRVC_FROM_DT,
    srvc + CAST(p % 4 AS INTEGER) AS LST_SRVC_DT,
    srvc + CAST(10 + s % 200 AS INTEGER) AS PROCESS_DT,
    CASE WHEN p % 3 <> 0 THEN srvc - CAST(p % 2 AS INTEGER) END AS ADMIT_DT,
    CASE WHEN p % 4 <> 0 THEN srvc + CAST(p % 6 AS INTEGER) END AS DISCH_DT,
    CASE WHEN k % 5 <> 0 THEN 'J' || CAST(100 + p % 900 AS VARCHAR)
         WHEN p % 20 = 0 AND k % 3 = 0 THEN 'Z3830'
         WHEN p % 20 = 1 AND k % 7 = 0 THEN 'Z3861'
         WHEN p % 20 < 4 THEN 'Z3800'
         WHEN p % 20 = 4 THEN 'P0714'
         WHEN p % 20 = 5 THEN 'P0732'
         WHEN p % 20 = 6 THEN 'P961' END AS DIAG_1_CD,
    CASE WHEN p % 7 = 0 AND k % 5 = 0 THEN 'P0734'
         WHEN p % 7 = 1 THEN 'J' || CAST(100 + s % 50 AS VARCHAR) END AS DIAG_2_CD,
    CASE WHEN p % 2 = 0 THEN 'J' || CAST(100 + n AS VARCHAR) END AS DIAG_3_CD,
    CAST(NULL AS VARCHAR) AS DIAG_4_CD,
    CAST(NULL AS VARCHAR) AS DIAG_5_CD,
    CASE WHEN p % 3 = 1 THEN '0B' || CAST(10 + s % 7 AS VARCHAR) END AS PROC_1_CD,
    CASE WHEN p % 5 = 2 THEN '0C' || CAST(20 + n AS VARCHAR) END AS PROC_2_CD,
    CAST(NULL AS VARCHAR) AS PROC_3_CD,
    {case_idx("s % 8", ["'99233'", "'99468'", "'99479'", "'99221'", "'99283'", None, "'43239'", "'0FT44'"])} AS PROC_CD,
    CASE WHEN k % 40 = 0 AND p % 10 = 0 THEN '593'
         WHEN k % 40 = 0 AND p % 10 = 1 THEN '790'
         WHEN p % 25 = 0 THEN '470' END AS DERIV_DRG_CD,
    {case_idx("p % 9", ["'01'", "'20'", "'07'", "'02'", "'30'", "'06'", "'04'", "'1'", None])} AS DSCHRG_STS,
    {case_idx("n % 6", ["'21'", "'23'", "'22'", "'24'", "'11'", "'19'"])} AS PL_OF_SRVC_CD,
    CASE WHEN k % 5 = 0 THEN
      {case_idx("p % 12", ["'0170'", "'0171'", "(CASE WHEN k % 20 = 0 THEN '0173' ELSE '0120' END)",
                           "(CASE WHEN k % 20 = 0 THEN '0174' ELSE '0120' END)", "'0120'", "'0450'",
                           "'0981'", "'0987'", "'ABC'", None, "'0301'", "'0301'"])}
    ELSE {case_idx("p % 6", ["'0450'", "'0301'", "'0490'", None, "'0960'", "'0360'"])} END AS RVNU_CD,
    CASE WHEN p % 50 = 0 THEN {amt("cents * 20")} ELSE {amt("cents % 1000000")} END AS NET_PD_AMT,
    CASE WHEN p % 13 = 0 THEN {amt("0")} ELSE {amt("(cents * 7) % 500000")} END AS ALLW_AMT,
    {amt("cents")} AS SBMT_CHRG_AMT,
    {amt("(cents * 3) % 500000")} AS COV_AMT,
    CASE WHEN s % 17 <> 0 THEN CAST(s AS VARCHAR) END AS PROV_NPI,
    CAST(s_nationkey AS VARCHAR) AS PROV_TIN,
    s_name AS PROV_FULL_NM,
    n_name AS PROV_STATE,
    CAST(501 + (s * 613) % 99000 AS VARCHAR) AS PROV_ZIP_CD,
    {case_idx("s % 3", ["'H'", "'P'", "'O'"])} AS PROV_TYP_CD,
    CASE WHEN n % 2 = 0 THEN '0131' ELSE '0831' END AS BILL_TYPE
  FROM fx_base2)"""

FX_MEMBERSHIP = f"""
fx_membership AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS INDV_ID,
    o.o_orderkey AS ROW_KEY,
    strftime(o.o_orderdate, '%Y%m') AS YEARMO,
    strftime(o.o_orderdate, '%Y%m') AS MM,
    CAST(date_trunc('month', o.o_orderdate) AS DATE) AS MEM_EFF_DT,
    CASE WHEN o.o_orderkey % 11 <> 0
         THEN CAST(date_trunc('month', o.o_orderdate) AS DATE) + CAST(o.o_orderkey % 400 AS INTEGER) END AS MEM_EXP_DT,
    {case_idx("o.o_custkey % 3", ["'M'", "'F'", None])} AS GENDER,
    CASE WHEN o.o_custkey % 50 <> 0 THEN DATE '1999-08-01' + CAST((o.o_custkey * 37) % 730 AS INTEGER) END AS BTH_DT,
    c.c_mktsegment AS BUS_LINE_CD,
    o.o_orderpriority AS PRDCT_CD,
    o.o_orderpriority AS PRODUCT,
    n.n_name AS STATE,
    CAST(o.o_custkey // 4 AS VARCHAR) AS SBSCR_ID,
    {case_idx("o.o_custkey % 4", ["'18'", "'01'", "'19'", "'20'"])} AS REL_CD,
    CAST(501 + (o.o_custkey * 613) % 99000 AS VARCHAR) AS MBR_ZIP_CD
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

STATUSES = ["Not Started", "In Progress", "Waiting", "Complete", "Completed"]
REQUEST_PRODUCTS = (
    ("NICU", "Clinical", "NICU", "NICU_START", "NICU_END", "NICU_STATUS"),
    ("Maternity", "Clinical", "MATERNITY", "MATERNITY_START", "MATERNITY_END", "MATERNITY_STATUS"),
    ("Kidney", "Specialty", "KIDNEY", "KIDNEY_START", "KIDNEY_END", "KIDNEY_STATUS"),
    ("CAR-T", "Specialty", "CAR-T", "CAR_T_START", "CAR_T_END", "CAR_T_STATUS"),
)


def _request_product_cols() -> str:
    out = []
    for i, (_, _, _, start, end, status) in enumerate(REQUEST_PRODUCTS):
        st = f"(day + CAST((o + {i}) % 10 AS INTEGER))"
        at = lambda d, h: f"CAST({d} AS TIMESTAMP) + to_hours(CAST({h} AS INTEGER))"
        out.append(f"{at(st, f'(o + {i}) * 7 % 24')} AS {start}")
        out.append(f"CASE WHEN (o + {i}) % 4 <> 0 THEN {at(f'({st} + CAST((o + {i}) % 30 AS INTEGER))', f'(o + {i}) * 5 % 24')} END AS {end}")
        out.append(f"{case_idx(f'(o + {i}) % 5', [q(s) for s in STATUSES])} AS {status}")
    return ",\n    ".join(out)


FX_REQUESTS = f"""
fx_req_base AS (
  SELECT o.o_orderkey AS o, o.o_custkey, CAST(o.o_orderdate AS DATE) AS day, o.o_orderpriority,
         c.c_name, c.c_mktsegment,
         {case_idx("(o.o_orderkey // 5) % 5", [q(s) for s in STATUSES])} AS overall
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
fx_requests AS (
  SELECT o AS ID,
    CASE WHEN o % 7 = 0 THEN o_orderpriority || ' request'
         WHEN o % 13 = 0 THEN '[] request'
         ELSE '[' || o_orderpriority || '] request' END AS TITLE,
    day AS REQUEST_DATE,
    c_name AS CLIENT,
    c_mktsegment AS MARKET,
    'user' || CAST(o % 20 AS VARCHAR) AS REQUESTOR,
    CAST(1 + o % 9 AS VARCHAR) AS CLIENT_TYPE_DETAIL,
    overall AS OVERALL_STATUS,
    CASE WHEN o % 3 = 0 THEN 'Listed' END AS PRODUCTS_REQUESTED,
    CASE WHEN o % 8 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS SALESFORCE_ID,
    CASE WHEN o % 9 <> 0 THEN CAST(day + CAST(o % 40 AS INTEGER) AS TIMESTAMP) + to_hours(CAST(o % 24 AS INTEGER)) END AS STATUS_CHANGE_DATE,
    CASE o % 4 WHEN 0 THEN month(day) || '/' || day(day) || '/' || year(day) WHEN 1 THEN CAST(day AS VARCHAR)
               WHEN 2 THEN 'not a date' END AS RECEIVED_DATE,
    CASE WHEN overall NOT IN ('Not Started', 'In Progress', 'Waiting') THEN day + 45 END AS CLOSED_DATE,
    CASE WHEN o % 6 = 0 THEN 'Y' ELSE 'N' END AS PTRR,
    (o % 2 = 0) AS NICU,
    (o % 3 = 0) AS MATERNITY,
    (o % 5 = 0) AS KIDNEY,
    CASE WHEN o % 11 = 0 THEN TRUE END AS "CAR-T",
    {_request_product_cols()}
  FROM fx_req_base),
fx_initiatives AS (
  SELECT CAST(c_custkey AS VARCHAR) AS SALESFORCE_ID, c_acctbal > 5000 AS HAS_VALUE
  FROM customer WHERE c_custkey % 2 = 0)"""

FX_UPSERT = """
up_target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
              FROM orders WHERE o_orderkey % 3 <> 0),
orders_v2 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
                     o_orderpriority, 'v2' AS SRC_NOTE FROM orders),
up_source AS (SELECT * FROM orders_v2 WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)"""

PROC_XWALK = (
    ("99233", "Subsequent hospital care", "Hospitalist", "Y", "Y"),
    ("99468", "Neonatal critical care", "Neonatology", "Y", "N"),
    ("99479", "Subsequent intensive care", "Neonatology", "Y", "Y"),
    ("99221", "Initial hospital care", "Hospitalist", "N", "N"),
    ("43239", "Upper GI endoscopy biopsy", "Gastroenterology", "Y", "Y"),
    ("0FT44", "Resection of gallbladder", "Surgery", "N", "Y"),
)

XREF = "\nxref_proc AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(q(v) for v in row) + ")" for row in PROC_XWALK) + \
    ") AS t(PROC_CD, PROC_CD_DESC, ASGN_SPCLTY, INCLD_ORDRNG, ASC_ELIG)),\n" + """xref_cbsa AS (
  SELECT DISTINCT CAST(501 + (c_custkey * 613) % 99000 AS INTEGER) AS ELIG_ZIP_CD,
         'C' || CAST(CAST(501 + (c_custkey * 613) % 99000 AS INTEGER) % 50 AS VARCHAR) AS CBSA,
         'Area ' || CAST(CAST(501 + (c_custkey * 613) % 99000 AS INTEGER) % 50 AS VARCHAR) AS CBSA_NM
  FROM customer WHERE c_custkey % 3 <> 0)"""

FIXTURE_CTES = ",".join([FX_CLAIMS, FX_MEMBERSHIP, FX_REQUESTS, FX_UPSERT, XREF])
