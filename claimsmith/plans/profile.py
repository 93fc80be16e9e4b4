"""Data-QA: single-pass column profiling, alerts, summaries, code frequency.

The profile unpivots the table once into (column, value-as-text) pairs.
Row, null and distinct counts come from one exact count over (column, value)
pairs, whatever the table's size;
sample values are the 5 smallest of its values per column via the salted
top-k (a column with millions of distinct values is never sorted in one task).  Percentages use integer
arithmetic (half-up to hundredths) so they are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsmith import config as K
from claimsmith.functions.exprs import is_in
from claimsmith.operators.codes import DIAG_COLS, any_column_in
from claimsmith.operators.windows import top_k_salted

# Expected claims / membership columns as (critical, key field,
# description), in source order.
CLAIMS_EXPECTED = {
    "INDV_ID": (True, False, "Individual/Member ID"),
    "CLM_AUD_NBR": (True, False, "Claim audit number (unique claim ID)"),
    "SRVC_FROM_DT": (True, True, "Service from date"),
    "SRVC_THRU_DT": (True, True, "Service through date"),
    "LST_SRVC_DT": (True, True, "Service through date"),
    "PROCESS_DT": (True, True, "Claim process date"),
    "ADMIT_DT": (False, True, "Hospital admission date"),
    "DSCHRG_DT": (False, True, "Hospital discharge date"),
    "DIAG_1_CD": (True, True, "Primary diagnosis code"),
    "DIAG_2_CD": (False, True, "Secondary diagnosis code"),
    "DIAG_3_CD": (False, True, "Tertiary diagnosis code"),
    "DIAG_4_CD": (False, True, "Fourth diagnosis code"),
    "DIAG_5_CD": (False, True, "Fifth diagnosis code"),
    "PROC_1_CD": (False, True, "Primary procedure code"),
    "PROC_2_CD": (False, True, "Secondary procedure code"),
    "PROC_3_CD": (False, True, "Tertiary procedure code"),
    "PROC_CD": (False, False, "CPT/procedure code"),
    "DSCHRG_STS": (False, False, "Discharge status"),
    "DRG": (False, True, "Diagnosis Related Group code"),
    "DRG_TYPE": (False, False, "DRG type (MS-DRG, APR-DRG)"),
    "DRG_OTLR_FLG": (False, False, "DRG outlier flag"),
    "DRG_OTLR_COST": (False, True, "DRG outlier cost"),
    "SBMT_CHRG_AMT": (False, True, "Submitted charge amount"),
    "NET_PD_AMT": (True, True, "Net paid amount"),
    "PL_OF_SRVC_CD": (False, False, "Place of service code"),
    "RVNU_CD": (False, True, "Revenue code"),
    "PROVID": (False, False, "Provider NPI"),
    "PROV_TIN": (False, False, "Provider TIN"),
    "PROV_FULL_NM": (False, False, "Provider full name"),
    "PROV_STATE": (False, False, "Provider state"),
    "PROV_TYP_CD": (False, False, "Provider type code"),
}
MEMBERSHIP_EXPECTED = {
    "INDV_ID": (True, False, "Individual/Member ID"),
    "GENDER": (False, False, "Member gender"),
    "BTH_DT": (True, False, "Member birth date"),
    "MEM_EFF_DT": (True, False, "Member effective date"),
    "MEM_EXP_DT": (True, False, "Member expiration date"),
    "PRDCT_CD": (False, False, "Product code"),
    "STATE": (False, False, "Member state"),
    "BUS_LINE_CD": (False, False, "Business line code"),
}
KEY_FIELD_CATEGORIES = (
    ("DATE FIELDS", ("SRVC_FROM_DT", "SRVC_THRU_DT", "PROCESS_DT", "ADMIT_DT", "DSCHRG_DT")),
    ("DIAGNOSIS CODES", ("DIAG_1_CD", "DIAG_2_CD", "DIAG_3_CD", "DIAG_4_CD", "DIAG_5_CD")),
    ("PROCEDURE CODES", ("PROC_1_CD", "PROC_2_CD", "PROC_3_CD")),
    ("AMOUNT FIELDS", ("SBMT_CHRG_AMT", "NET_PD_AMT", "DRG_OTLR_COST")),
    ("CODE FIELDS", ("DRG", "RVNU_CD")),
)


def hundredths_pct(num: Column, den: Column) -> Column:
    """num*100/den rounded half-up to hundredths, as an exact integer."""
    return F.when(den > 0, ((num * 20000 + den) / (den * 2)).cast("long")).otherwise(F.lit(0).cast("long"))


def tenths_text(num: Column, den: Column) -> Column:
    """num*100/den as text with one decimal, rounded half-up (exact)."""
    t = ((num * 2000 + den) / (den * 2)).cast("long")
    return F.concat((t / 10).cast("long").cast("string"), F.lit("."), (t % 10).cast("string"))


def missing_columns(df: DataFrame, expected: dict) -> list[str]:
    return [c for c in expected if c not in df.columns]


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """(column_name, value as text) of every distinct value, null included; equal values combine before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).distinct()


def value_counts(df: DataFrame, cols) -> DataFrame:
    """(column_name, value as text, n) of every distinct value, null included; equal values combine before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def sample_values(values: DataFrame, sample_size: int, salt_buckets: int, out: str = "SAMPLE_RANK") -> DataFrame:
    """The ``sample_size`` smallest non-null values of each column, ranked."""
    return top_k_salted(values.filter(F.col("value").isNotNull()), "column_name", "value", "value", sample_size,
                        salt_buckets, descending=False, out=out)


def profile_columns(df: DataFrame, expected: dict, table_name: str, salt_buckets: int = 16,
                    sample_size: int = 5, cut=None) -> DataFrame:
    """One row per expected column that exists: type, counts, percentages,
    distinct count (null counts as a value; null for a column without any
    value) and the 5 smallest distinct non-null values.

    The table is read once: one count over (column, value), combined before its
    shuffle and stored by ``cut``; row, null and distinct counts and sample
    values all come from it.
    """
    from claimsmith.sources.sinks import materialize
    spark = df.sparkSession
    cols = [c for c in expected if c in df.columns]
    if not cols:
        return spark.createDataFrame([], "table_name string, column_name string")
    values = (cut or materialize)(value_counts(df, cols))
    per = values.groupBy("column_name").agg(F.sum("n").alias("_total"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("_nulls"),
                                            F.count(F.lit(1)).alias("_n_distinct"))
    counts = {r["column_name"]: r for r in per.collect()}  # one row a column
    total = max((r["_total"] for r in counts.values()), default=0)
    nulls = {c: (counts[c]["_nulls"] or 0) if c in counts else 0 for c in cols}
    meta = spark.createDataFrame(
        [(c, str(df.schema[c].dataType), expected[c][0], expected[c][1], expected[c][2], total, nulls[c])
         for c in cols],
        "column_name string, data_type string, critical boolean, key_field boolean, description string, "
        "total_rows long, null_count long")
    n_distinct = spark.createDataFrame([(c, r["_n_distinct"]) for c, r in counts.items()], "column_name string, _n_distinct long")
    samples = (sample_values(values, sample_size, salt_buckets)
               .groupBy("column_name")
               .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("sample_values")))
    return profile_rows(meta.join(n_distinct, "column_name", "left").join(samples, "column_name", "left"), table_name)


def profile_rows(prof: DataFrame, table_name: str) -> DataFrame:
    """Profile rows from counts, ``_n_distinct`` and ``sample_values`` per column."""
    populated = F.col("total_rows") - F.col("null_count")
    null_h = hundredths_pct(F.col("null_count"), F.col("total_rows"))
    pop_h = hundredths_pct(populated, F.col("total_rows"))
    return prof.select(
        F.lit(table_name).alias("table_name"), "column_name", "description", "critical", "key_field", "data_type",
        "total_rows", "null_count", (null_h / 100.0).alias("null_pct"), null_h.alias("null_pct_h"),
        populated.alias("populated_count"), (pop_h / 100.0).alias("populated_pct"), pop_h.alias("populated_pct_h"),
        F.when(populated > 0, F.col("_n_distinct")).alias("distinct_count"),
        "sample_values")


def profile_alerts(df: DataFrame, profile: DataFrame, expected: dict, table_name: str) -> DataFrame:
    """CRITICAL/WARNING alerts: missing columns, null-heavy critical columns,
    all-null columns.  An empty table gets one CRITICAL alert and no other.
    Counts come from the profile, so the table isn't scanned again."""
    spark = df.sparkSession
    missing = [(c, "CRITICAL" if expected[c][0] else "WARNING",
                f"Missing column: {c} - {expected[c][2]}") for c in missing_columns(df, expected)]
    rows = profile.agg(F.coalesce(F.max("total_rows"), F.lit(0)).alias("_rows"))  # one row
    miss_df = (spark.createDataFrame(missing, "column_name string, severity string, message string")
               .join(F.broadcast(rows.filter(F.col("_rows") > 0)), F.lit(True)).drop("_rows"))
    crit, nul, tot = F.col("critical"), F.col("null_count"), F.col("total_rows")
    sev = (F.when(crit & (nul * 100 > tot * K.QA_CRITICAL_NULL_PCT), "CRITICAL")
           .when(crit & (nul * 100 > tot * K.QA_WARNING_NULL_PCT), "WARNING")
           .when(nul == tot, "WARNING"))
    msg = (F.when(crit & (nul * 100 > tot * K.QA_WARNING_NULL_PCT),
                  F.concat(F.lit("Critical column "), F.col("column_name"), F.lit(" has "),
                           tenths_text(nul, tot), F.lit("% NULLs")))
           .otherwise(F.concat(F.lit("Column "), F.col("column_name"), F.lit(" is completely NULL"))))
    col_alerts = (profile.filter(F.col("total_rows") > 0).select("column_name", sev.alias("severity"), msg.alias("message"))
                  .filter(F.col("severity").isNotNull()))
    empty = (rows.filter(F.col("_rows") == 0)
             .select(F.lit(None).cast("string").alias("column_name"), F.lit("CRITICAL").alias("severity"),
                     F.lit(f"Table {table_name} is empty!").alias("message")))
    return (miss_df.unionByName(col_alerts).unionByName(empty)
            .withColumn("table_name", F.lit(table_name))
            .withColumn("severity_order", F.when(F.col("severity") == "CRITICAL", 0).otherwise(1)))


def profile_summary(df: DataFrame, profile: DataFrame, alerts: DataFrame, expected: dict, table_name: str) -> DataFrame:
    """Counts of expected/found/missing columns and alerts; PASSED iff no CRITICAL.

    Rows come from the profile, so the table isn't scanned again."""
    n_missing = len(missing_columns(df, expected))
    u = (alerts.select("severity", F.lit(None).cast("long").alias("_rows"))
         .unionByName(profile.select(F.lit(None).cast("string").alias("severity"), F.col("total_rows").alias("_rows"))))
    return (u.agg(F.coalesce(F.max("_rows"), F.lit(0)).alias("total_rows"),
                  F.count_if(F.col("severity") == "CRITICAL").alias("critical_alerts"),
                  F.count_if(F.col("severity") == "WARNING").alias("warnings"))
            .select(F.lit(table_name).alias("table_name"), "total_rows",
                    F.lit(len(expected)).cast("long").alias("expected_columns"),
                    F.lit(len(expected) - n_missing).cast("long").alias("found_columns"),
                    F.lit(n_missing).cast("long").alias("missing_columns"),
                    "critical_alerts", "warnings",
                    (F.col("critical_alerts") == 0).alias("passed")))


def key_field_population(profile: DataFrame) -> DataFrame:
    """Status per key field (good >= 90%, fair >= 50%, poor) and
    avg/min/max populated % per field category (exact, in hundredths)."""
    spark = profile.sparkSession
    cat = spark.createDataFrame([(f, name) for name, fields in KEY_FIELD_CATEGORIES for f in fields],
                                "column_name string, category string")
    kf = profile.filter(F.col("key_field")).join(cat, "column_name")
    h = F.col("populated_pct_h")
    status = (F.when(h >= K.QA_GOOD_POPULATION_PCT * 100, "good")
              .when(h >= K.QA_FAIR_POPULATION_PCT * 100, "fair").otherwise("poor"))
    per_field = kf.select("category", "column_name", "populated_pct", "populated_count", status.alias("status"))
    agg = kf.groupBy("category").agg(F.sum(h).alias("_s"), F.count(F.lit(1)).alias("n_fields"),
                                     F.min(h).alias("_mn"), F.max(h).alias("_mx"),
                                     F.count_if(status == "good").alias("n_good"),
                                     F.count_if(status == "fair").alias("n_fair"),
                                     F.count_if(status == "poor").alias("n_poor"))
    avg_h = ((F.col("_s") * 2 + F.col("n_fields")) / (F.col("n_fields") * 2)).cast("long")
    return agg.select("category", "n_fields", "n_good", "n_fair", "n_poor", (avg_h / 100.0).alias("avg_populated_pct"),
                      (F.col("_mn") / 100.0).alias("min_populated_pct"),
                      (F.col("_mx") / 100.0).alias("max_populated_pct")), per_field


def baby_claims(claims: DataFrame, cfg: K.ClaimsConfig, rev: str = "RVNU_CD") -> DataFrame:
    """Claims with a newborn revenue code or newborn ICD in any diagnosis column."""
    return claims.filter(F.coalesce(is_in(rev, cfg.newborn_rev_codes), F.lit(False))
                         | any_column_in(DIAG_COLS, cfg.newborn_icd_codes))


def code_frequency(claims: DataFrame, cfg: K.ClaimsConfig, code: str = "DERIV_DRG_CD",
                   member: str = "INDV_ID", date: str = "SRVC_FROM_DT") -> DataFrame:
    """Per code of baby claims: distinct members, first and last date."""
    return (baby_claims(claims, cfg).filter(F.col(code).isNotNull())
            .groupBy(F.col(code).alias("DRG"))
            .agg(F.count_distinct(member).alias("MEMBER_COUNT"), F.min(date).alias("MIN_DATE"),
                 F.max(date).alias("MAX_DATE"))
            .orderBy(F.col("MEMBER_COUNT").desc(), F.col("DRG").asc()))


def drg_type_expr(code: Column, cfg: K.ClaimsConfig) -> Column:
    """MS-DRG / APR-DRG / Other / Unknown on the trimmed 3-char prefix (MS first)."""
    p = F.substring(F.trim(code.cast("string")), 1, 3)
    return (F.when(code.isNull(), "Unknown").when(p.isin(list(cfg.nicu_msdrg_codes)), "MS-DRG")
            .when(p.isin(list(cfg.nicu_aprdrg_codes)), "APR-DRG").otherwise("Other"))


def code_type_breakdown(freq: DataFrame, cfg: K.ClaimsConfig) -> DataFrame:
    return (freq.withColumn("DRG_TYPE", drg_type_expr(F.col("DRG"), cfg))
            .groupBy("DRG_TYPE").agg(F.count("DRG").alias("DRG_COUNT"),
                                     F.sum("MEMBER_COUNT").alias("TOTAL_MEMBERS")))


def code_frequency_stats(freq: DataFrame, cfg: K.ClaimsConfig) -> DataFrame:
    """Codes by type, mean/median members per code, top code, date range."""
    t = drg_type_expr(F.col("DRG"), cfg)
    return freq.agg(
        F.count(F.lit(1)).alias("TOTAL_CODES"),
        F.count_if(t == "MS-DRG").alias("MS_DRG_CODES"),
        F.count_if(t == "APR-DRG").alias("APR_DRG_CODES"),
        F.count_if(t == "Other").alias("OTHER_CODES"),
        F.avg("MEMBER_COUNT").alias("AVG_MEMBERS_PER_CODE"),
        F.median(F.col("MEMBER_COUNT").cast("double")).alias("MEDIAN_MEMBERS_PER_CODE"),
        F.min_by("DRG", F.struct(-F.col("MEMBER_COUNT"), F.col("DRG"))).alias("TOP_CODE"),
        F.max("MEMBER_COUNT").alias("TOP_CODE_MEMBERS"),
        F.min("MIN_DATE").alias("FIRST_DATE"), F.max("MAX_DATE").alias("LAST_DATE"))


def null_counts(df: DataFrame, cols, product: str = "PRODUCT", date: str = "REQUEST_DATE") -> DataFrame:
    """Null counts of chosen columns, distinct products, date range - one row."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"NULL_{c}") for c in cols],
                  F.count_distinct(product).alias("DISTINCT_PRODUCTS"),
                  F.min(date).alias("MIN_DATE"), F.max(date).alias("MAX_DATE"))


def profile_table(df: DataFrame, expected: dict, table_name: str):
    """(profile, alerts, summary) of one table."""
    from claimsmith.sources.sinks import materialize
    prof = materialize(profile_columns(df, expected, table_name))  # one row a column; alerts and summary read it
    alerts = profile_alerts(df, prof, expected, table_name)
    return prof, alerts, profile_summary(df, prof, alerts, expected, table_name)


def qa_job(tables: dict, claims: DataFrame, cfg: K.ClaimsConfig) -> dict[str, DataFrame]:
    """The QA run: ``tables`` maps a name to (frame, expected columns).

    Returns profile, alerts, summary and key-field population of all tables,
    and code frequency, breakdown by type and statistics of the newborn claims.
    """
    from claimsmith.sources.sinks import materialize
    found = [profile_table(df, expected, name) for name, (df, expected) in tables.items()]
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    fields = [key_field_population(prof)[1].withColumn("table_name", F.lit(name)) for name, (prof, _, _) in zip(tables, found)]
    freq = materialize(code_frequency(claims, cfg))  # one row a code
    return {"profile": union([f[0] for f in found]), "alerts": union([f[1] for f in found]),
            "summary": union([f[2] for f in found]), "key_fields": union(fields),
            "frequency": freq.withColumn("DRG_TYPE", drg_type_expr(F.col("DRG"), cfg)),
            "breakdown": code_type_breakdown(freq, cfg), "statistics": code_frequency_stats(freq, cfg)}
