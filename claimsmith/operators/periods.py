"""Study-period arithmetic: windows, member-months, stay clipping.

The study window is the only value that crosses to the driver (one row of
three dates); everything else stays a lazy plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.config import StudyWindow
from claimsmith.functions.exprs import (
    c, lit_date, months_crossed, period_label, strict_greatest, strict_least, years_crossed, yyyymm_to_date,
)
from claimsmith.operators.windows import latest_per_key
from claimsmith.sources.tables import scan_sql_bounds


def study_window_frame(claims: DataFrame, months: int = 24, runout_months: int = 3,
                       from_col: str = "SRVC_FROM_DT", process_col: str = "PROCESS_DT") -> DataFrame:
    """One-row frame with the window derived from the service-date range.

    run-out end = last day of the month before the max service month;
    run-out = ``runout_months`` months ending there; study window = the
    ``months`` months before the run-out; mid = start + 12 months.
    ``add_months`` clamps to month ends like dateutil's relativedelta.
    """
    b = scan_sql_bounds(claims, from_col, process_col)
    return (b.select(
        F.to_date("MIN_FROMDATE").alias("MIN_FROMDATE"),
        F.to_date("MAX_FROMDATE").alias("MAX_FROMDATE"),
        F.to_date("MAX_PAIDDATE").alias("MAX_PAIDDATE"))
        .withColumn("N_MONTHS", months_crossed("MIN_FROMDATE", "MAX_FROMDATE") + 1)
        .withColumn("RUNOUT_END", F.date_sub(F.trunc("MAX_FROMDATE", "month"), 1))
        .withColumn("RUNOUT_START", F.date_add(F.add_months("RUNOUT_END", -runout_months), 1))
        .withColumn("WINDOW_END", F.date_sub("RUNOUT_START", 1))
        .withColumn("WINDOW_START", F.date_add(F.add_months("WINDOW_END", -months), 1))
        .withColumn("WINDOW_MID", F.add_months("WINDOW_START", 12))
        .withColumn("ENOUGH_MONTHS", F.col("N_MONTHS") >= months))


def study_window(claims: DataFrame, months: int = 24, runout_months: int = 3, **cols) -> StudyWindow:
    """Collect the one-row window (the only driver value of the jobs)."""
    row = study_window_frame(claims, months, runout_months, **cols).first()
    if row is None or row["MIN_FROMDATE"] is None or row["MAX_FROMDATE"] is None:
        raise ValueError("FROMDATE range is invalid. Cannot determine study window.")
    if not row["ENOUGH_MONTHS"]:
        raise ValueError(f"Only {row['N_MONTHS']} months available. Minimum {months} months required.")
    return StudyWindow(row["WINDOW_START"], row["WINDOW_MID"], row["WINDOW_END"], row["RUNOUT_END"])


def overlap_months(eff, exp, lo: dt.date, hi: dt.date) -> Column:
    """Months of overlap of [eff, exp] with [lo, hi]: boundaries crossed + 1,
    0 when disjoint, null when any bound is null."""
    s = strict_greatest(eff, lit_date(lo))
    e = strict_least(exp, lit_date(hi))
    return F.when(e < s, F.lit(0)).otherwise(months_crossed(s, e) + 1)


def _tiebreak(df: DataFrame, tiebreak: str | None):
    """Explicit tie-break column, the fixture's ROW_KEY, or a row hash."""
    if tiebreak:
        return tiebreak
    if "ROW_KEY" in df.columns:
        return "ROW_KEY"
    return F.xxhash64(*[F.col(f"`{x}`") for x in df.columns])


def usable_months(members: DataFrame) -> DataFrame:
    """Eligibility rows with member and month, and the month's first day."""
    return (members.filter(F.col("INDV_ID").isNotNull() & F.col("YEARMO").isNotNull())
            .withColumn("MM_DATE", yyyymm_to_date("YEARMO")))


def enrollment_periods(src: DataFrame) -> DataFrame:
    """Distinct (member, effective, expiration)."""
    return src.select("INDV_ID", F.col("MEM_EFF_DT").cast("date").alias("MEM_EFF_DT"),
                      F.col("MEM_EXP_DT").cast("date").alias("MEM_EXP_DT")).distinct()


def latest_demographics(src: DataFrame, columns=("GENDER", "BTH_DT", "BUS_LINE_CD", "PRDCT_CD", "STATE"),
                        tiebreak: str | None = None) -> DataFrame:
    """Each member's attributes of the latest month."""
    return latest_per_key(src, "INDV_ID", "MM_DATE", _tiebreak(src, tiebreak), list(columns))


def with_overlaps(periods: DataFrame, window: StudyWindow) -> DataFrame:
    """Periods with their months in each half of the window."""
    return periods.withColumns({
        "MMYR1": overlap_months("MEM_EFF_DT", "MEM_EXP_DT", window.start, window.mid - dt.timedelta(days=1)),
        "MMYR2": overlap_months("MEM_EFF_DT", "MEM_EXP_DT", window.mid, window.end)})


def by_study_year(overlaps: DataFrame) -> DataFrame:
    """One row per period and study year it overlaps (one scan: both years as an array, exploded)."""
    slices = F.array(F.struct(F.lit("Previous").alias("STUDY_YR"), F.col("MMYR1").alias("MEMBER_MONTHS")),
                     F.struct(F.lit("Current").alias("STUDY_YR"), F.col("MMYR2").alias("MEMBER_MONTHS")))
    return overlaps.select("*", F.inline(slices)).filter(F.col("MEMBER_MONTHS") > 0)


def distinct_months(periods: DataFrame, window: StudyWindow) -> DataFrame:
    """(INDV_ID, STUDY_YR, MEMBER_MONTHS) with every month of a member counted once, however many periods cover it.

    Periods are clipped to each half of the window and read as runs of months;
    a run adds the months after the last one that the runs before it reach."""
    halves = (("Previous", window.start, window.mid - dt.timedelta(days=1)), ("Current", window.mid, window.end))
    month = lambda d: F.year(d) * 12 + F.month(d)
    runs = []
    for label, lo, hi in halves:
        s, e = strict_greatest("MEM_EFF_DT", lit_date(lo)), strict_least("MEM_EXP_DT", lit_date(hi))
        runs.append(F.when(s <= e, F.struct(F.lit(label).alias("STUDY_YR"), month(s).alias("_a"), month(e).alias("_b"))))
    rows = periods.select("INDV_ID", F.explode(F.array_compact(F.array(*runs))).alias("r")).select("INDV_ID", "r.*").distinct()
    w = Window.partitionBy("INDV_ID", "STUDY_YR").orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("_b") - F.greatest(F.col("_a") - 1, F.max("_b").over(w)))
    return (rows.withColumn("_new", new).groupBy("INDV_ID", "STUDY_YR").agg(F.sum("_new").cast("bigint").alias("MEMBER_MONTHS")))


def membership_periods(members: DataFrame, window: StudyWindow, client_name: str,
                       tiebreak: str | None = None, once: bool = False) -> DataFrame:
    """Member-months per member x study year (Previous / Current).

    Latest demographics per member (by month desc) joined to all distinct
    enrollment periods; overlap months with each half of the window; rows
    with no overlap are dropped; months summed per member, year and
    demographics.  Overlapping enrollment periods are counted twice, unless
    ``once`` counts each month of a member once.
    """
    src = usable_months(members)
    prev_high = window.mid - dt.timedelta(days=1)
    periods = distinct_months(enrollment_periods(src), window) if once else with_overlaps(enrollment_periods(src), window)
    base = periods.join(latest_demographics(src, tiebreak=tiebreak), "INDV_ID").withColumns({
        "AGE": F.when(F.col("BTH_DT").isNotNull(), years_crossed("BTH_DT", lit_date(window.end))),
        "CLIENT_NAME": F.lit(client_name),
        "PREVIOUS_PERIOD": F.lit(period_label(window.start, prev_high)),
        "CURRENT_PERIOD": F.lit(period_label(window.mid, window.end)),
    })
    return ((base if once else by_study_year(base)).groupBy("INDV_ID", "STUDY_YR", "GENDER", "BTH_DT", "BUS_LINE_CD", "PRDCT_CD", "STATE",
                                        "AGE", "CLIENT_NAME", "PREVIOUS_PERIOD", "CURRENT_PERIOD")
            .agg(F.sum("MEMBER_MONTHS").cast("bigint").alias("MEMBER_MONTHS")))


def membership_latest(members: DataFrame, start: dt.date, end: dt.date, client_name: str,
                      month_col: str = "MM", tiebreak: str | None = None) -> DataFrame:
    """Latest in-window eligibility row per member, with the period label."""
    src = (members.filter(F.col("INDV_ID").isNotNull() & F.col(month_col).isNotNull())
           .withColumn("MM_DATE", F.to_date(F.concat(F.col(month_col), F.lit("01")), "yyyyMMdd"))
           .filter((F.col("MM_DATE") >= lit_date(start)) & (F.col("MM_DATE") <= lit_date(end))))
    keep = ["SBSCR_ID", "GENDER", "BTH_DT", "BUS_LINE_CD", "PRODUCT", "STATE", "REL_CD", "MBR_ZIP_CD", "MM_DATE"]
    return (latest_per_key(src, "INDV_ID", "MM_DATE", _tiebreak(src, tiebreak), keep)
            .withColumn("CLIENT_NAME", F.lit(client_name))
            .withColumn("STUDY_PERIOD", F.lit(period_label(start, end))))


def fill_dates(df: DataFrame) -> DataFrame:
    """Admit <- service from, discharge <- service thru, when null."""
    return df.withColumns({
        "ADMIT_DT_FIL": F.coalesce(F.col("ADMIT_DT"), F.col("SRVC_FROM_DT")).cast("date"),
        "DISCH_DT_FIL": F.coalesce(F.col("DISCH_DT"), F.col("SRVC_THRU_DT")).cast("date"),
    })


def los_expr(admit="ADMIT", dschrg="DSCHRG") -> Column:
    """Days between admit and discharge; same day counts as 1."""
    return F.when(c(dschrg) == c(admit), F.lit(1)).otherwise(F.datediff(c(dschrg), c(admit)))


def clip_and_los(stays: DataFrame, runout_end: dt.date) -> DataFrame:
    """Clip discharge to run-out (flag it), floor admit to delivery, LOS >= 1."""
    return (stays
            .withColumn("OUT_END_DATE", (F.col("DSCHRG") > lit_date(runout_end)).cast("int"))
            .withColumn("DSCHRG", strict_least("DSCHRG", lit_date(runout_end)))
            .withColumn("ADMIT", strict_greatest("ADMIT", "DELIVERY_DT"))
            .withColumn("LOS", los_expr())
            .filter(F.col("LOS") >= 1))
