"""Code-set flags and cohort selection.

Code sets are small literal lists from the config (bounded size), so line
tests are ``isin`` predicates evaluated inside codegen - no join at all.
Claim-level spreading (a flag true on any line marks every line of the
claim) aggregates only the matching lines and left-joins them back; the
matched set is usually tiny, so AQE turns that join into a broadcast at
run time when its measured size allows, and into a shuffle join otherwise.
Cohorts are left-semi joins: no key list ever travels through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.config import ClaimsConfig
from claimsmith.functions.exprs import c, is_in, prefix

DIAG_COLS = ("DIAG_1_CD", "DIAG_2_CD", "DIAG_3_CD", "DIAG_4_CD", "DIAG_5_CD")
CLAIM_KEYS = ("INDV_ID", "CLM_AUD_NBR")


@dataclass(frozen=True)
class CodeTables:
    """Reference tables that take the place of the config's code lists.

    ``flags``: flag name (as in ``ClaimsConfig.code_sets``) -> table with the
    codes in ``CODE``; ``gest_age`` and ``birthweight``: (code, category) tables."""

    flags: Mapping[str, DataFrame]
    gest_age: DataFrame
    birthweight: DataFrame


def any_column_in(cols, codes) -> Column:
    """True when any of ``cols`` (cast to string) is in ``codes``; never null."""
    return F.coalesce(reduce(lambda a, b: a | b, [is_in(x, codes) for x in cols]), F.lit(False))


def stored_codes(ref: DataFrame) -> DataFrame:
    """The distinct rows of a reference table, stored: their size is known when a join is planned, so a
    small table is broadcast and the lines it is held against are never dealt by their (few, uneven) codes."""
    from claimsmith.sources.sinks import materialize
    return materialize(ref.distinct())


def _claims_in_tables(df: DataFrame, flags: dict, cols: list[str], keys: list[str], ref_col: str) -> DataFrame:
    """(keys, _m_<flag>) of the claims with a code of the reference tables.

    One equi-join of the distinct (claim, code) rows with the tables put
    under each other; Spark broadcasts them where their size allows."""
    refs = [t.select(F.col(ref_col).cast("string").alias("_code"), F.lit(f).alias("_flag")) for f, t in flags.items()]
    codes = F.explode(F.array_distinct(F.array(*[F.col(x).cast("string") for x in cols])))
    lines = df.select(*keys, codes.alias("_code")).filter(F.col("_code").isNotNull()).distinct()
    hits = lines.join(stored_codes(reduce(DataFrame.unionByName, refs)), "_code")
    return hits.groupBy(*keys).agg(*[F.max((F.col("_flag") == f).cast("int")).alias(f"_m_{f}") for f in flags])


def flag_any_of_columns(df: DataFrame, flags: dict, cols=DIAG_COLS, keys=CLAIM_KEYS, ref_col: str = "CODE",
                        together: bool = False) -> DataFrame:
    """Claim-level existence flags: ``flags`` maps flag name -> code list or
    reference table (all of one kind; a table's codes are in ``ref_col``).

    A claim (``keys``) gets the flag on all its lines when any line has any
    of ``cols`` among the codes.  Lines with a null key never match.

    ``together`` is for lines that a join by one of the keys has just brought
    together: code lists are then spread over a claim's lines by a window in
    the same stage, so the lines are neither built nor moved a second time.
    """
    cols = [x for x in cols if x in df.columns]
    keys = list(keys)
    if any(isinstance(v, DataFrame) for v in flags.values()):
        matched = _claims_in_tables(df, flags, cols, keys, ref_col)
        out = df.join(matched, keys, "left")
        return (out.withColumns({f: F.coalesce(F.col(f"_m_{f}") == 1, F.lit(False)) for f in flags})
                .drop(*[f"_m_{f}" for f in flags]))
    line_tests = {f: any_column_in(cols, codes) for f, codes in flags.items()}
    hit = reduce(lambda a, b: a | b, line_tests.values())
    key_ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if together:
        # Lines without a claim are no claim: a hash of the line keeps them apart.
        apart = F.when(~key_ok, F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
        claim = Window.partitionBy(*keys, "_apart")
        return (df.withColumn("_apart", apart)
                .withColumns({f: key_ok & F.max(t).over(claim) for f, t in line_tests.items()}).drop("_apart"))
    matched = (df.filter(hit & key_ok)
               .groupBy(*keys)
               .agg(*[F.max(t.cast("int")).alias(f"_m_{f}") for f, t in line_tests.items()]))
    out = df.join(matched, keys, "left")
    return (out.withColumns({f: F.coalesce(F.col(f"_m_{f}") == 1, F.lit(False)) for f in flags})
            .drop(*[f"_m_{f}" for f in flags]))


def flag_code(df: DataFrame, col: str, codes, out: str) -> DataFrame:
    """Line-level existence flag on one column (null -> false); ``codes`` is a list or a reference table."""
    if isinstance(codes, DataFrame):
        return flag_code_table(df, col, codes, out)
    return df.withColumn(out, F.coalesce(is_in(col, codes), F.lit(False)))


def flag_code_prefix(df: DataFrame, col: str, codes, out: str, n: int = 3) -> DataFrame:
    """Line-level flag on the first ``n`` characters of a column; ``codes`` is a list or a reference table."""
    if isinstance(codes, DataFrame):
        return flag_code_table(df, col, codes, out, n=n)
    return df.withColumn(out, F.coalesce(prefix(c(col).cast("string"), n).isin(list(codes)), F.lit(False)))


def flag_code_table(df: DataFrame, col: str, ref: DataFrame, out: str,
                    ref_col: str = "CODE", n: int | None = None) -> DataFrame:
    """Flag against a reference *table* (when codes are not a config list).

    The reference side is reduced to distinct codes and stored, so that Spark
    picks broadcast or shuffle by its size before any line moves.  With a
    table too big to broadcast, lines without a code match nothing and are
    dealt by a hash of the line; Spark's skew-join rule splits frequent codes.
    """
    codes = (stored_codes(ref.select(F.col(ref_col).cast("string").alias("_code")))
             .withColumns({"_hit": F.lit(True), "_own": F.lit(0).cast("long")}))
    probe = c(col).cast("string") if n is None else prefix(c(col).cast("string"), n)
    deal = F.when(F.col("_probe").isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("long"))
    joined = (df.withColumn("_probe", probe).withColumn("_deal", deal)
              .join(codes, (F.col("_probe") == F.col("_code")) & (F.col("_deal") == F.col("_own")), "left"))
    return joined.withColumn(out, F.col("_hit").isNotNull()).drop("_probe", "_deal", "_code", "_own", "_hit")


def tag_reference_flags(df: DataFrame, cfg: ClaimsConfig, tables: CodeTables | None = None, together: bool = False) -> DataFrame:
    """All 8 reference flags in one pass: 4 claim-level ICD flags (one
    aggregate, or one window where a claim's lines are ``together``), 2 revenue and 2 DRG line flags
    (plain predicates, or joins with ``tables``, which Spark broadcasts where their size allows)."""
    if tables:
        t = tables.flags
        out = flag_any_of_columns(df, {f: t[f] for f in ("NEWBORN_ICD", "SINGLE", "TWIN", "MULTIPLE")})
        for f in ("NEWBORN_REV", "NICU_REV"):
            out = flag_code(out, "RVNU_CD", t[f], f)
        for f in ("NICU_MSDRG", "NICU_APRDRG"):
            out = flag_code_prefix(out, "DRG", t[f], f)
        return out
    sets = cfg.code_sets()
    out = flag_any_of_columns(df, {f: sets[f] for f in ("NEWBORN_ICD", "SINGLE", "TWIN", "MULTIPLE")}, together=together)
    return out.withColumns({
        "NEWBORN_REV": F.coalesce(is_in("RVNU_CD", sets["NEWBORN_REV"]), F.lit(False)),
        "NICU_REV": F.coalesce(is_in("RVNU_CD", sets["NICU_REV"]), F.lit(False)),
        "NICU_MSDRG": F.coalesce(prefix(F.col("DRG").cast("string")).isin(list(sets["NICU_MSDRG"])), F.lit(False)),
        "NICU_APRDRG": F.coalesce(prefix(F.col("DRG").cast("string")).isin(list(sets["NICU_APRDRG"])), F.lit(False)),
    })


def cohort_condition(cfg: ClaimsConfig, rev="RVNU_CD", drg="DERIV_DRG_CD", diag_cols=DIAG_COLS) -> Column:
    """Line qualifies a member: newborn revenue, newborn ICD in any diagnosis
    column, or NICU MS/APR DRG on the 3-character prefix."""
    d3 = prefix(c(drg).cast("string"))
    return (F.coalesce(is_in(rev, cfg.newborn_rev_codes), F.lit(False))
            | any_column_in(diag_cols, cfg.newborn_icd_codes)
            | F.coalesce(d3.isin(list(cfg.nicu_msdrg_codes)), F.lit(False))
            | F.coalesce(d3.isin(list(cfg.nicu_aprdrg_codes)), F.lit(False)))


def cohort_keys(claims: DataFrame, cfg: ClaimsConfig, key: str = "INDV_ID", **cols) -> DataFrame:
    """Distinct members with any newborn/NICU code (one pass, no union)."""
    return claims.filter(F.col(key).isNotNull() & cohort_condition(cfg, **cols)).select(key).distinct()


def cohort_keys_union(claims: DataFrame, cfg: ClaimsConfig, key: str = "INDV_ID") -> DataFrame:
    """The same cohort written as the union of four filtered selects."""
    d3 = prefix(F.col("DERIV_DRG_CD").cast("string"))
    parts = [claims.filter(is_in("RVNU_CD", cfg.newborn_rev_codes)).select(key),
             claims.filter(any_column_in(DIAG_COLS, cfg.newborn_icd_codes)).select(key),
             claims.filter(d3.isin(list(cfg.nicu_msdrg_codes))).select(key),
             claims.filter(d3.isin(list(cfg.nicu_aprdrg_codes))).select(key)]
    return reduce(DataFrame.unionByName, parts).filter(F.col(key).isNotNull()).distinct()


def cohort_keys_by_tables(claims: DataFrame, rev: DataFrame, icd: DataFrame, msdrg: DataFrame, aprdrg: DataFrame,
                          key: str = "INDV_ID", ref_col: str = "CODE") -> DataFrame:
    """The cohort by reference tables: distinct members with a code of any of them.

    One pass: each claim line's codes by kind, joined with the tables put
    under each other."""
    ref = reduce(DataFrame.unionByName, [t.select(F.lit(k).alias("KIND"), F.col(ref_col).cast("string").alias("CODE"))
                                         for k, t in (("REV", rev), ("ICD", icd), ("DRG", msdrg), ("DRG", aprdrg))])
    kind = lambda k, v: F.struct(F.lit(k).alias("KIND"), v.alias("CODE"))
    codes = F.array(kind("REV", F.col("RVNU_CD").cast("string")), *[kind("ICD", F.col(d).cast("string")) for d in DIAG_COLS],
                    kind("DRG", prefix(F.col("DERIV_DRG_CD").cast("string"))))
    lines = claims.filter(F.col(key).isNotNull()).select(key, F.inline(codes)).filter(F.col("CODE").isNotNull()).distinct()
    return lines.join(stored_codes(ref), ["KIND", "CODE"], "left_semi").select(key).distinct()


def cohort_semi_join(claims: DataFrame, cohort: DataFrame, key: str = "INDV_ID") -> DataFrame:
    """Restrict rows to cohort members (left-semi; no driver round trip)."""
    return claims.join(cohort, key, "left_semi")


def cohort_or_join(claims: DataFrame, cfg: ClaimsConfig, key: str = "INDV_ID") -> DataFrame:
    """Theta-join form of the cohort (revenue OR any of 5 diagnoses OR DRG).

    Written as a single exploded code column matched against one tagged
    code table with an equi-join, which avoids the nested-loop join an OR
    condition would force.  The code table is config-sized.
    """
    spark = claims.sparkSession
    codes = ([(x, "REV") for x in cfg.newborn_rev_codes] + [(x, "ICD") for x in cfg.newborn_icd_codes]
             + [(x, "DRG") for x in cfg.nicu_msdrg_codes + cfg.nicu_aprdrg_codes])
    ref = spark.createDataFrame(codes, "CODE string, KIND string")
    probes = F.array(
        F.struct(F.lit("REV").alias("KIND"), F.col("RVNU_CD").cast("string").alias("CODE")),
        *[F.struct(F.lit("ICD").alias("KIND"), F.col(d).cast("string").alias("CODE")) for d in DIAG_COLS],
        F.struct(F.lit("DRG").alias("KIND"), prefix(F.col("DERIV_DRG_CD").cast("string")).alias("CODE")))
    exploded = (claims.filter(F.col(key).isNotNull())
                .select(key, F.inline(probes)).filter(F.col("CODE").isNotNull()))
    return exploded.join(ref, ["KIND", "CODE"], "left_semi").select(key).distinct()
