from decimal import Decimal

from pyspark.sql import functions as F

from claimsmith.config import ClaimsConfig
from claimsmith.plans import profile as P
from claimsmith.plans import sos as S

CFG = ClaimsConfig()


def test_percentages_round_half_up_exactly(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0)], "n long, d long")
    got = [r[0] for r in df.select(P.hundredths_pct(F.col("n"), F.col("d"))).collect()]
    assert got == [1250, 3333, 6667, 0]


def test_profile_alerts_and_summary(spark):
    rows = [("a", None, None), ("b", None, "x"), (None, None, "y")]
    df = spark.createDataFrame(rows, "INDV_ID string, BTH_DT date, GENDER string")
    expected = {"INDV_ID": (True, False, "id"), "BTH_DT": (True, False, "birth"), "GENDER": (False, False, "g"),
                "MEM_EFF_DT": (True, False, "eff"), "STATE": (False, False, "state")}
    prof, alerts, summary = P.profile_table(df, expected, "T")
    a = {(r["column_name"], r["severity"]) for r in alerts.collect()}
    assert a == {("MEM_EFF_DT", "CRITICAL"), ("STATE", "WARNING"), ("BTH_DT", "CRITICAL"), ("INDV_ID", "WARNING")}
    s = summary.first()
    assert (s["found_columns"], s["missing_columns"], s["passed"]) == (3, 2, False)
    p = {r["column_name"]: r for r in prof.collect()}
    assert p["INDV_ID"]["distinct_count"] == 3 and p["INDV_ID"]["sample_values"] == "a, b"
    assert p["GENDER"]["null_pct"] == 33.33


def _lines(spark, rows):
    return spark.createDataFrame(rows, "OUTPATIENT_EVENT_ID string, LINE_KEY string, PROV_CAT string, "
                                       "INCLUDE_IN_ORDERING string, ELIGIBLE string, ALLW_AMT decimal(18,2)")


def test_rank_buckets_partition_rankable_amounts(spark):
    rows = [("e", f"l{i}", "Facility", "Y", "Y" if i % 3 else "N", Decimal(100 - i)) for i in range(8)]
    rows += [("e", "p1", "Professional", "Y", "Y", Decimal(500)), ("e", "n1", "Unknown", "N", "Y", Decimal(7)),
             ("e", "z", "Facility", "Y", "Y", Decimal(0))]
    lines = _lines(spark, rows)
    b = S.event_buckets(lines, "ALLW_AMT", CFG).first()
    prim = S.primary_lines(lines, "ALLW_AMT", CFG).collect()
    rankable = sum(Decimal(100 - i) for i in range(8))
    total = (sum(r["ALLW_AMT"] for r in prim) + b["SECONDARY_COVERED_AMT"] + b["TERTIARY_COVERED_AMT"]
             + b["ALLOTH_COVERED_AMT"] + b["NOT_ELIGIBLE_COVERED_AMT"])
    assert total == rankable
    assert b["COVERED_NOT_IN_RANKING"] == Decimal(7)


def test_event_dropped_when_rank_one_not_eligible(spark):
    rows = [("e", "l1", "Facility", "Y", "N", Decimal(10)), ("e", "l2", "Facility", "Y", "Y", Decimal(5))]
    assert S.primary_lines(_lines(spark, rows), "ALLW_AMT", CFG).count() == 0


def test_profile_reads_the_table_once(spark):
    """Row and null counts come from the stored values, not from a scan of their own."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.createDataFrame([("a", 1), ("a", None), (None, None), ("b", 3)], "x string, y int").mapInArrow(rows, "x string, y int")
    expected = {"x": (True, True, "x"), "y": (False, False, "y"), "z": (False, False, "z")}
    got = {r.column_name: r for r in P.profile_columns(df, expected, "T").collect()}
    assert seen.value == 4
    assert [(got[k].total_rows, got[k].null_count, got[k].distinct_count, got[k].sample_values) for k in "xy"] == [(4, 1, 3, "a, b"), (4, 2, 3, "1, 3")]
    empty = {r.column_name: r for r in P.profile_columns(df.limit(0), expected, "T").collect()}
    assert [(r.total_rows, r.null_count, r.distinct_count) for r in empty.values()] == [(0, 0, None)] * 2
