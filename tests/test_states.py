"""Profiles and code frequencies by load equal those of all rows at once."""

import pytest
from pyspark.sql import functions as F

from claimsmith.config import ClaimsConfig
from claimsmith.plans import profile as PR
from claimsmith.plans import states as ST
from claimsmith.sources import fixtures as FX
from claimsmith.sources import publish as P
from conftest import SF0001

CFG = ClaimsConfig()


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def claims(spark):
    return FX.fx_claims(spark, SF0001).cache()


def loads(claims):
    """Three loads that share members, codes and values; the second has columns without a value."""
    part = F.pmod(F.xxhash64("CLM_AUD_NBR"), F.lit(3))
    out = [claims.where(part == i) for i in range(3)]
    return [out[0], out[1].withColumn("DIAG_3_CD", F.lit(None).cast("string")), out[2]]


def test_code_frequency_by_load(spark, claims, tmp_path):
    state = ST.DistinctState(spark, str(tmp_path), "codes")
    for i, part in enumerate(loads(claims)):
        assert ST.add_code_load(state, f"load-{i}", part, CFG)
    assert rows(ST.code_frequency(state)) == rows(PR.code_frequency(claims, CFG))
    assert not ST.add_code_load(state, "load-1", claims, CFG)  # a repeated load adds nothing
    assert rows(ST.code_frequency(state)) == rows(PR.code_frequency(claims, CFG))


def test_profile_by_load(spark, claims, tmp_path):
    state = ST.DistinctState(spark, str(tmp_path), "profile")
    parts = loads(claims)
    for i, part in enumerate(parts):
        ST.add_profile_load(state, str(i), part, PR.CLAIMS_EXPECTED)
    every = parts[0].unionAll(parts[1]).unionAll(parts[2])
    assert rows(ST.profile_columns(state, PR.CLAIMS_EXPECTED, "FA")) == rows(PR.profile_columns(every, PR.CLAIMS_EXPECTED, "FA"))


def test_numbers_have_no_dictionary_and_later_loads_add_new_values_only(spark, tmp_path):
    state = ST.DistinctState(spark, str(tmp_path), "t")
    expected = {"n": (True, True, "key"), "d": (False, False, "day"), "s": (False, False, "text")}

    def load(name, lo, hi):
        df = spark.range(lo, hi).select((F.col("id") - 50).alias("n"), F.expr("date_add(date'1969-12-01', cast(id as int))").alias("d"),
                                        F.concat(F.lit("v"), (F.col("id") % 30).cast("string")).alias("s"))
        ST.add_profile_load(state, name, df, expected)
    load("a", 0, 100)
    assert state.dictionary().count() == 30
    load("b", 90, 40_000)
    assert state.dictionary().count() == 30 and state.dictionary().where("epoch > 0").isEmpty()
    got = {r.column_name: (r.distinct_count, r.total_rows) for r in ST.profile_columns(state, expected, "t").collect()}
    assert got == {"n": (40_000, 40_010), "d": (40_000, 40_010), "s": (30, 40_010)}


def test_failed_load_adds_nothing(spark, tmp_path):
    state = ST.DistinctState(spark, str(tmp_path), "t")
    values = spark.createDataFrame([("g", "v", None)], "grp string, value string, number long")
    with pytest.raises(Exception, match="no stats"):
        state.add("a", values, spark.range(1).select(F.raise_error(F.lit("no stats")).alias("x")))
    assert state.loads() == {} and P.current(spark, str(tmp_path)) == {} and state.counts().isEmpty()


def test_a_load_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def row(i):
        seen.add(1)
        return (i, "v" + str(i % 7) if i % 10 else None)
    df = spark.createDataFrame(spark.sparkContext.parallelize(range(200), 4).map(row), "n long, s string")
    expected = {"n": (True, True, "key"), "s": (False, False, "text"), "absent": (False, False, "")}
    state = ST.DistinctState(spark, str(tmp_path), "t")
    assert ST.add_profile_load(state, "a", df, expected) and seen.value == 200
    assert not ST.add_profile_load(state, "a", df, expected) and seen.value == 200
    assert ST.add_profile_load(state, "empty", df.where("n < 0"), expected)
    got = {r.column_name: (r.total_rows, r.null_count, r.distinct_count, r.sample_values) for r in ST.profile_columns(state, expected, "t").collect()}
    assert got == {"n": (200, 0, 200, "0, 1, 10, 100, 101"), "s": (200, 20, 8, "v0, v1, v2, v3, v4")}


def test_loads_of_the_queries_are_stored_rows_of_one_build(spark):
    from claimsmith import queries as Q
    plans = []
    Q._by_load(Q.Ctx(spark, SF0001), "t", PR.CLAIMS_EXPECTED, lambda state, name, df: plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df.columns)))
    assert [p[0] for p in plans] == ["load-0", "load-1", "load-2"]
    assert not any("l_orderkey" in p[1] for p in plans) and set(plans[0][2]) <= set(PR.CLAIMS_EXPECTED)
