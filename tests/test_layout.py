"""Claims by service month, declared optional sources, reference tables, bucketed streams."""

import datetime as dt
import os

from pyspark.sql import functions as F

from claimsmith.config import FIXTURE_WINDOW, ClaimsConfig
from claimsmith.operators import codes
from claimsmith.operators.periods import membership_periods
from claimsmith.plans import episodes as EP
from claimsmith.sources import fixtures as FX
from claimsmith.sources import layout as LO
from claimsmith.sources import publish as P
from claimsmith.sources import tables as TB
from claimsmith.streaming import merge_stream
from conftest import SF0001

CFG = ClaimsConfig()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_reads_its_months_only(spark, tmp_path):
    path = str(tmp_path / "claims")
    claims = FX.fx_claims(spark, SF0001)
    LO.write_by_month(claims, path)
    stored = spark.read.parquet(path)
    part = EP.filter_study_window(stored, FIXTURE_WINDOW)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(part)
    pruned = plan[plan.index("PartitionFilters: ["):].split("]", 1)[0]
    assert LO.MONTH in pruned and "199908" in pruned and "200107" in pruned
    whole, read = (df.select(F.input_file_name()).distinct().count() for df in (stored, part))
    months = LO.stored_months(spark, path)
    assert 0 < read < whole and any(m > 200107 for m in months)
    cols = ["LINE_KEY", "SRVC_FROM_DT", "NET_PD_AMT"]
    assert sorted(part.select(*cols).collect()) == sorted(EP.filter_study_window(claims, FIXTURE_WINDOW).select(*cols).collect())
    short = LO.months_within(stored, dt.date(2000, 3, 1), dt.date(2000, 3, 31))
    assert short.select(F.input_file_name()).distinct().count() <= 8


def test_bounds_from_months_equal_the_scan(spark, tmp_path):
    claims = FX.fx_claims(spark, SF0001).withColumn("PROCESS_DT", F.when(F.col("SRVC_FROM_DT") >= "1999-09-01", F.col("PROCESS_DT")))
    claims = claims.withColumn("SRVC_FROM_DT", F.when(F.col("LINE_KEY").endswith("7"), F.lit(None)).otherwise(F.col("SRVC_FROM_DT")))
    path = str(tmp_path / "claims")
    LO.write_by_month(claims, path)
    assert LO.month_bounds(spark, path).first() == TB.scan_sql_bounds(claims).first()
    empty = str(tmp_path / "empty")
    LO.write_by_month(claims.limit(0), empty)
    assert LO.stored_months(spark, empty) == []


def test_optional_source_follows_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("id,when_date,amount,more\n1,2001-02-03,1.5,x\n2,2/4/2001,abc,y\nthree,never,7,z\n")
    got = TB.scan_optional(spark, path, "ID long, WHEN_DATE date, AMOUNT double, ABSENT string")
    assert got.schema.simpleString() == "struct<ID:bigint,WHEN_DATE:date,AMOUNT:double,ABSENT:string>"
    assert [tuple(r) for r in got.collect()] == [(1, dt.date(2001, 2, 3), 1.5, None), (2, dt.date(2001, 2, 4), None, None), (None, None, 7.0, None)]
    bad = str(tmp_path / "bad.parquet")
    with open(bad, "w") as f:
        f.write("no parquet")
    for p, fmt in ((bad, "parquet"), (str(tmp_path / "absent"), "csv"), ("", "csv")):
        assert TB.scan_optional(spark, p, "ID long", fmt).collect() == []
    open(str(tmp_path / "none.csv"), "w").close()
    assert TB.scan_optional(spark, str(tmp_path / "none.csv"), "ID long").columns == ["ID"]


def test_codes_from_tables_equal_the_config(spark):
    claims = FX.fx_claims(spark, SF0001)
    ps = membership_periods(FX.fx_membership(spark, SF0001), FIXTURE_WINDOW, "DEMO")
    tables = codes.CodeTables({f: FX.ref_codes_df(spark, c) for f, c in CFG.code_sets().items()},
                              FX.ref_category_df(spark, CFG.gest_age_icd, "G"), FX.ref_category_df(spark, CFG.birthweight_icd, "B"))
    one, two = (EP.tagged_claims(claims, ps, FIXTURE_WINDOW, CFG, t) for t in (None, tables))
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    # Another table, other flags: the config's lists play no part.
    other = codes.CodeTables(tables.flags | {"NICU_REV": FX.ref_codes_df(spark, ["0450"])}, tables.gest_age, tables.birthweight)
    flagged = EP.tagged_claims(claims, ps, FIXTURE_WINDOW, CFG, other).where("NICU_REV").select("RVNU_CD").distinct().collect()
    assert [r[0] for r in flagged] == ["0450"]


def test_stream_rewrites_touched_buckets_and_skips_replays(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    schema = "ID long, STATUS string"
    table = P.BucketedTable(spark, str(tmp_path / "base"), "REQUESTS", "ID", buckets=4)

    def batch(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
        merge_stream(spark.readStream.schema(schema).json(src), table, ck, trigger_once=True).awaitTermination(120)
    batch([(i, "Waiting") for i in range(40)])
    before = table.folders()
    batch([(7, "Complete")])
    after = table.folders()
    assert sum(before[b] != after[b] for b in after) == 1
    assert sorted(tuple(r) for r in table.read().collect()) == [(i, "Complete" if i == 7 else "Waiting") for i in range(40)]
    assert table.merge(spark.createDataFrame([(7, "replayed")], schema), batch=1) == P.Merged(0, 0, [])
    assert os.path.isdir(str(tmp_path / "base" / P.POINTERS))


def test_member_layout_shuffles_no_claims_again(spark):
    """Bucketed by member: no exchange from the cohort through the stay windows, and the same stays."""
    import re
    import uuid
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    old = {k: spark.conf.get(k) for k in off}
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("claims", "members")]
    plain = [FX.fx_claims(spark, SF0001), membership_periods(FX.fx_membership(spark, SF0001), FIXTURE_WINDOW, "DEMO")]
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        laid = [LO.write_by_member(df, name, buckets=4) for df, name in zip(plain, names)]
        one, two = (EP.newborn_episodes(*tables, FIXTURE_WINDOW, CFG, materialize=False) for tables in (plain, laid))
        exchanges = [len(re.findall(r"\bExchange hashpartitioning", plan_of(run.hosp))) for run in (one, two)]
        assert exchanges[0] > 4 and exchanges[1] == 0, exchanges
        assert sorted(map(str, one.hosp.collect())) == sorted(map(str, two.hosp.collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
