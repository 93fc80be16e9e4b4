"""Published versions, bucketed merges and the keyed history."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from claimsmith.plans import metrics as M
from claimsmith.plans import request_job as RJ
from claimsmith.sources import fixtures as FX
from claimsmith.sources import publish as P
from claimsmith.sources import sinks as SK
from conftest import SF0001


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_versions_appear_together_or_not_at_all(spark, tmp_path):
    base = str(tmp_path)
    one = [P.stage(spark.range(3), base, "a"), P.stage(spark.range(5), base, "b")]
    assert P.current(spark, base) == {} and [s.rows for s in one] == [3, 5]
    P.publish(spark, base, one)
    two = [P.stage(spark.range(7), base, "a"), P.stage(spark.range(0), base, "b")]
    assert two[1] == P.Staged("b", None, 0) and P.read(spark, base, "a").count() == 3
    with pytest.raises(ValueError, match="no sevens"):
        P.publish(spark, base, two, checks=[("fine", spark.range(0)), ("no sevens", spark.range(1))])
    assert P.current(spark, base) == {"a": one[0].path, "b": one[1].path} and not os.path.exists(two[0].path)
    P.publish(spark, base, [P.stage(spark.range(7), base, "a"), two[1]])
    assert (P.read(spark, base, "a").count(), P.read(spark, base, "b").count()) == (7, 5)


def test_half_written_pointer_is_passed_over(spark, tmp_path):
    base = str(tmp_path)
    P.publish(spark, base, [P.stage(spark.range(2), base, "a")])
    with open(os.path.join(base, P.POINTERS, "p-0000000002.json"), "w") as f:
        f.write('{"a": "/now')
    assert P.read(spark, base, "a").count() == 2
    P.publish(spark, base, [P.stage(spark.range(4), base, "a")])
    assert P.read(spark, base, "a").count() == 4 and len(P._pointers(spark, base)) == 3


def test_failing_product_load_leaves_both_tables(spark, tmp_path, monkeypatch):
    base, requests = str(tmp_path), FX.fx_requests(spark, SF0001)

    def run(rows, run_id, **options):
        return RJ.request_job(spark, rows, FX.fx_initiatives(spark, SF0001), FX.REQUEST_PRODUCTS, FX.CLIENT_TYPES, dt.date(2001, 12, 31),
                              base, base + "/audit", run_id, dt.datetime(2001, 12, 31), **options)
    first = run(requests.where("ID % 2 = 0"), "a", incremental=False)
    before = P.current(spark, base)
    assert before == {"REQUESTS": first.requests_path, "PRODUCTS": first.products_path}
    monkeypatch.setattr(RJ, "request_metrics", lambda df, as_of: df.withColumn("x", F.raise_error(F.lit("product load"))))
    with pytest.raises(Exception, match="product load"):
        run(requests, "b")
    assert P.current(spark, base) == before and os.listdir(f"{base}/REQUESTS") == [os.path.basename(first.requests_path)]
    monkeypatch.undo()
    last = run(requests, "c")
    assert P.read(spark, base, "REQUESTS").count() == requests.count() and P.current(spark, base)["PRODUCTS"] == last.products_path
    status = {r.RUN_ID: r.STATUS for r in spark.read.parquet(base + "/audit").collect()}
    assert status == {"a": "SUCCESS", "b": "FAILED", "c": "SUCCESS"}


def test_one_row_merge_writes_one_bucket(spark, tmp_path):
    table = P.BucketedTable(spark, str(tmp_path), "t", "ID", buckets=8)
    start = spark.range(200).select(F.col("id").alias("ID"), (F.col("id") * 2).alias("V"))
    assert table.merge(start) == P.Merged(200, 0, list(range(8)))
    old = table.folders()
    done = table.merge(spark.createDataFrame([(17, -1)], "ID long, V long"))
    new = table.folders()
    assert (done.inserted, done.updated, len(done.buckets)) == (0, 1, 1) and [b for b in new if new[b] != old[b]] == done.buckets
    assert os.listdir(os.path.dirname(new[done.buckets[0]])).count("_SUCCESS") == 1
    assert rows(table.read(), "ID", "V") == sorted((i, -1 if i == 17 else i * 2) for i in range(200))


def test_bucketed_merges_equal_full_joins(spark, tmp_path):
    """New columns, null keys, an empty batch and a replayed one: as the full outer join."""
    table = P.BucketedTable(spark, str(tmp_path), "t", "ID", buckets=4)
    batches = [spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "ID int, V string"),
               spark.createDataFrame([(2, "c", 5), (3, "d", 6), (None, "m", 7)], "ID int, V string, W int"),
               spark.createDataFrame([], "ID int, V string")]
    full = None
    for n, batch in enumerate(batches):
        full = batch if full is None else SK.upsert_merge(full, batch)[0].drop("_ACTION")
        table.merge(batch, batch=n)
        assert table.merge(batch, batch=n) == P.Merged(0, 0, []) or not n < 2
    assert sorted(map(str, table.read().select("ID", "V", "W").collect())) == sorted(map(str, full.select("ID", "V", "W").collect()))
    with pytest.raises(ValueError, match="duplicate"):
        table.merge(spark.createDataFrame([(9, "x"), (9, "y")], "ID int, V string"))
    with pytest.raises(ValueError, match="checks failed"):
        table.merge(spark.createDataFrame([(9, "bad")], "ID int, V string"), checks=[lambda df: df.where("V = 'bad'")])
    assert table.read().where("ID = 9").isEmpty()


def test_history_keeps_one_row_a_run_and_refuses_bad_ones(spark, tmp_path):
    path = str(tmp_path / "history")

    def row(run_id, rate, note):
        return spark.createDataFrame([(run_id, "ACME", rate, 1.0, 2.0, note)], "run_id string, client_name string, nicu_rate_pct double, "
                                     "pct_professional_fees double, pct_facility_cost double, note string")
    for args in (("r1", 5.0, "first"), ("r2", 6.0, "x"), ("r1", 7.0, "again")):
        M.write_history(row(*args), path)
    for bad in (row("r1", 101.0, "bad"), row("r3", -1.0, "bad"), row(None, 5.0, "bad")):
        with pytest.raises(ValueError, match="refused"):
            M.write_history(bad, path)
    assert rows(spark.read.parquet(path), "run_id", "nicu_rate_pct", "note") == [("r1", 7.0, "again"), ("r2", 6.0, "x")]
