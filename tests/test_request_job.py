"""The request load: merge, refresh, dry run, empty list, audit of a failure."""

import datetime as dt

import pytest

from claimsmith.plans.request_job import request_job
from claimsmith.sources import fixtures as FX

SF0001 = "/root/testdata/sf0.001"


def run(spark, base, requests, run_id, **options):
    return request_job(spark, requests, FX.fx_initiatives(spark, SF0001), FX.REQUEST_PRODUCTS, FX.CLIENT_TYPES, dt.date(2001, 12, 31),
                       base, base + "/audit", run_id, dt.datetime(2001, 12, 31), **options)


def test_refresh_then_merge(spark, tmp_path):
    base, requests = str(tmp_path), FX.fx_requests(spark, SF0001)
    n, even = requests.count(), requests.where("ID % 2 = 0").count()
    first = run(spark, base, requests.where("ID % 2 = 0"), "a", incremental=False)
    last = run(spark, base, requests, "b", current_requests=first.requests_path)
    audit = {(r.RUN_ID, r.TABLE_NAME): r for r in spark.read.parquet(base + "/audit").collect()}
    assert (audit["a", "REQUESTS"].ROWS_INSERTED, audit["b", "REQUESTS"].ROWS_INSERTED, audit["b", "REQUESTS"].ROWS_UPDATED) == (even, n - even, even)
    assert spark.read.parquet(last.requests_path).count() == n and spark.read.parquet(last.products_path).count() == last.product_rows
    assert all(r.STATUS == "SUCCESS" and r.DURATION_SECONDS >= 0 for r in audit.values()) and len(audit) == 4


def test_dry_run_and_empty_list_write_nothing(spark, tmp_path):
    base, requests = str(tmp_path), FX.fx_requests(spark, SF0001)
    dry = run(spark, base, requests, "a", dry_run=True)
    assert dry.requests_path is None and dry.rows == requests.count() and dry.product_rows > 0 and not list(tmp_path.iterdir())
    kept = run(spark, base, requests.limit(0), "b", incremental=False, current_requests="before", current_products="old")
    assert (kept.requests_path, kept.products_path, kept.rows) == ("before", "old", 0)


def test_failure_is_audited_and_raised(spark, tmp_path):
    base, requests = str(tmp_path), FX.fx_requests(spark, SF0001)
    with pytest.raises(ValueError):
        run(spark, base, requests.union(requests), "a")
    (row,) = spark.read.parquet(base + "/audit").collect()
    assert (row.TABLE_NAME, row.STATUS) == ("PIPELINE", "FAILED") and "duplicate ID" in row.ERROR_MESSAGE
