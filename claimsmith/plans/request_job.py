"""The request load as one job: raw list (merge or refresh), product rows, audit.

Both tables are staged, then published by one pointer (see
``sources.publish``), so a failure anywhere leaves both at their old versions.
A run starts from the published versions unless the caller names others.
Every load has an audit row, written once a run; a failure is audited too,
then the error goes on.
"""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimsmith.plans.requests import clean_requests, request_metrics, explode_products
from claimsmith.operators.joins import join_enrich_nullsafe
from claimsmith.sources import publish, sinks


@dataclass(frozen=True)
class RequestLoad:
    """What a run read and wrote; paths are None where nothing was written."""

    requests_path: str | None
    products_path: str | None
    rows: int
    product_rows: int


def merge_load(spark: SparkSession, rows: DataFrame, current: str | None, base: str, key: str,
               table: str = "REQUESTS") -> tuple[publish.Staged, int, int]:
    """Stage rows merged into the current version by key; (staged version, inserted, updated).

    Counts are observed while the merged rows are written, so the join runs once."""
    if not sinks.duplicate_keys(rows, key).isEmpty():
        raise ValueError(f"duplicate {key} values in the list")
    target = spark.read.parquet(current) if current else spark.createDataFrame([], rows.schema)
    merged, _ = sinks.upsert_merge(target, rows, key)
    seen = Observation()
    counted = merged.observe(seen, *[F.count_if(F.col("_ACTION") == a).alias(a) for a in ("INSERTED", "UPDATED", "KEPT")])
    path = sinks.new_version_path(f"{base}/{table}")
    counted.drop("_ACTION").write.mode("errorifexists").parquet(path)
    return publish.Staged(table, path, sum(seen.get.values())), seen.get["INSERTED"], seen.get["UPDATED"]


def request_job(spark: SparkSession, requests: DataFrame, initiatives: DataFrame, products, mapping: dict,
                as_of: dt.date | dt.datetime, base: str, audit_path: str, run_id: str, run_timestamp: dt.datetime,
                current_requests: str | None = None, current_products: str | None = None, incremental: bool = True,
                dry_run: bool = False, key: str = "ID", created_by: str | None = None,
                tables: tuple[str, str] = ("REQUESTS", "PRODUCTS")) -> RequestLoad:
    """Clean, load the raw list, transform to product rows, load them, audit both.

    ``incremental`` merges the list by ``key``, else it replaces it; product
    rows always replace theirs.  An empty list keeps the current versions.
    ``dry_run`` writes nothing and counts only.
    """
    records: list[DataFrame] = []

    def audit(table, load_type, n_in, n_out, inserted, updated, began, status="SUCCESS", message=None):
        records.append(sinks.audit_record(
            spark, RUN_ID=run_id, RUN_TIMESTAMP=run_timestamp, TABLE_NAME=table, LOAD_TYPE=load_type, ROWS_EXTRACTED=n_in,
            ROWS_TRANSFORMED=n_out, ROWS_INSERTED=inserted, ROWS_UPDATED=updated, STATUS=status, ERROR_MESSAGE=message,
            DURATION_SECONDS=round(_decimal(time.monotonic() - began), 2), CREATED_BY=created_by))

    def transform(cleaned):
        exploded = explode_products(cleaned, products)
        rows = request_metrics(join_enrich_nullsafe(exploded, initiatives, "SALESFORCE_ID", ["HAS_VALUE"]), as_of)
        return sinks.normalize_dates(rows)[0]

    began = time.monotonic()
    staged: list[publish.Staged] = []
    held: list[str] = []
    try:
        cleaned = clean_requests(requests, [p[2] for p in products], mapping)
        if dry_run:
            return RequestLoad(None, None, cleaned.count(), transform(cleaned).count())
        # Stored once: the duplicate check, the merge and the product rows read it.
        cleaned = sinks.materialize(cleaned, stored=held)
        n = cleaned.count()
        now = publish.current(spark, base)
        old = current_requests or now.get(tables[0]), current_products or now.get(tables[1])
        if incremental and n:
            raw, inserted, updated = merge_load(spark, cleaned, old[0], base, key, tables[0])
        else:
            raw = publish.stage(cleaned, base, tables[0])
            inserted, updated = raw.rows, 0
        staged.append(raw)
        audit(tables[0], "INCREMENTAL" if incremental else "FULL_REFRESH", n, n, inserted, updated, began)
        began = time.monotonic()
        product = publish.stage(transform(cleaned), base, tables[1])
        staged.append(product)
        audit(tables[1], "FULL_REFRESH", n, product.rows, product.rows, 0, began)
        publish.publish(spark, base, staged)
        sinks.audit_append(records[0].unionAll(records[1]), audit_path)
        return RequestLoad(raw.path or old[0], product.path or old[1], n, product.rows)
    except Exception as e:
        if not dry_run:
            published = set(publish.current(spark, base).values())
            publish.discard(spark, [s for s in staged if s.path not in published])
            audit("PIPELINE", "FAILED", 0, 0, 0, 0, began, "FAILED", str(e).splitlines()[0] if str(e) else type(e).__name__)
            sinks.audit_append(records[-1], audit_path)
        raise
    finally:
        sinks.drop_stored(spark, held)


def _decimal(x: float):
    from decimal import Decimal

    return Decimal(str(x))
