"""Request list ETL: clean -> explode to products -> enrich -> metrics.

The wide list has one row per request and a flag + start/end/status column
group per product.  Exploding is an ``array`` of per-product structs,
filtered to requested products and ``inline``d - a narrow, per-row step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsmith import config as K
from claimsmith.functions.exprs import (
    DATE_FORMATS, bracket_text, days_between_clock, elapsed_days, null_safe_concat, parse_when,
)
from claimsmith.operators import classify
from claimsmith.operators.joins import join_enrich_nullsafe


def _q(name: str):
    return F.col(f"`{name}`")


def clean_requests(df: DataFrame, flags, mapping: dict) -> DataFrame:
    """Recode client types by the caller's labels, null flags -> false, fill the products text."""
    out = classify.map_values(df, "CLIENT_TYPE_DETAIL", mapping) if "CLIENT_TYPE_DETAIL" in df.columns else df
    out = classify.fill_flags(out, flags)
    return classify.flag_list_text(out, flags)


def resolve_columns(df: DataFrame, candidates=K.REQUEST_COLUMN_CANDIDATES) -> dict:
    """Logical field -> first existing candidate column (or a null literal)."""
    out = {}
    for field, names in candidates.items():
        found = next((n for n in names if n in df.columns), None)
        out[field] = _q(found) if found else F.lit(None).cast("string")
    return out


def explode_products(df: DataFrame, products) -> DataFrame:
    """One row per requested product (flag true), with its own dates/status."""
    fields = resolve_columns(df)
    present = [p for p in products if p[2] in df.columns]
    items = F.array(*[F.struct(
        _q(flag).alias("_REQ"), F.lit(name).alias("PRODUCT"), F.lit(cat).alias("PRODUCT_CATEGORY"),
        (_q(start) if start in df.columns else F.lit(None).cast("date")).alias("START_DATE"),
        (_q(end) if end in df.columns else F.lit(None).cast("date")).alias("COMPLETE_DATE"),
        (_q(status) if status in df.columns else F.lit(None).cast("string")).alias("STATUS"))
        for name, cat, flag, start, end, status in present])
    base = df.select(*[v.alias(k) for k, v in fields.items()], items.alias("_items"))
    exploded = base.select(*fields.keys(), F.inline(F.filter("_items", lambda x: x["_REQ"] == F.lit(True))))
    return exploded.select("ID", "TITLE", "REQUEST_DATE", "CLIENT", "MARKET", "REQUESTOR", "CLIENT_TYPE",
                           "OVERALL_STATUS", "PRODUCTS_REQUESTED", "SALESFORCE_ID", "PRODUCT",
                           "PRODUCT_CATEGORY", "START_DATE", "COMPLETE_DATE", "STATUS", "STATUS_CHANGE_DATE",
                           "CLOSED_DATE", "PTRR")


def request_metrics(df: DataFrame, as_of: dt.date | dt.datetime, url_prefix: str = K.REQUEST_URL_PREFIX,
                    date_formats=DATE_FORMATS) -> DataFrame:
    """Derived request/product metrics against an ``as_of`` clock; day counts are elapsed days, floored."""
    out = df
    for c in ("REQUEST_DATE", "START_DATE", "COMPLETE_DATE", "STATUS_CHANGE_DATE", "CLOSED_DATE"):
        if c in out.columns:
            out = out.withColumn(c, parse_when(df, c, date_formats))
    days_on = F.coalesce(days_between_clock(as_of, "STATUS_CHANGE_DATE"), F.lit(0))
    open_ = F.coalesce(F.col("STATUS").isin(list(K.OPEN_STATUS)), F.lit(False))
    out = out.withColumns({
        "DAYS_OPEN": days_between_clock(as_of, "REQUEST_DATE"),
        "PRODUCT_TAT": elapsed_days("START_DATE", "COMPLETE_DATE"),
        "COMPLETED_PRODUCT": F.coalesce(F.col("STATUS").isin(list(K.COMPLETE_STATUS)), F.lit(False)),
        "REQUEST_TYPE": bracket_text("TITLE"),
        "REQUEST_YEAR": F.year("REQUEST_DATE"),
        "PRODUCT_OPEN": open_,
        "DAYS_ON_STATUS": days_on,
        "NEEDS_ATTENTION": open_ & (days_on > K.DAYS_ON_STATUS_THRESHOLD),
    })
    if "HAS_VALUE" not in out.columns:
        out = out.withColumn("HAS_VALUE", F.lit(None).cast("boolean"))
    return out.withColumn("URL", null_safe_concat(url_prefix, "ID"))


def transform_products(requests: DataFrame, initiatives: DataFrame, products, as_of: dt.date | dt.datetime,
                       mapping: dict) -> DataFrame:
    """Clean -> explode -> enrich with initiatives (null-safe key) -> metrics.

    The flag columns are those of the caller's ``products``."""
    cleaned = clean_requests(requests, [p[2] for p in products], mapping)
    exploded = explode_products(cleaned, products)
    enriched = join_enrich_nullsafe(exploded, initiatives, "SALESFORCE_ID", ["HAS_VALUE"])
    return request_metrics(enriched, as_of)
