"""Sinks: overwrite/append writes, key-based upsert, full refresh, schema
evolution, typed tables, audit records, reports and materialisation.

Targets are Parquet folders.  A write never overwrites a path it is reading
from: merges and refreshes write a new version folder and return it.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith.functions.exprs import DATE_FORMATS, parse_when
from claimsmith.session import ensure_checkpoint_dir
from claimsmith.sources.tables import date_named_columns


# Intermediate tables of this process that haven't been dropped yet.
STORED: list[str] = []


def release_stored(spark: SparkSession) -> int:
    """Drop every stored intermediate table; call when their results are read.  Returns how many."""
    n = len(STORED)
    drop_stored(spark, list(STORED))
    return n


def drop_stored(spark: SparkSession, paths) -> None:
    """Delete stored intermediate tables (paths returned by ``materialize``)."""
    STORED[:] = [p for p in STORED if p not in set(paths)]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)


def materialize(df: DataFrame, mode: str = "table", stored: list | None = None, partition_by=()) -> DataFrame:
    """Cut a long plan so later stages start from stored data.

    ``table`` (default) writes Parquet under the session's checkpoint folder
    (shared storage on a cluster) and reads it back: columnar, lineage cut,
    survives executor loss.  ``checkpoint`` uses Spark's reliable
    checkpoint; ``persist`` keeps the plan and caches (no lineage cut).
    ``partition_by`` lays a table out in a folder a value, for readers of a part.
    """
    if mode == "table":
        spark = df.sparkSession
        path = os.path.join(ensure_checkpoint_dir(spark), "tables", uuid.uuid4().hex)
        STORED.append(path)
        if stored is not None:
            stored.append(path)
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        # Persist first so writing the checkpoint does not recompute the plan.
        df.persist(StorageLevel.MEMORY_AND_DISK)
        out = df.checkpoint(eager=True)
        df.unpersist()
        return out
    if mode == "persist":
        return df.persist()
    if mode == "none":
        return df
    raise ValueError(mode)


def sink_overwrite(df: DataFrame, path: str, dry_run: bool = False, preview: int = 5):
    """Overwrite-save as Parquet; dry run returns (row count, first rows)."""
    if dry_run:
        return df.count(), df.limit(preview)
    df.write.mode("overwrite").parquet(path)
    return None


def upsert_merge(target: DataFrame, source: DataFrame, key: str = "ID") -> tuple[DataFrame, DataFrame]:
    """Key-based MERGE as a pure function: (merged rows, counts).

    Matched keys take every non-key column from the source; unmatched source
    rows are inserted; target-only rows are kept.  A null source key never
    matches (inserted).  Columns only in the source are added (null for old
    rows).  Duplicate source keys are rejected by the caller's check
    (``duplicate_keys``).  One full-outer join, one aggregate for counts.
    """
    cols = list(dict.fromkeys(target.columns + [c for c in source.columns if c not in target.columns]))
    s = source.select(*[F.col(f"`{c}`").alias(f"s_{c}") for c in source.columns]).withColumn("_s", F.lit(True))
    t = target.select(*[F.col(f"`{c}`").alias(f"t_{c}") for c in target.columns]).withColumn("_t", F.lit(True))
    # Null keys match nothing; a hash of the row deals them to many tasks.
    salt = lambda d, p: d.withColumn(f"_{p}_salt", F.when(F.col(f"{p}_{key}").isNull(), F.xxhash64(*d.columns)).otherwise(F.lit(0)))
    s, t = salt(s, "s"), salt(t, "t")
    j = t.join(s, (F.col(f"t_{key}") == F.col(f"s_{key}")) & (F.col("_t_salt") == F.col("_s_salt")), "full_outer")
    src_present = F.col("_s").isNotNull()
    out = []
    for c in cols:
        if c in source.columns and c in target.columns:
            out.append(F.when(src_present, F.col(f"`s_{c}`")).otherwise(F.col(f"`t_{c}`")).alias(c))
        elif c in source.columns:
            out.append(F.col(f"`s_{c}`").alias(c))
        else:  # target-only column: kept as is (null for inserted rows)
            out.append(F.col(f"`t_{c}`").alias(c))
    action = (F.when(F.col("_s").isNotNull() & F.col("_t").isNotNull(), "UPDATED")
              .when(F.col("_s").isNotNull(), "INSERTED").otherwise("KEPT"))
    merged = j.select(*out, action.alias("_ACTION"))
    counts = merged.agg(F.count_if(F.col("_ACTION") == "INSERTED").alias("INSERTED"),
                        F.count_if(F.col("_ACTION") == "UPDATED").alias("UPDATED"),
                        F.count_if(F.col("_ACTION") == "KEPT").alias("KEPT"))
    return merged, counts


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (non-null); empty means safe to merge."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)


def new_version_path(base: str) -> str:
    return os.path.join(base, f"v-{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}")


def full_refresh(spark: SparkSession, df: DataFrame, target_path: str | None) -> tuple[str | None, int, int]:
    """Truncate + reload: write a new version under the table's own folder; empty input writes nothing and keeps the target.

    Returns (current path, rows inserted, rows updated=0)."""
    if df.isEmpty():
        return target_path, 0, 0
    path = new_version_path(target_path or os.path.join(ensure_checkpoint_dir(spark), "refreshed"))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
    return path, seen.get["n"], 0


_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def warehouse_type(field: T.StructField, date_cols) -> T.DataType:
    """Creation type map: date cols -> DATE, integers -> NUMBER(38,0), other
    numerics -> NUMBER(38,6), booleans kept, everything else text."""
    t = field.dataType
    if field.name in date_cols or isinstance(t, (T.DateType, T.TimestampType)):
        return T.DateType()
    if isinstance(t, T.BooleanType):
        return T.BooleanType()
    if isinstance(t, _INT_TYPES):
        return T.DecimalType(38, 0)
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DecimalType(38, 6)
    return T.StringType()


def typed_table(df: DataFrame, date_cols=()) -> DataFrame:
    """Cast every column to its warehouse creation type."""
    date_cols = set(date_cols)
    return df.select(*[F.col(f"`{f.name}`").cast(warehouse_type(f, date_cols)).alias(f.name)
                       for f in df.schema.fields])


def schema_evolve(target: DataFrame, new: DataFrame, date_cols=()) -> DataFrame:
    """Target rows plus new rows, with columns that only the new frame has
    added (typed by ``warehouse_type``, null for old rows).  Removed
    columns are kept (null for new rows)."""
    date_cols = set(date_cols)
    added = [f for f in new.schema.fields if f.name not in target.columns]
    t = target.withColumns({f.name: F.lit(None).cast(warehouse_type(f, date_cols)) for f in added}) if added else target
    n = new.withColumns({f.name: F.col(f"`{f.name}`").cast(warehouse_type(f, date_cols)) for f in added}) if added else new
    return t.unionByName(n, allowMissingColumns=True)


def normalize_dates(df: DataFrame, formats=DATE_FORMATS) -> tuple[DataFrame, list[str]]:
    """Every DATE-named column -> 'YYYY-MM-DD' text (ISO or ``formats``), unparsable -> null."""
    touched = date_named_columns(df.columns)
    out = df
    for c in touched:
        out = out.withColumn(c, F.date_format(parse_when(df, c, formats), "yyyy-MM-dd"))
    return out, touched


AUDIT_SCHEMA = T.StructType([
    T.StructField("RUN_ID", T.StringType(), False),
    T.StructField("RUN_TIMESTAMP", T.TimestampType(), True),
    T.StructField("TABLE_NAME", T.StringType(), False),
    T.StructField("LOAD_TYPE", T.StringType(), True),
    T.StructField("ROWS_EXTRACTED", T.LongType(), True),
    T.StructField("ROWS_TRANSFORMED", T.LongType(), True),
    T.StructField("ROWS_INSERTED", T.LongType(), True),
    T.StructField("ROWS_UPDATED", T.LongType(), True),
    T.StructField("STATUS", T.StringType(), True),
    T.StructField("ERROR_MESSAGE", T.StringType(), True),
    T.StructField("DURATION_SECONDS", T.DecimalType(10, 2), True),
    T.StructField("CREATED_BY", T.StringType(), True),
])


def audit_record(spark: SparkSession, **values) -> DataFrame:
    """One audit row (12 columns); logical key (RUN_ID, TABLE_NAME)."""
    row = [values.get(f.name) for f in AUDIT_SCHEMA.fields]
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def audit_append(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def export_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report dataset (one folder per tab) as CSV with header or JSON."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(fmt)
