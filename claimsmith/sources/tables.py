"""Sources: table scans, optional and CSV sources, reference code sets.

All readers return lazy DataFrames; filters and projections applied later
reach the Parquet scan (``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

import os
import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith.config import ClaimsConfig, table_name
from claimsmith.functions.exprs import DATE_FORMATS, parse_when


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet`` (a file or a directory)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scan_table(spark: SparkSession, table_type: str, cfg: ClaimsConfig,
               root: str | None = None) -> DataFrame:
    """Named-table scan through the config's naming rule.

    With ``root`` the resolved name is read as Parquet under that folder,
    otherwise from the session catalog.  Unknown table types raise.
    """
    name = table_name(table_type, cfg)
    if root is not None:
        return spark.read.parquet(os.path.join(root, name))
    return spark.table(name)


def scan_sql_bounds(df: DataFrame, from_col: str = "SRVC_FROM_DT",
                    process_col: str = "PROCESS_DT") -> DataFrame:
    """One-row frame: min/max service date, max process date (both non-null)."""
    return (df.filter(F.col(from_col).isNotNull() & F.col(process_col).isNotNull())
            .agg(F.min(from_col).alias("MIN_FROMDATE"),
                 F.max(from_col).alias("MAX_FROMDATE"),
                 F.max(process_col).alias("MAX_PAIDDATE")))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def scan_csv_upper(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types, column names upper-cased.

    A missing path raises (the request list is mandatory).
    """
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    return upper_columns(spark.read.csv(path, header=True, inferSchema=True))


_DATE_WORD = re.compile(r"(^|_)DATE($|_)")


def date_named_columns(columns) -> list[str]:
    """Columns whose name contains the whole word DATE (not e.g. UPDATED_BY)."""
    return [c for c in columns if _DATE_WORD.search(c.upper())]


def coerce_date_columns(df: DataFrame, formats=DATE_FORMATS) -> DataFrame:
    """Every DATE-named string column -> timestamp by ISO or ``formats``; unparsable -> null."""
    out = df
    for c in date_named_columns(df.columns):
        if isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, parse_when(df, c, formats))
    return out


def as_declared(df: DataFrame, schema: T.StructType, formats=DATE_FORMATS) -> DataFrame:
    """Columns of ``schema`` in its order and types, whatever the file holds.

    Text dates are read as ISO or by ``formats``; a value that isn't of the
    declared type is null, as is a column that the file lacks."""
    def typed(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, (T.DateType, T.TimestampType)) and isinstance(df.schema[f.name].dataType, T.StringType):
            return parse_when(df, f.name, formats).cast(f.dataType)
        return F.col(f"`{f.name}`").try_cast(f.dataType)
    return df.select(*[typed(f).alias(f.name) for f in schema.fields])


def scan_optional(spark: SparkSession, path: str, schema: str | T.StructType,
                  fmt: str = "csv") -> DataFrame:
    """Optional source with a declared schema: missing, empty or unreadable -> empty frame, never fails.

    Text files are read as text once and cast as declared, so types don't
    depend on the data and no second pass infers them."""
    empty = spark.createDataFrame([], schema)
    if not path or not _path_exists(spark, path):
        return empty
    try:
        found = spark.read.csv(path, header=True) if fmt == "csv" else spark.read.format(fmt).load(path)
    except (PySparkException, Py4JJavaError):  # a file that Spark can't read is treated as absent
        return empty
    return as_declared(upper_columns(found), empty.schema) if found.columns else empty


def ref_codes(ref: DataFrame, code_col: str = "CODE", alias: str = "CODE") -> DataFrame:
    """Reference code set as distinct strings (a small, broadcastable frame)."""
    return ref.select(F.col(code_col).cast("string").alias(alias)).distinct()


def empty_typed(spark: SparkSession, like: DataFrame | T.StructType) -> DataFrame:
    """Empty frame with the full schema (so downstream columns resolve)."""
    schema = like.schema if isinstance(like, DataFrame) else like
    return spark.createDataFrame([], schema)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
