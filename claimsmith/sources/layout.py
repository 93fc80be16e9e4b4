"""Layouts of claims and eligibility: by service month, and by member.

By month, so that a study window reads its own months only.

``write_by_month`` adds ``SRVC_MONTH`` (yyyymm of the service date, null
dates apart) as the folder level; rows of a month are dealt over tasks by
member, so a large month is many files.  ``months_within`` turns a date
window into a filter on that column, which Spark applies to folders before
any file is opened.  The bounds that a study window is derived from come from
the first and last months that hold usable rows, not from the whole table.

By member, as tables bucketed and sorted by ``INDV_ID``: the cohort's
distinct members, the semi-join, the eligibility join, the claim flags and the stay
windows all group by the member, so none of them shuffles claims again.  The
join on (member, claim) needs ``spark.sql.requireAllClusterKeysForCoPartition``
off in such a session: a member's rows are together, hence a claim's.  A member with a huge share of all lines makes a huge bucket; such
tables are better left unbucketed, where Spark splits hot members.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "SRVC_MONTH"


def month_of(day) -> int:
    return day.year * 100 + day.month


def write_by_month(claims: DataFrame, path: str, from_col: str = "SRVC_FROM_DT", key: str = "INDV_ID", files: int = 8) -> None:
    """Write ``claims`` as one folder a month, each in about ``files`` files sorted by member."""
    month = (F.year(from_col) * 100 + F.month(from_col)).cast("int")
    rows = claims.withColumn(MONTH, month).withColumn("_file", F.pmod(F.xxhash64(key), F.lit(files)))
    (rows.repartition(MONTH, "_file").drop("_file").sortWithinPartitions(MONTH, key)
     .write.mode("errorifexists").partitionBy(MONTH).parquet(path))


def months_within(claims: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``claims`` of the months that [start, end] touches; unchanged if they aren't laid out by month."""
    if MONTH not in claims.columns:
        return claims
    return claims.where(F.col(MONTH).between(month_of(start), month_of(end)))


def stored_months(spark: SparkSession, path: str) -> list[int]:
    """The months that have a folder, in order: a listing, no data is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [re.fullmatch(MONTH + r"=(\d+)", st.getPath().getName()) for st in fs.listStatus(p)]
    return sorted(int(m.group(1)) for m in names if m)


def month_bounds(spark: SparkSession, path: str, from_col: str = "SRVC_FROM_DT", process_col: str = "PROCESS_DT") -> DataFrame:
    """The row of ``tables.scan_sql_bounds`` for claims laid out by month.

    Service bounds read months from either end until one has a usable row;
    the latest process date reads that column and the service date's."""
    claims = spark.read.parquet(path)
    usable = claims.where(F.col(from_col).isNotNull() & F.col(process_col).isNotNull())
    months = stored_months(spark, path)

    def bound(order, pick):
        for m in order:
            found = usable.where(F.col(MONTH) == m).agg(pick(from_col)).first()[0]
            if found is not None:
                return found
        return None
    lo, hi = bound(months, F.min), bound(reversed(months), F.max)
    kind = claims.schema[from_col].dataType
    return usable.agg(F.lit(lo).cast(kind).alias("MIN_FROMDATE"), F.lit(hi).cast(kind).alias("MAX_FROMDATE"), F.max(process_col).alias("MAX_PAIDDATE"))


def write_by_member(df: DataFrame, table: str, key: str = "INDV_ID", buckets: int = 64) -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted by ``key``, one file a bucket, and read it."""
    df.repartition(buckets, key).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
