"""Publishing of table versions: staged writes, checks, then one pointer.

A base folder holds ``<table>/v-...`` version folders and ``_pointers``, a log
of small JSON files that name each table's current version.  A load *stages*
its new versions, where no reader looks, runs its checks, and publishes all
of them by adding one pointer: readers see either all old or all new tables.
A load that fails before that leaves nothing but unnamed folders, which
``discard`` removes.  An empty frame stages nothing and keeps the table.

Pointers are created, never overwritten: of two loads that publish at the
same time the second finds its pointer's number taken and fails.

``BucketedTable`` is a table whose rows are dealt over hash buckets of the
key.  A merge reads and rewrites only buckets that the changes fall into; the
next pointer names the new folders of those and the old ones of all others.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith.sources import sinks

POINTERS = "_pointers"


@dataclass(frozen=True)
class Staged:
    """A version that is written but not published; no path where there were no rows."""

    table: str
    path: str | None
    rows: int


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _pointers(spark: SparkSession, base: str) -> list[int]:
    p, fs = _fs(spark, os.path.join(base, POINTERS))
    if not fs.exists(p):
        return []
    names = [re.fullmatch(r"p-(\d+)\.json", st.getPath().getName()) for st in fs.listStatus(p)]
    return sorted(int(m.group(1)) for m in names if m)


def _state(spark: SparkSession, base: str) -> tuple[int, dict]:
    """(number, content) of the newest whole pointer; one that a failed load left half written is passed over."""
    jvm = spark.sparkContext._jvm
    for n in reversed(_pointers(spark, base)):
        p, fs = _fs(spark, os.path.join(base, POINTERS, f"p-{n:010d}.json"))
        stream = fs.open(p)
        try:
            return n, json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            continue
        finally:
            stream.close()
    return 0, {}


def _add_pointer(spark: SparkSession, base: str, content: dict) -> None:
    n = max(_pointers(spark, base), default=0) + 1
    p, fs = _fs(spark, os.path.join(base, POINTERS, f"p-{n:010d}.json"))
    out = fs.create(p, False)  # fails if another load took the number
    out.write(json.dumps(content, sort_keys=True).encode())
    out.close()


def current(spark: SparkSession, base: str) -> dict[str, str]:
    """The published version folder of each table."""
    return {t: v for t, v in _state(spark, base)[1].items() if isinstance(v, str)}


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(current(spark, base)[table])


def stage(df: DataFrame, base: str, table: str) -> Staged:
    """Write a new version of ``table``; readers don't see it yet.  Nothing is written for an empty frame."""
    if df.isEmpty():
        return Staged(table, None, 0)
    path = sinks.new_version_path(os.path.join(base, table))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
    return Staged(table, path, seen.get["n"])


def discard(spark: SparkSession, staged: Iterable[Staged]) -> None:
    """Delete versions that won't be published."""
    sinks.drop_stored(spark, [s.path for s in staged if s.path])


def publish(spark: SparkSession, base: str, staged: Iterable[Staged], checks: Iterable[tuple[str, DataFrame]] = ()) -> dict[str, str]:
    """Make staged versions current, all at once; returns the current versions.

    ``checks``: names and frames of violating rows, which must be empty."""
    staged = list(staged)
    failed = [name for name, rows in checks if not rows.isEmpty()]
    if failed:
        discard(spark, staged)
        raise ValueError(f"not published, checks failed: {', '.join(failed)}")
    new = {s.table: s.path for s in staged if s.path}
    if new:
        _add_pointer(spark, base, _state(spark, base)[1] | new)
    return current(spark, base)


# ------------------------------------------------------------- bucketed merge

@dataclass(frozen=True)
class Merged:
    inserted: int
    updated: int
    buckets: list[int]


class BucketedTable:
    """A keyed table in hash buckets, merged bucket by bucket."""

    def __init__(self, spark: SparkSession, base: str, table: str, key: str, buckets: int = 64):
        self.spark, self.base, self.table, self.key, self.buckets = spark, base, table, key, buckets

    def _entry(self) -> dict | None:
        entry = _state(self.spark, self.base)[1].get(self.table)
        if entry and (entry["key"], entry["buckets"]) != (self.key, self.buckets):
            raise ValueError(f"{self.table} is bucketed by {entry['key']} into {entry['buckets']}")
        return entry

    def _read(self, entry: dict | None, buckets: Iterable[int] | None, schema: T.StructType) -> DataFrame:
        parts = {int(b): p for b, p in (entry or {}).get("parts", {}).items()}
        paths = [p for b, p in sorted(parts.items()) if buckets is None or b in set(buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _schema(self, entry: dict | None, default: T.StructType) -> T.StructType:
        return T.StructType.fromJson(entry["schema"]) if entry else default

    def read(self) -> DataFrame:
        """All rows; columns that were added later are null in older buckets."""
        entry = self._entry()
        if entry is None:
            raise ValueError(f"{self.table} was never published")
        return self._read(entry, None, self._schema(entry, T.StructType()))

    def folders(self) -> dict[int, str]:
        return {int(b): p for b, p in (self._entry() or {"parts": {}})["parts"].items()}

    def bucket(self, df: DataFrame):
        """A row's bucket by its key; rows without one match nothing and are dealt by their content."""
        own = F.when(F.col(f"`{self.key}`").isNull(), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).otherwise(F.xxhash64(F.col(f"`{self.key}`")))
        return F.pmod(own, F.lit(self.buckets)).cast("int")

    def merge(self, source: DataFrame, batch: int | None = None, checks=()) -> Merged:
        """Update rows of known keys, insert the others; only touched buckets are read and written.

        ``batch`` numbers make a repeated merge a no-op (a stream's replay).
        ``checks`` are functions from the merged rows to violating ones, run
        over the staged buckets before they are published."""
        entry = self._entry()
        if batch is not None and entry and entry["batch"] is not None and batch <= entry["batch"]:
            return Merged(0, 0, [])
        held: list[str] = []
        rows = sinks.materialize(source.withColumn("_bucket", self.bucket(source)), stored=held)
        try:
            if not sinks.duplicate_keys(rows, self.key).isEmpty():
                raise ValueError(f"duplicate {self.key} values")
            touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # one value a bucket at most
            target = self._read(entry, touched, self._schema(entry, source.schema))
            merged, _ = sinks.upsert_merge(target, rows.drop("_bucket"), self.key)
            path = sinks.new_version_path(os.path.join(self.base, self.table))
            seen = Observation()
            counted = merged.observe(seen, *[F.count_if(F.col("_ACTION") == a).alias(a) for a in ("INSERTED", "UPDATED")]).drop("_ACTION")
            schema = counted.schema
            if not touched:
                return Merged(0, 0, [])
            # One task a bucket's share: files of a bucket come from its own rows, a hot bucket is split by its rows' hash.
            counted.withColumn("_bucket", self.bucket(counted)).write.partitionBy("_bucket").parquet(path)
            parts = {b: f"{path}/_bucket={b}" for b in touched}
            staged = Staged(self.table, path, seen.get["INSERTED"] + seen.get["UPDATED"])
            new = self.spark.read.schema(schema).parquet(*parts.values())
            failed = [i for i, check in enumerate(checks) if not check(new).isEmpty()]
            if failed:
                discard(self.spark, [staged])
                raise ValueError(f"{self.table} not published, checks failed: {failed}")
            old = (entry or {"parts": {}})["parts"]
            _add_pointer(self.spark, self.base, _state(self.spark, self.base)[1] | {self.table: {
                "key": self.key, "buckets": self.buckets, "schema": schema.jsonValue(), "batch": batch if batch is not None else (entry or {}).get("batch"),
                "parts": old | {str(b): p for b, p in parts.items()}}})
            return Merged(seen.get["INSERTED"], seen.get["UPDATED"], touched)
        finally:
            sinks.drop_stored(self.spark, held)
