"""Profiles and code frequencies that grow load by load.

A load leaves a *state*: for each group the set of its distinct values as
bitmaps (pages of 2^15 bits) over codes, plus counts, bounds and samples that
add up.  States merge by OR and by sums, so a new load reads its own rows and
the dictionary, never the rows of earlier loads, and exact distinct counts
over all loads come from the bitmaps.

A value's code is its number where it has one (integers, days): no value
is stored for such columns.  Other values get a code from a dictionary of
(value, load, number within the load), to which a load adds the values it is
the first to hold; numbers are those of the task that wrote them, so no task
counts all values.  A page of a column of sparse numbers may hold few bits;
pages are stored compressed.

Each load is published by one pointer (``sources.publish``): a load that
fails adds nothing, a load that is repeated is skipped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith import config as K
from claimsmith.plans import profile as PR
from claimsmith.sources import publish, sinks

PAGE = 15
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
_BITS = "grp string, epoch int, page long, bits binary"
_DICTIONARY = "value string, epoch int, id long"


def number_of(kind: T.DataType, column):
    """A value's own number (integers, days since 1970), null for other kinds."""
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    return column.cast("long") if isinstance(kind, _NUMBERS) else F.lit(None).cast("long")


class DistinctState:
    """Distinct values of groups over many loads, kept under ``base``/``name``."""

    def __init__(self, spark: SparkSession, base: str, name: str):
        self.spark, self.base, self.name = spark, base, name

    def loads(self) -> dict[str, str]:
        """The folder of each load, oldest first."""
        entry = publish._state(self.spark, self.base)[1].get(self.name, {"loads": {}, "order": []})
        return {k: entry["loads"][k] for k in entry["order"]}

    def _parts(self, part: str, schema: str) -> DataFrame:
        paths = [os.path.join(p, part) for p in self.loads().values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def dictionary(self) -> DataFrame:
        return self._parts("dictionary", _DICTIONARY)

    def add(self, load: str, values: DataFrame, stats: DataFrame, stored: bool = False) -> bool:
        """Add a load's (grp, value, number) rows and its own statistics; False if it was added before.

        Null values are not counted.  ``stored``: the rows are distinct and stored already."""
        known = self.loads()
        if load in known:
            return False
        epoch, held = len(known), []
        pairs = values.where("value is not null or number is not null")
        pairs = pairs if stored else sinks.materialize(pairs.distinct(), stored=held)
        path = sinks.new_version_path(os.path.join(self.base, self.name))
        words = pairs.where("number is null").select("value").distinct()
        old = self.dictionary()
        words.join(old, "value", "left_anti").select("value", F.lit(epoch).alias("epoch"), F.monotonically_increasing_id().alias("id")) \
            .write.parquet(os.path.join(path, "dictionary"))
        every = old.unionAll(self.spark.read.schema(_DICTIONARY).parquet(os.path.join(path, "dictionary")))
        coded = (pairs.where("number is null").join(every, "value").select("grp", "epoch", "id")
                 .unionAll(pairs.where("number is not null").select("grp", F.lit(-1).alias("epoch"), F.col("number").alias("id"))))
        (coded.groupBy("grp", "epoch", F.shiftright("id", PAGE).alias("page"))
         .agg(F.bitmap_construct_agg(F.col("id").bitwiseAND(F.lit((1 << PAGE) - 1))).alias("bits")).write.parquet(os.path.join(path, "bits")))
        stats.write.parquet(os.path.join(path, "stats"))
        publish._add_pointer(self.spark, self.base, publish._state(self.spark, self.base)[1] | {
            self.name: {"loads": known | {load: path}, "order": [*known, load]}})
        sinks.drop_stored(self.spark, held)
        return True

    def counts(self) -> DataFrame:
        """(grp, n): distinct values of each group over all loads."""
        pages = self._parts("bits", _BITS).groupBy("grp", "epoch", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
        return pages.groupBy("grp").agg(F.sum(F.bitmap_count("bits")).alias("n"))

    def stats(self, schema: str) -> DataFrame:
        return self._parts("stats", schema)


# ------------------------------------------------------------- code frequency

_CODE_STATS = "DRG string, MIN_DATE date, MAX_DATE date"


def add_code_load(state: DistinctState, load: str, claims: DataFrame, cfg: K.ClaimsConfig, code: str = "DERIV_DRG_CD",
                  member: str = "INDV_ID", date: str = "SRVC_FROM_DT") -> bool:
    """Add a load of claims to the members per code."""
    rows = PR.baby_claims(claims, cfg).where(F.col(code).isNotNull())
    values = rows.select(F.col(code).cast("string").alias("grp"), F.col(member).cast("string").alias("value"),
                         number_of(claims.schema[member].dataType, F.col(member)).alias("number"))
    stats = rows.groupBy(F.col(code).cast("string").alias("DRG")).agg(F.min(date).cast("date").alias("MIN_DATE"), F.max(date).cast("date").alias("MAX_DATE"))
    return state.add(load, values, stats)


def code_frequency(state: DistinctState) -> DataFrame:
    """As ``profile.code_frequency`` over all loads."""
    dates = state.stats(_CODE_STATS).groupBy("DRG").agg(F.min("MIN_DATE").alias("MIN_DATE"), F.max("MAX_DATE").alias("MAX_DATE"))
    return (dates.join(state.counts().withColumnRenamed("grp", "DRG"), "DRG", "left")
            .select("DRG", F.coalesce("n", F.lit(0)).cast("long").alias("MEMBER_COUNT"), "MIN_DATE", "MAX_DATE")
            .orderBy(F.col("MEMBER_COUNT").desc(), F.col("DRG").asc()))


# ------------------------------------------------------------- column profile

_COLUMN_STATS = "column_name string, data_type string, total_rows long, null_count long, samples array<string>"


def add_profile_load(state: DistinctState, load: str, df: DataFrame, expected: dict, sample_size: int = 5, salt_buckets: int = 16) -> bool:
    """Add a load of a table to its column profile; False if it was added before.

    The load is read once: one count over (column, value), stored, gives the
    distinct values, the row and null counts and the samples."""
    if load in state.loads():
        return False
    cols, held = [c for c in expected if c in df.columns], []
    cell = lambda c: F.struct(F.lit(c).alias("grp"), F.col(f"`{c}`").cast("string").alias("value"),
                              number_of(df.schema[c].dataType, F.col(f"`{c}`")).alias("number"))
    counted = df.select(F.inline(F.array(*[cell(c) for c in cols]))).groupBy("grp", "value", "number").agg(F.count(F.lit(1)).alias("n"))
    counted = sinks.materialize(counted, stored=held)
    kinds = state.spark.createDataFrame([(c, str(df.schema[c].dataType)) for c in cols], "column_name string, data_type string")
    sums = counted.groupBy(F.col("grp").alias("column_name")).agg(
        F.sum("n").alias("total_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.lit(0))).alias("null_count"))
    rows = kinds.join(sums, "column_name", "left").fillna(0, ["total_rows", "null_count"])
    least = (PR.sample_values(counted.select(F.col("grp").alias("column_name"), "value"), sample_size, salt_buckets)
             .groupBy("column_name").agg(F.collect_list("value").alias("samples")))
    added = state.add(load, counted.drop("n"), rows.join(least, "column_name", "left"), stored=True)
    sinks.drop_stored(state.spark, held)
    return added


def profile_columns(state: DistinctState, expected: dict, table_name: str, sample_size: int = 5) -> DataFrame:
    """As ``profile.profile_columns`` over all loads."""
    own = state.stats(_COLUMN_STATS).groupBy("column_name").agg(
        F.max("data_type").alias("data_type"), F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"),
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("samples", F.array().cast("array<string>")))))), 1, sample_size).alias("samples"))
    meta = state.spark.createDataFrame([(c, *map(expected[c].__getitem__, range(3))) for c in expected],
                                       "column_name string, critical boolean, key_field boolean, description string")
    rows = own.join(meta, "column_name").join(state.counts().withColumnRenamed("grp", "column_name"), "column_name", "left")
    # A null counts as one more value, as in the profile of a whole table.
    n = F.coalesce("n", F.lit(0)) + (F.col("null_count") > 0).cast("long")
    meta_cols = rows.withColumn("_n_distinct", n).withColumn("sample_values", F.when(F.size("samples") > 0, F.array_join("samples", ", ")))
    return PR.profile_rows(meta_cols, table_name)
