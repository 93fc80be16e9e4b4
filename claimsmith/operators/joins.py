"""Join shapes: interval and bucketed range joins, trimmed joins, null-safe enrichment.

Range joins always carry an equi key (member).  To avoid pairing every row
of a member with every interval of that member (quadratic for a hot
member), intervals are exploded into fixed-width day buckets and points
join on (keys, bucket) with the exact range as residual predicate.  Each
(point, interval) pair meets in exactly one bucket - the point's - so no
deduplication is needed, and an interval of length L expands to at most
L / bucket_days + 2 rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.functions.exprs import c

def day_bucket(col, bucket_days: int) -> Column:
    return F.floor(F.datediff(c(col), F.lit("1970-01-01").cast("date")) / F.lit(bucket_days)).cast("int")


def range_join(points: DataFrame, intervals: DataFrame, keys: list[str], point: str,
               lo: Column | str, hi: Column | str, bucket_days: int = 32,
               how: str = "inner") -> DataFrame:
    """points JOIN intervals ON keys AND lo <= point <= hi (inclusive).

    ``lo``/``hi`` are columns (or names) of ``intervals``.  ``how`` may be
    'inner' or 'left' (points without a matching interval kept once).
    """
    lo_c, hi_c = c(lo), c(hi)
    iv = (intervals.withColumn("_lo", lo_c).withColumn("_hi", hi_c)
          .filter(F.col("_lo").isNotNull() & F.col("_hi").isNotNull() & (F.col("_lo") <= F.col("_hi")))
          .withColumn("_ib", F.explode(F.sequence(day_bucket("_lo", bucket_days),
                                                  day_bucket("_hi", bucket_days)))))
    iv = iv.select(*[F.col(f"`{x}`").alias(f"_iv_{x}") for x in intervals.columns], "_lo", "_hi", "_ib")
    pt = points.withColumn("_pb", day_bucket(point, bucket_days))
    cond = reduce(lambda a, b: a & b,
                  [F.col(k) == F.col(f"_iv_{k}") for k in keys]
                  + [F.col("_pb") == F.col("_ib"), F.col("_lo") <= F.col(point), F.col(point) <= F.col("_hi")])
    joined = pt.join(iv, cond, how)
    out_cols = [F.col(f"`{x}`") for x in points.columns] + \
               [F.col(f"`_iv_{x}`").alias(x) for x in intervals.columns if x not in keys]
    return joined.select(*out_cols)


def _day(col) -> Column:
    return F.datediff(c(col), F.lit("1970-01-01").cast("date"))


def interval_cells(intervals: DataFrame, keys: list[str], lo: str, starts: int) -> DataFrame:
    """(keys, _edges) of keys with more than ``starts`` intervals: the days that cut their time line into cells.

    A cell holds about ``starts`` interval starts, one day's at least.  Starts
    are counted by day first, so a hot key is as many rows as it has days."""
    days = intervals.groupBy(*keys, _day(lo).alias("_d")).agg(F.count("*").alias("_n"))
    own = W.partitionBy(*keys)
    cell = F.floor((F.sum("_n").over(own.orderBy("_d")) - F.col("_n")) / starts)
    cut = days.select(*keys, "_d", cell.alias("_c"), F.sum("_n").over(own).alias("_all")).where(F.col("_all") > starts)
    return (cut.groupBy(*keys, "_c").agg(F.min("_d").alias("_from"))
            .groupBy(*keys).agg(F.array_sort(F.collect_list("_from")).alias("_edges")))


def _cell(day: Column) -> Column:
    """How many of the sorted ``_edges`` are not after the day (binary search); 0 without edges."""
    steps = F.array(*[F.lit(1 << b) for b in range(21, -1, -1)])  # more edges than days a date can be
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_edges", at + step - 1) <= day, at + step).otherwise(at))
    return F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(found)


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, lo: Column | str, hi: Column | str,
                  how: str = "inner", starts: int = 64) -> DataFrame:
    """points JOIN intervals ON keys AND lo <= point <= hi (inclusive), by cells of equal numbers of interval starts.

    The time line of a key with many intervals is cut where they start, one
    cell for about ``starts`` of them; other keys are one cell.  A point is in
    one cell, an interval in those it spans, so an interval is copied once
    per ``starts`` intervals that begin within it, however long it is: rows
    shuffled are points, intervals, and the mean number of intervals that are
    open at a time over ``starts``.  A point is held against the intervals of
    its cell only.  The points of a hot key and cell are split by Spark's
    skew-join rule.  ``how``: 'inner' or 'left' (a point without an interval
    is kept once).
    """
    own = (intervals.withColumns({"_lo": c(lo), "_hi": c(hi)}).where("_lo is not null and _hi is not null and _lo <= _hi"))
    edges = interval_cells(own, keys, "_lo", starts)
    iv = own.join(edges, keys, "left").withColumn("_ic", F.explode(F.sequence(_cell(_day("_lo")), _cell(_day("_hi")))))
    iv = iv.select(*[F.col(f"`{x}`").alias(f"_iv_{x}") for x in intervals.columns], "_lo", "_hi", "_ic")
    pt = points.join(edges, keys, "left").withColumn("_pc", _cell(_day(point))).drop("_edges")
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_iv_{k}") for k in keys]
                  + [F.col("_pc") == F.col("_ic"), F.col("_lo") <= F.col(point), F.col(point) <= F.col("_hi")])
    return pt.join(iv, cond, how).select(*[F.col(f"`{x}`") for x in points.columns],
                                         *[F.col(f"`_iv_{x}`").alias(x) for x in intervals.columns if x not in keys])


def join_trimmed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join bringing only right-side columns not already on the left."""
    extra = [x for x in right.columns if x not in keys and x not in left.columns]
    return left.join(right.select(*keys, *extra), keys, how)


def join_enrich_nullsafe(df: DataFrame, other: DataFrame, key: str, cols: list[str],
                         null_salts: int = 64, null_matches: str | None = None) -> DataFrame:
    """Left join ``cols`` of ``other`` by ``key`` where null matches null
    (pandas merge semantics; duplicates on the right fan out).  No-op when
    ``other`` lacks the key or ``df`` lacks it.

    ``null_matches`` names a column and keeps null x null compact: a row with
    a null key stays one row, with the largest value of each column over the
    null rows of ``other`` and, in the named column, how many those are
    (other rows: 1 with a match, else 0)."""
    if key not in df.columns or key not in other.columns:
        return df
    if null_matches:
        nulls = other.where(F.col(key).isNull()).agg(F.count("*").alias("_nn"), *[F.max(x).alias(f"_n_{x}") for x in cols])  # one row
        right = other.where(F.col(key).isNotNull()).select(F.col(key).alias("_rk"), *[F.col(x).alias(f"_r_{x}") for x in cols])
        # Rows without a key match nothing; a hash of the row deals them to many tasks.
        salted = df.withColumn("_ls", F.when(F.col(key).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0)))
        joined = salted.join(right.withColumn("_rs", F.lit(0)), (F.col(key) == F.col("_rk")) & (F.col("_ls") == F.col("_rs").cast("long")), "left")
        rows = joined.crossJoin(F.broadcast(nulls))
        none = F.col(key).isNull()
        return rows.select(*[F.col(f"`{x}`") for x in df.columns], *[F.when(none, F.col(f"_n_{x}")).otherwise(F.col(f"_r_{x}")).alias(x) for x in cols],
                           F.when(none, F.col("_nn")).otherwise(F.col("_rk").isNotNull().cast("long")).alias(null_matches))
    # Null keys are dealt over ``null_salts`` tasks: left rows by their hash,
    # the right side's null rows (all of them) to each.
    right = other.select(F.col(key).alias("_rk"), *cols).withColumn("_rs", F.explode(
        F.when(F.col("_rk").isNull(), F.sequence(F.lit(0), F.lit(null_salts - 1))).otherwise(F.array(F.lit(0)))))
    left = df.withColumn("_ls", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(null_salts)))
                         .otherwise(F.lit(0)).cast("int"))
    return left.join(right, left[key].eqNullSafe(right["_rk"]) & (F.col("_ls") == F.col("_rs")), "left").drop("_rk", "_ls", "_rs")


def join_padded_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    width: int = 5) -> DataFrame:
    """Left join after left-padding both keys with zeros to ``width``."""
    lk = F.lpad(F.col(left_key).cast("string"), width, "0")
    rk = F.lpad(F.col(right_key).cast("string"), width, "0")
    r = right.withColumn("_rpad", rk)
    return left.withColumn("_lpad", lk).join(r, F.col("_lpad") == F.col("_rpad"), "left").drop("_lpad", "_rpad")


FILTER_WORDS = 1 << 18  # 64-bit words of a key filter, 2 MB


def among(keys: DataFrame, key: str, cut=None) -> Column:
    """False where column ``key`` is none of the ``keys`` for sure: a plain condition, which Spark pushes to the scans.

    One bit for each key's hash in a stored row of ``FILTER_WORDS`` words,
    however many keys there are; an exact join has to follow.  A null key is
    not among them.  ``cut`` stores the row."""
    from claimsmith.sources.sinks import materialize
    cut = cut or materialize
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    word, bit = F.floor(place / 64).cast("int"), F.pmod(place, F.lit(64)).cast("int")
    one = F.element_at(F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)]), bit + 1)
    held = keys.where(F.col(key).isNotNull()).groupBy(word.alias("_w")).agg(F.bit_or(one).alias("_b"))
    dense = keys.sparkSession.range(FILTER_WORDS).join(held, F.col("id") == F.col("_w"), "left")
    row = dense.agg(F.array_sort(F.collect_list(F.struct("id", F.coalesce("_b", F.lit(0).cast("long")).alias("b")))).alias("r"))
    words = cut(row.select(F.transform("r", lambda x: x["b"]).alias("words"))).scalar()
    return F.getbit(F.get(words, word), bit) == 1
