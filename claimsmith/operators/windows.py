"""Per-key picks, sessionisation and ranking.

Design for skew: a single member or event may hold a large share of all
rows, so "one row per key" picks are aggregates (``max_by``/``min_by`` over a
struct sort key, which Spark pre-aggregates map-side) rather than
``row_number`` windows that pull a whole key into one task.  Gap-based stay
stitching runs on distinct (admit, discharge) intervals, whose count per
member is bounded by the calendar, not by the number of claim lines.
Per-event ranks are computed in two salted stages that only keep the top
``k`` candidates per salt bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.functions.exprs import c


def desc_nulls_last_key(col) -> list[Column]:
    """Struct fields that make max() pick the largest non-null value first."""
    return [c(col).isNotNull(), c(col)]


def asc_nulls_last_key(col) -> list[Column]:
    """Struct fields that make min() pick the smallest non-null value first."""
    return [c(col).isNull(), c(col)]


def pick_one(df: DataFrame, keys: list[str], sort_key: list[Column], payload: list[str],
             largest: bool = True) -> DataFrame:
    """One row per key: the payload of the row with the max (or min) sort key.

    An aggregate, so it combines map-side and never buffers a whole key.
    The sort key must end with a unique tie-breaker for determinism.
    """
    sk = F.struct(*[x.alias(f"k{i}") for i, x in enumerate(sort_key)])
    pl = F.struct(*[F.col(f"`{p}`") for p in payload])
    agg = F.max_by(pl, sk) if largest else F.min_by(pl, sk)
    return df.groupBy(*keys).agg(agg.alias("_pick")).select(*keys, "_pick.*")


def pick_row(df: DataFrame, keys: list[str], order: list[Column], payload: list[str]) -> DataFrame:
    """One whole row per key, for wide rows of keys with few rows each (a claim's lines).

    Spark keeps the first row per key before the shuffle (window group
    limit), so no aggregate has to carry and sort the wide payload."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_first", first).filter(F.col("_first") == 1).select(*keys, *[F.col(f"`{p}`") for p in payload])


def latest_per_key(df: DataFrame, key: str = "INDV_ID", order_col: str = "MM_DATE",
                   tiebreak: str = "ROW_KEY", payload: list[str] | None = None) -> DataFrame:
    """Latest row per key by ``order_col`` desc (nulls last), tie-break desc."""
    payload = payload or [x for x in df.columns if x != key]
    return pick_one(df, [key], desc_nulls_last_key(order_col) + [c(tiebreak)], payload)


def preferred_per_key(df: DataFrame, key: str = "INDV_ID", pref_col: str = "STUDY_YR",
                      preferred: str = "Current", tiebreak: list[str] | None = None,
                      payload: list[str] | None = None) -> DataFrame:
    """One row per key preferring ``pref_col == preferred`` then tie-breakers."""
    payload = payload or [x for x in df.columns if x != key]
    tiebreak = tiebreak or []
    sk = [F.when(F.col(pref_col) == preferred, 1).otherwise(0)]
    for t in tiebreak:
        sk += desc_nulls_last_key(t)
    return pick_one(df, [key], sk, payload)


def first_value_by_key(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Earliest value per key spread to every row (asc, nulls first)."""
    w = Window.partitionBy(key).orderBy(F.col(value).asc_nulls_first())
    return df.withColumn(out, F.first(value).over(w))


def sessionize_gap(intervals: DataFrame, keys: list[str], start: str, end: str, gap_days: int,
                   out: str = "HOSP_STAY", copies: str | None = None, mode: str = "previous", spread: bool = False) -> DataFrame:
    """Number sessions: new when there is no previous row or the gap between
    the previous row's end and this start exceeds ``gap_days``.

    Rows are ordered by (start, end) ascending with nulls first.  ``mode``
    'previous' compares with the previous row's end, 'running_max' with the
    latest end so far.  ``intervals`` are distinct per (keys, start, end);
    ``copies`` names the number of equal lines each stands for.  A line equal
    to the one before it opens a session too when that end is null or more
    than the gap before the start: ``REOPENS`` tells so, ``out`` is then the
    first line's session, and the interval's further lines take the next
    ``copies - 1`` numbers.

    ``spread`` is for keys with too many intervals for one task: a segmented
    scan over range partitions (``_sessionize_spread``), same result.
    """
    if spread:
        return _sessionize_spread(intervals, keys, start, end, gap_days, out, copies, mode)
    w = Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first(), F.col(end).asc_nulls_first())
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    if mode == "previous":
        prev_end, own_end = F.lag(end).over(w), F.col(end)
    elif mode == "running_max":
        prev_end, own_end = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.max(end).over(so_far)
    else:
        raise ValueError(mode)
    opens = lambda e: F.coalesce(F.datediff(F.col(start), e) > gap_days, F.lit(False)) | e.isNull()
    rows = intervals.withColumn("NEW_STAY", F.when(opens(prev_end), 1).otherwise(0)).withColumn("REOPENS", opens(own_end))
    if copies is None:
        return rows.withColumn(out, F.sum("NEW_STAY").over(so_far)).drop("REOPENS")
    extra = F.when(F.col("REOPENS"), F.col(copies) - 1).otherwise(F.lit(0))
    return rows.withColumn(out, F.sum(F.col("NEW_STAY") + extra).over(so_far) - extra)


def deal_by_range(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows in small range parts of (keys, order), numbered ``_part`` and stored, dealt evenly over the tasks.

    A part is one task's rows as a whole, so windows by (keys, ``_part``) need no
    further exchange; a key's rows are in consecutive parts."""
    from claimsmith.sources.sinks import materialize
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(4 * n, *[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id()))
    return dealt.repartitionByRange(n, "_part")


def _continued(summary: DataFrame, keys: list[str], carried: dict[str, Column]) -> DataFrame:
    """What (keys, part) gets from the key's earlier parts; only parts that go on with a key, one key a part at most."""
    over = Window.partitionBy(*keys).orderBy("_part")
    rows = summary.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                          *[x.alias(name) for name, x in carried.items()], F.row_number().over(over).alias("_nth"))
    return rows.where("_nth > 1").drop("_nth")


def _carry(rows: DataFrame, edge: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with what their part gets; ``edge`` has one row a part at most, so it is broadcast."""
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(F.broadcast(edge), on, "left").drop("_p", *[f"_k{i}" for i in range(len(keys))])


def _sessionize_spread(intervals, keys, start, end, gap_days, out, copies, mode):
    """``sessionize_gap`` as a scan in parts: each part works on its own rows, then gets the end it
    has to be compared with (the last one, or the largest) and the number of sessions from the parts before it."""
    from claimsmith.sources.sinks import materialize
    if mode not in ("previous", "running_max"):
        raise ValueError(mode)
    order = [F.col(start).asc_nulls_first(), F.col(end).asc_nulls_first()]
    dealt = deal_by_range(intervals, keys, order)
    over = Window.partitionBy(*keys).orderBy("_part")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    w = Window.partitionBy(*keys, "_part").orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    ends = dealt.groupBy(*keys, "_part").agg(F.max(F.struct(start, end))[end].alias("_last"), F.max(end).alias("_most"))
    edge = _continued(ends, keys, {"_prev_last": F.lag("_last").over(over), "_prev_most": F.max("_most").over(before)})
    rows = _carry(dealt, edge, keys)
    if mode == "previous":
        prev_end, own_end = F.when(F.row_number().over(w) == 1, F.col("_prev_last")).otherwise(F.lag(end).over(w)), F.col(end)
    else:
        earlier = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
        prev_end, own_end = F.greatest(earlier, "_prev_most"), F.greatest(F.max(end).over(so_far), "_prev_most")
    opens = lambda e: F.coalesce(F.datediff(F.col(start), e) > gap_days, F.lit(False)) | e.isNull()
    rows = rows.withColumn("NEW_STAY", F.when(opens(prev_end), 1).otherwise(0)).withColumn("REOPENS", opens(own_end))
    extra = F.lit(0) if copies is None else F.when(F.col("REOPENS"), F.col(copies) - 1).otherwise(F.lit(0))
    rows = materialize(rows.withColumn("_own", F.sum(F.col("NEW_STAY") + extra).over(so_far)).drop("_prev_last", "_prev_most"))
    totals = rows.groupBy(*keys, "_part").agg(F.max("_own").alias("_n"))
    edge = _continued(totals, keys, {"_before": F.sum("_n").over(before)})
    done = _carry(rows, edge, keys).withColumn(out, F.col("_own") + F.coalesce("_before", F.lit(0)) - extra)
    return done.drop("_own", "_before", "_part", *(["REOPENS"] if copies is None else []))


def top_k_salted(df: DataFrame, key: str, order: str, tiebreak: str, k: int = 3,
                 salt_buckets: int = 16, descending: bool = True, out: str = "RANK") -> DataFrame:
    """Rows ranked 1..k per key by ``order`` (desc or asc, nulls last), then
    ``tiebreak`` ascending.

    Stage 1 ranks inside (key, salt) buckets and keeps k per bucket; stage 2
    ranks the at most k*salt_buckets survivors per key.  Neither stage ever
    sorts a whole hot key in one task.  Returns the surviving rows with ``out``.
    """
    o = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_last()
    spec = [o, F.col(tiebreak).asc()]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(tiebreak), F.lit(salt_buckets)))
    w1 = Window.partitionBy(key, "_salt").orderBy(*spec)
    stage1 = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(key).orderBy(*spec)
    return (stage1.withColumn(out, F.row_number().over(w2))
            .filter(F.col(out) <= k).drop("_salt", "_r1"))


def rank_all(df: DataFrame, key: str, order: str, tiebreak: str, out: str = "RANK", cut=None) -> DataFrame:
    """Every row ranked 1..n per key by ``order`` desc (nulls last), then ``tiebreak`` ascending.

    Rows are range partitioned by (key, order, tiebreak) and stored, so a hot
    key spreads over many partitions; a row's rank is its place inside its
    (key, partition) plus the rows its key has in earlier partitions.
    ``cut`` stores the partitioned rows (default: the shared checkpoint folder).
    """
    from claimsmith.sources.sinks import materialize
    spec = [F.col(order).desc_nulls_last(), F.col(tiebreak).asc()]
    dealt = (cut or materialize)(df.repartitionByRange(F.col(key), *spec).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_part")  # one row per partition that holds the key
    before = counts.select(key, "_part", (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*spec))
    return (dealt.withColumn("_local", local).join(before, [key, "_part"])
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("long")).drop("_part", "_local", "_before"))


def sessionize_events(df: DataFrame, key: str, ts: str, gap_seconds: int, out: str = "SESSION_ID") -> DataFrame:
    """Session number per key: a new session starts when the previous event
    of the key is more than ``gap_seconds`` earlier.

    Events are grouped into gap-wide time buckets.  Two events in one bucket
    are less than a gap apart, so a session can only start at the first
    event of a bucket; the rule is applied to per-(key, bucket) min/max
    summaries (map-side combined), whose count per key is bounded by time
    span / gap rather than by event volume.  Events take their bucket's
    session number through an equi-join.
    """
    secs = F.unix_micros(F.col(ts).cast("timestamp")) / 1_000_000
    b = df.withColumn("_bk", F.floor(secs / gap_seconds).cast("long")).withColumn("_s", secs)
    summ = b.groupBy(key, "_bk").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    w = Window.partitionBy(key).orderBy("_bk")
    prev_last = F.lag("_last").over(w)
    starts = summ.withColumn("_new", F.when(prev_last.isNull() | (F.col("_first") - prev_last > gap_seconds), 1)
                             .otherwise(0))
    sessions = starts.withColumn(out, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return b.join(sessions.select(key, "_bk", out), [key, "_bk"]).drop("_bk", "_s")
