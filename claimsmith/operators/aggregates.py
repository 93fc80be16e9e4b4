"""Aggregates that need care at scale.

``exact_median`` computes an exact median per group without ever holding a
group's values in one task.  Spark's ``median``/``percentile`` buffer a
value->count map per group, so a hot group with many distinct amounts
(e.g. money in cents) lands whole in one reducer.  Here each round counts
values per (group, bucket) - a map-side-combined aggregate with at most
``buckets`` rows per group - finds the bucket holding the wanted rank with
a window over those bucket counts, and narrows the value range to it.  After
``ceil(bits / log2(buckets))`` rounds the range is a single value.  Only the
number of rounds (from a one-row min/max) is decided on the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimsmith.sources.sinks import materialize


def _rounds(span: int, buckets: int) -> int:
    """Rounds until the range is one value: the span shrinks by ``buckets``
    per round and the last round needs span < buckets."""
    if span <= 0:
        return 1
    return max(1, math.ceil(math.log(span + 1) / math.log(buckets)))


def exact_median(df: DataFrame, keys: list[str], value: str, out: str = "MEDIAN",
                 buckets: int = 65536) -> DataFrame:
    """Exact median of an integer-valued column per group (nulls ignored;
    null group keys form their own group).

    Returns one row per group with at least one value: ``keys + [out]``
    (double; the mean of the two middle values for even counts).
    """
    global_median = not keys
    if global_median:  # one group: a constant key, joined by broadcast (two state rows)
        df, keys = df.withColumn("_g", F.lit(0)), ["_g"]
    sk = {k: f"_sk{i}" for i, k in enumerate(keys)}
    # The narrow (keys, value) input is stored once; every round scans it.
    v = materialize(df.select(*keys, F.col(value).cast("long").alias("_v")).filter(F.col("_v").isNotNull()))
    stats = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    span_row = stats.agg(F.max(F.col("_hi") - F.col("_lo")).alias("span")).first()
    if span_row is None or span_row["span"] is None:
        res = stats.select(*keys, F.lit(None).cast("double").alias(out)).limit(0)
        return res.drop("_g") if global_median else res
    rounds = _rounds(int(span_row["span"]), buckets)
    # Two targets per group: ranks floor((n+1)/2) and floor(n/2)+1 (1-based).
    which = F.explode(F.array(
        F.struct(F.lit(1).alias("_t"), ((F.col("_n") + 1) / 2).cast("long").alias("_r")),
        F.struct(F.lit(2).alias("_t"), ((F.col("_n") / 2).cast("long") + 1).alias("_r"))))
    state = stats.select(*keys, "_lo", "_hi", which.alias("_w")).select(*keys, "_lo", "_hi", "_w._t", "_w._r")
    tk = keys + ["_t"]
    for _ in range(rounds):
        st = state.select(*[F.col(k).alias(sk[k]) for k in keys], "_t", "_lo", "_hi", "_r",
                          (((F.col("_hi") - F.col("_lo")) / buckets).cast("long") + 1).alias("_wd"))
        st = F.broadcast(st) if global_median else st
        cond = reduce(lambda a, b: a & b, [v[k].eqNullSafe(st[sk[k]]) for k in keys])
        counts = (v.join(st, cond)
                  .filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
                  .withColumn("_b", ((F.col("_v") - F.col("_lo")) / F.col("_wd")).cast("long"))
                  .groupBy(*tk, "_lo", "_hi", "_wd", "_r", "_b").agg(F.count(F.lit(1)).alias("_c")))
        w = Window.partitionBy(*tk).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        hit = (counts.withColumn("_cum", F.sum("_c").over(w))
               .filter((F.col("_cum") - F.col("_c") < F.col("_r")) & (F.col("_r") <= F.col("_cum"))))
        state = hit.select(
            *tk,
            (F.col("_lo") + F.col("_b") * F.col("_wd")).alias("_lo"),
            F.least(F.col("_hi"), F.col("_lo") + (F.col("_b") + 1) * F.col("_wd") - 1).alias("_hi"),
            (F.col("_r") - (F.col("_cum") - F.col("_c"))).alias("_r"))
        # The state is one row per (group, target); storing it keeps each
        # round from recomputing the previous ones.
        state = materialize(state)
    res = state.groupBy(*keys).agg((F.sum("_lo").cast("double") / 2.0).alias(out))
    return res.drop("_g") if global_median else res
