"""Sharding along a Hilbert curve over metadata, DataFrame functions only.

Each metadata dimension is quantised into ``2 ** bits`` equally filled cells
by quantiles of all rows (strings by the ranks of their distinct values), so
cells are ranges of the column.  Rows are sorted by their cell's index on the Hilbert curve
and the order is cut into runs of near equal bytes: each run covers a compact
part of every dimension, so filters on any of them skip files.

Equal texts are one group with the metadata of its first row, hence
neighbours in the order, and a group that is small against a shard
(``1 / GROUP_SHARE`` of it) is never cut.  Larger groups are cut where the
bytes say so, whatever share of the rows they hold.

The running sums need no single task: rows are range partitioned by the
order and stored with their partition number; sums of whole partitions are
added to sums within each partition.

Null text: no bytes, size 1, checksum 0.  Null metadata sorts first.  Null
ids and repeated rows are rows like any other.  Extra columns are ignored by
``assign``; ``write_shards`` keeps them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.llm import common as C

SHARDS, BITS, GROUP_SHARE = 8, 4, 100


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def hilbert_index(coords: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a cell given by integer coordinates below ``2 ** bits``."""
    n = len(coords)
    tops = [1 << b for b in range(bits - 1, 0, -1)]
    start = F.array(*[c.cast("long") for c in coords])
    steps = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in tops for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        low, own, first = s["q"] - 1, F.get(x, s["i"]), F.get(x, F.lit(0))
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, j: F.when(flip, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                           .otherwise(F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    turned = F.aggregate(steps, start, turn) if tops else start

    def gray(x: Column) -> Column:
        out = [F.get(x, F.lit(0))]
        for i in range(1, n):
            out.append(out[-1].bitwiseXOR(F.get(x, F.lit(i))))
        return F.array(*out)

    def undo(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        t = reduce(lambda a, b: a.bitwiseXOR(b),
                   [F.when(last.bitwiseAND(F.lit(q)) != 0, F.lit(q - 1).cast("long")).otherwise(F.lit(0).cast("long")) for q in tops],
                   F.lit(0).cast("long"))
        return _let(t, lambda t: F.transform(x, lambda v: v.bitwiseXOR(t)))

    def weave(x: Column) -> Column:
        bit = [F.shiftleft(F.shiftright(F.get(x, F.lit(i)), b).bitwiseAND(F.lit(1)), b * n + n - 1 - i)
               for b in range(bits) for i in range(n)]
        return reduce(lambda a, b: a + b, bit)

    return _let(turned, lambda x: _let(gray(x), lambda y: _let(undo(y), weave)))


def string_cuts(rows: DataFrame, column: str, share: list[float]) -> list[Column]:
    """For each share, whether the column lies above the smallest value that share of all rows doesn't pass.

    Whole values are ranked by cumulated counts: distinct values are range
    partitioned, counts of whole partitions are added to counts within each.
    Nulls come first.  Only ``len(share)`` values reach the driver.
    """
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    part = C.store(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    earlier = W.orderBy("part")  # one row a partition
    sums = part.groupBy("part").agg(F.sum("rows").alias("own")).select("part", (F.sum("own").over(earlier) - F.col("own")).alias("passed"), F.sum("own").over(W.partitionBy()).alias("total"))
    inner = W.partitionBy("part").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = part.join(sums, "part").withColumn("upto", F.col("passed") + F.sum("rows").over(inner))
    found = ranked.agg(*[F.min(F.when(F.col("upto") >= F.lit(q) * F.col("total"), F.struct("value"))).alias(f"q{i}") for i, q in enumerate(share)]).first()
    cuts = [v["value"] for v in found if v is not None]
    return [F.col(column).isNotNull() if v is None else F.coalesce(F.col(column) > F.lit(v), F.lit(False)) for v in cuts]


def number_cuts(rows: DataFrame, column: str, share: list[float]) -> list[Column]:
    """As ``string_cuts`` for a number, by approximate quantiles."""
    value = F.coalesce(F.col(column).cast("double"), F.lit(-1.0))
    found = rows.agg(F.percentile_approx(value, share, 10_000).alias("cut")).first()["cut"]
    return [value > F.lit(v) for v in found or []]


def assign(docs: DataFrame, dims: tuple[str, ...] = ("lang", "source"), shards: int = SHARDS, bits: int = BITS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, text_key, hilbert, shard, slot) of every row; text size is a dimension too."""
    text = F.col(f"`{text_col}`")
    kinds = dict(docs.dtypes)
    rows = C.store(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("text_key"),
        *[F.col(f"`{d}`").alias(f"d{i}") for i, d in enumerate(dims)]))
    codes = [*[f"d{i}" for i in range(len(dims))], "size"]
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    total = rows.agg(F.sum("size").alias("total")).first()["total"]
    above = [(string_cuts if kinds.get(d) == "string" else number_cuts)(rows, c, share) for c, d in zip(codes, [*dims, None])]
    cell = [sum((a.cast("int") for a in over), F.lit(0)) for over in above]
    rows = rows.withColumns(dict(zip(codes[:-1], cell)))
    cells = [*[F.col(c) for c in codes[:-1]], cell[-1]]
    same = ["text_key", "text_crc32", "size"]
    groups = (rows.groupBy(*same).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *codes[:-1])).alias("first"), F.count("*").alias("copies"))
              .select(*same, "copies", *[F.col(f"first.{c}").alias(c) for c in codes[:-1]]))
    placed = (rows.drop(*codes[:-1]).join(C.dealt_anew(groups, "text_key"), same)
              .withColumn("hilbert", hilbert_index(cells, bits)).drop(*codes[:-1]))
    order = ["hilbert", *same, "doc_id"]
    placed = C.store(placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    sums = placed.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("r"))
    earlier = W.orderBy("part")  # one row a partition
    sums = sums.select("part", (F.sum("b").over(earlier) - F.col("b")).alias("b0"), (F.sum("r").over(earlier) - F.col("r")).alias("r0"))
    inner = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = C.store(placed.join(sums, "part")
                  .withColumn("before", F.col("b0") + F.sum("size").over(inner) - F.col("size"))
                  .withColumn("row", F.col("r0") + F.count("*").over(inner) - 1).drop("b0", "r0", "part"))
    total = F.lit(total or 1).cast("double")
    spread = F.col("copies") * F.col("size")
    small = (F.col("copies") > 1) & (spread * shards * GROUP_SHARE <= total)
    begin = run.where(small).groupBy(*same).agg(F.min("before").alias("begin"))
    middle = F.when(F.col("begin").isNotNull(), F.col("begin") + spread / 2).otherwise(F.col("before") + F.col("size") / 2)
    cutted = run.join(C.dealt_anew(begin, "text_key"), same, "left").withColumn(
        "shard", F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int"))
    cutted = C.store(cutted.select("doc_id", *same, "hilbert", "row", "shard"))
    base = cutted.groupBy("shard").agg(F.min("row").alias("base"))  # ``shards`` rows
    return (cutted.join(F.broadcast(base), "shard")
            .select("doc_id", "size", "text_crc32", "text_key", "hilbert", "shard", (F.col("row") - F.col("base")).alias("slot")))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> None:
    """Write ``docs`` as one folder a shard, rows in curve order; a shard's files come from many tasks."""
    plan = assign(docs, id_col=id_col, text_col=text_col, **options)
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("shard").alias("_shard"), "slot").dropDuplicates(["_id", "_key"])
    rows = docs.join(plan, F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("_key")))
    (rows.drop("_id", "_key").withColumnRenamed("slot", "_slot").repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign(C.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "hilbert")
