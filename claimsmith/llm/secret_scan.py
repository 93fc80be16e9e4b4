"""Secret scan with multipart credential linking, DataFrame functions only.

1. Every pattern's leftmost non-overlapping matches become *parts* with code
   point spans.  A match's place is the length of everything before it, so
   each text is split at the pattern and the lengths of gaps and matches are
   summed in order (a window over one text's few matches).
2. Strong parts (``assign``, ``access``, ``hex``) are reported as they are.
3. Weak candidates (identifiers, short secrets, endpoints) are too common to
   report alone.  Each opens a scope, the interval of ``scope`` code points
   around itself.  The interval join of parts with scopes is a sweep over a
   text's parts in order of place: the furthest end before and the nearest
   start after a candidate tell whether a part of a role meets its scope, so
   thousands of parts in one text never make pairs.  A weak identifier or
   secret is reported when a part of the other role is in its scope, an
   endpoint when an identifier and a secret both are.

Null text counts as empty: no span.  Equal rows get equal results; a null id
is an id like any other.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.llm import common as C

# The contract's patterns.  (kind, role, pattern, group, least length of the group, weak)
_VALUE = r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
STRONG = [
    ("assign", "secret", r"(?i)(password|passwd|secret|token|api_?key)" + _VALUE, 2, 8),
    # A run too short to count hides no longer one, so the least length stands in the pattern.
    ("access", "identifier", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", "secret", r"[0-9a-f]{32,}", 0, 32),
]
WEAK = [
    ("weak_id", "identifier", r"(?i)\b(user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)" + _VALUE, 2, 3),
    ("weak_secret", "secret", r"(?i)\b(pwd|pass(?:word|wd|phrase)?|secret|token|api_?key|credential|auth)" + _VALUE, 2, 4),
    ("endpoint", "endpoint",
     r"""(?i)\b(?:https?|ftps?|sftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]+""", 0, 10),
]
SCOPE = 200
BLOCK = 1024  # code points of a text that are rebuilt together
KINDS = [k for k, *_ in STRONG + WEAK]


def _matches(text: Column, pattern: str, group: int, least: int, scan: str) -> Column:
    """Array of (gap before, length, long enough) for one pattern, null where nothing matches.

    ``scan`` is a pattern equal in matches that long enough ones need.
    """
    p = F.lit(pattern)
    # Splitting is the dear part; texts without a long enough match skip it.
    found = F.regexp_extract_all(text, p, F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = (lambda m: m) if group == 0 else (lambda m: F.regexp_extract(m, pattern, group))
    rows = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                      lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"),
                                            (F.length(value(m)) >= least).alias("ok")))
    return F.when(text.rlike(scan), rows)


def _scan(pattern: str, least: int) -> str:
    """The pattern with its closing ``+`` as a least length: finds a text's candidates in one pass."""
    if pattern.endswith("]+)"):
        return pattern[:-2] + "{%d,})" % least
    return pattern


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, kind, role, start, end, weak): every long enough match of every pattern."""
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("t"))
    base = base.where(F.col("t").isNotNull())

    def named(kind: str):
        return lambda m: F.struct(F.lit(kind).alias("kind"), m["gap"].alias("gap"), m["len"].alias("len"), m["ok"].alias("ok"))

    lists = [F.transform(_matches(F.col("t"), p, g, n, _scan(p, n)), named(k)) for k, _, p, g, n in STRONG + WEAK]
    some = base.select("id", "text_key", F.filter(F.array(*lists), lambda x: x.isNotNull()).alias("found"))
    flat = (some.where(F.size("found") > 0).select("id", "text_key", F.explode("found").alias("found"))
            .select("id", "text_key", F.posexplode("found").alias("i", "m"))
            .select("id", "text_key", "m.kind", "i", "m.gap", "m.len", "m.ok")
            .dropDuplicates(["id", "text_key", "kind", "i"]))
    order = W.partitionBy("id", "text_key", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.col("len")).over(order)
    role = F.create_map(*[F.lit(x) for k, r, *_ in STRONG + WEAK for x in (k, r)])
    return (flat.withColumn("end", end).where("ok")
            .select("id", "text_key", "kind", role[F.col("kind")].alias("role"),
                    (F.col("end") - F.col("len")).alias("start"), "end",
                    F.col("kind").isin([k for k, *_ in WEAK]).alias("weak")))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Strong parts, and weak ones whose complementary parts lie within ``scope`` code points.

    A weak part that overlaps a strong one adds nothing and goes.
    """
    key = ["id", "text_key"]
    role = F.col("role")
    before = W.partitionBy(*key).orderBy("start", "end", "kind").rowsBetween(W.unboundedPreceding, -1)
    # In falling order, because a frame that ends with the partition would be read anew for every row.
    after = W.partitionBy(*key).orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    reach = found
    for r in ("identifier", "secret"):
        own = F.when(role == r, F.col("end"))
        nearest = F.when(role == r, F.col("start"))
        reach = reach.withColumn(f"near_{r}", F.coalesce(
            (F.max(own).over(before) >= F.col("start") - scope), F.lit(False)) | F.coalesce(
            (F.min(nearest).over(after) <= F.col("end") + scope), F.lit(False)))
    strong_end = F.max(F.when(~F.col("weak"), F.col("end"))).over(before)
    strong_start = F.min(F.when(~F.col("weak"), F.col("start"))).over(after)
    reach = reach.withColumn("covered", F.coalesce(strong_end > F.col("start"), F.lit(False))
                             | F.coalesce(strong_start < F.col("end"), F.lit(False)))
    complete = (F.when(role == "identifier", F.col("near_secret")).when(role == "secret", F.col("near_identifier"))
                .otherwise(F.col("near_identifier") & F.col("near_secret")))
    return reach.where(~F.col("weak") | (complete & ~F.col("covered"))).select(*found.columns)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id, text_key, spans): one row per distinct (id, text) that holds a span.

    ``spans`` is an array of (start, rank of the kind, kind, end), in order.
    """
    found = linked(parts(docs, id_col, text_col), scope)
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    item = F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end")
    return found.groupBy("id", "text_key").agg(F.sort_array(F.collect_list(item)).alias("spans"))


def attach(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their ``_spans`` (empty array where there is none).

    The few texts with spans are stored first: Spark then knows their size
    and broadcasts them if it is small, else both sides are shuffled."""
    own = C.store(spans.select(F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans")))
    rows = docs.withColumn("_text_key", F.xxhash64(F.col(f"`{text_col}`")))
    on = F.col(f"`{id_col}`").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    return (rows.join(own, on, "left").drop("_id", "_key", "_text_key")
            .withColumn("_spans", F.coalesce("_spans", F.array().cast(spans.schema["spans"].dataType))))


def cuts(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, text_key, spans): what goes from every block of ``block`` code points of a text.

    One sweep in order of place merges overlapping spans into runs; a run is
    cut where blocks end.  ``spans`` is an array of (block, cuts), one for
    each block up to the last with cuts; a cut is (place in the block, end
    there, whether the run opens here, where the cut before it ends), so a
    block is rebuilt without looking at others.
    """
    key = ["id", "text_key"]
    order = W.partitionBy(*key).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    runs = (found.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
            .groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    least = lambda c: F.floor(c / block).cast("int")
    held = runs.withColumn("block", F.explode(F.sequence(least(F.col("start")), least(F.col("end") - 1))))
    at = F.greatest(F.col("start") - F.col("block") * block, F.lit(0)).cast("int")
    to = F.least(F.col("end") - F.col("block") * block, F.lit(block)).cast("int")
    held = held.select(*key, "block", at.alias("at"), to.alias("to"), (F.col("start") >= F.col("block") * block).alias("opens"))
    held = held.withColumn("gap", F.coalesce(F.lag("to").over(W.partitionBy(*key, "block").orderBy("at")), F.lit(0)))
    per = held.groupBy(*key, "block").agg(F.sort_array(F.collect_list(F.struct("at", "to", "opens", "gap"))).alias("cuts"))
    last = F.coalesce(F.lag("block").over(W.partitionBy(*key).orderBy("block")), F.lit(-1))
    dense = (per.withColumn("last", last).withColumn("at", F.explode(F.sequence(F.col("last") + 1, F.col("block"))))
             .select(*key, F.struct(F.col("at").alias("block"), F.when(F.col("at") == F.col("block"), F.col("cuts")).alias("cuts")).alias("item")))
    return dense.groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE,
           mark: str = "[SECRET]", block: int = BLOCK) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mark``.

    A text is rebuilt block by block, so the work grows with its length and
    not with length times number of spans.
    """
    text = F.col(f"`{text_col}`")
    rows = attach(docs, cuts(linked(parts(docs, id_col, text_col), scope), block), id_col, text_col)

    def rebuilt(piece: Column, own: Column) -> Column:
        before = F.transform(own, lambda c: F.concat(F.substr(piece, c["gap"] + 1, c["at"] - c["gap"]), F.when(c["opens"], mark).otherwise("")))
        rest = F.substr(piece, F.element_at(own, -1)["to"] + 1, F.lit(block))
        return F.when(own.isNull(), piece).otherwise(F.concat(F.array_join(before, ""), rest))

    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block), F.lit(0))
    clean = F.array_join(F.zip_with(pieces, F.col("_spans"), lambda p, s: rebuilt(p, s["cuts"])), "")
    return rows.withColumn(text_col, F.when(F.size("_spans") == 0, text).otherwise(clean)).select(*docs.columns)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the secrets in every document."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = attach(docs, scan(docs))
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("_spans", lambda s: s["rank"] < len(STRONG))
    count = lambda i: F.size(F.filter("_spans", lambda s: s["rank"] == i)).cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, (k, *_) in enumerate(STRONG)],
        F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("_spans", told), ",").alias("spans"))
