"""URL filter: rules first, then a path-template tree judged by labelled purity.

The tree is built level by level for all hosts at once.  Below each node
(host, template so far) a path segment stays literal when ``MIN_COUNT`` pages
have it there, whatever their share of the node.  A node whose frequent values
are more than ``VARIED`` in effect (squared sum of their counts over the sum of
squares) holds a variable: there a value stays literal only if its share of good
labels differs significantly from the node's.  Any other segment is written as
its shape (digit runs become ``*``) when that is frequent and the node's shapes
don't vary likewise, else as the wildcard ``**``.  A node is closed at once when
it has fewer than ``MIN_COUNT`` pages (a ``**`` a segment) or when all its pages
go on with the same segments, so only nodes that branch are carried on.

Siblings are merged bottom up: at each level, from the deepest, templates
that differ only in their literal segment there are pooled as ``{}``, except
those whose share of good labels differs significantly from the pool's; the
level above compares the merged templates.  A template is rejected when its
purity, smoothed towards its host's and the host's towards the whole table's, is
below ``min_purity``; an unlabelled template thus falls back on its host.

Every statistic is a map-side combined count over all pages, so a host with
a third of the pages is one small aggregate row a branch.

Null urls, urls without ``://``: empty host and path, judged as one template
of the empty host.  Repeated pages count each time.  Pages without labels,
or an empty label table: purity is the prior 0.5, which is not rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

# The contract's rules.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
MIN_COUNT, VARIED = 5, 32
SMOOTHING, MIN_PURITY, Z = 4.0, 0.5, 1.96
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _differs(n: str, g: str, of_n: str, of_g: str, z: float) -> Column:
    """Whether g good of n labels is significantly another share than ``of_g`` of ``of_n``; false without labels."""
    rate = F.col(of_g) / F.greatest(of_n, F.lit(1))
    return (F.col(n) > 0) & (F.abs(F.col(g) / F.greatest(n, F.lit(1)) - rate) > z * F.sqrt(rate * (1 - rate) / F.greatest(n, F.lit(1))))


def _varies(of: Column, count: str, varied: int) -> Column:
    """Aggregate: more than ``varied`` values in effect among those that ``of`` holds for, in whole numbers."""
    c = F.when(of, F.col(count)).otherwise(0).cast("decimal(18,0)")
    return F.sum(c) * F.sum(c) > F.sum(c * c) * varied


def template_tree(pages: DataFrame, min_count: int = MIN_COUNT, varied: int = VARIED, z: float = Z) -> tuple[DataFrame, int]:
    """Pages (row, host, path, good, ...) with their ``template``, and the number of levels at which nodes branch."""
    start = pages.withColumn("seg", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    ended, tree, level = [start.where(F.size("seg") == 0)], start.where(F.size("seg") > 0), 0
    digits = lambda s: s.rlike(r"\A[0-9]+\z")
    while not tree.isEmpty():
        rest = F.slice("seg", level + 1, F.size("seg"))
        here = (tree.withColumn("own", F.get("seg", F.lit(level))).withColumn("shape", F.regexp_replace("own", "[0-9]+", "*"))
                .withColumn("h", F.xxhash64(rest)).withColumn("k", F.xxhash64(F.lit(level), rest)))
        counts = (here.groupBy("host", "template", "shape", "own")
                  .agg(F.count("*").alias("c"), F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"),
                       *[f(x).alias(f.__name__ + x) for f in (F.min, F.max) for x in "hk"]))
        often, frequent = F.col("c") >= min_count, F.col("shaped") >= min_count
        shapes = counts.groupBy("host", "template", "shape").agg(F.sum("c").alias("shaped"))
        starred = F.col("shape").contains("*")
        shape_nodes = shapes.groupBy("host", "template").agg(_varies(frequent & starred, "shaped", varied).alias("shapes_vary"))
        nodes = (counts.groupBy("host", "template")
                 .agg(F.sum("c").alias("total"), F.sum("n").alias("nn"), F.sum("g").alias("ng"),
                      _varies(often & ~digits(F.col("own")), "c", varied).alias("vary"),
                      ((F.min("minh") == F.max("maxh")) & (F.min("mink") == F.max("maxk"))).alias("alone"))
                 .join(shape_nodes, ["host", "template"]))
        said = (counts.join(C.dealt_anew(nodes, "host"), ["host", "template"])
                .join(C.dealt_anew(shapes, "host"), ["host", "template", "shape"])
                .select("host", "template", "own",
                        F.when(often & ~digits(F.col("own")) & (~F.col("vary") | _differs("n", "g", "nn", "ng", z)), F.col("own"))
                        .when(frequent & starred & ~F.col("shapes_vary"), F.col("shape")).otherwise("**").alias("said"),
                        (F.col("total") < min_count).alias("thin"), "alone"))
        tail = (F.when(F.col("thin"), F.transform(rest, lambda s: F.lit("**")))
                .when(F.col("alone"), F.transform(rest, lambda s: F.when(digits(s), "*").otherwise(s)))
                .otherwise(F.array("said")))
        step = C.store(here.drop("shape", "h", "k").join(C.dealt_anew(said, "host"), ["host", "template", "own"])
                       .withColumn("template", F.concat_ws("/", "template", tail))
                       .withColumn("open", ~F.col("thin") & ~F.col("alone") & (F.size("seg") > level + 1))
                       .drop("own", "said", "thin", "alone"))
        ended.append(step.where(~F.col("open")).drop("open"))
        tree, level = step.where("open").drop("open"), level + 1
    whole = ended[0]
    for done in ended[1:]:
        whole = whole.unionByName(done)
    return whole.drop("seg"), level


def merged_siblings(stats: DataFrame, levels: int, z: float = Z) -> DataFrame:
    """(host, template, n, g) -> the same with ``merged``: siblings with like labels pooled, from the deepest level up."""
    now = stats.withColumn("merged", F.col("template"))
    for level in reversed(range(levels)):
        parts = F.split("merged", "/")
        seg = F.get(parts, F.lit(level + 1))
        family = F.concat_ws("/", F.slice(parts, 1, level + 1), F.array(F.lit("{}")), F.slice(parts, level + 3, F.size(parts)))
        nodes = (now.groupBy("host", "merged").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
                 .where(seg.isNotNull() & ~seg.contains("*") & (seg != "{}")).withColumn("family", family))
        pool = (nodes.groupBy("host", "family")
                .agg(F.sum("n").alias("fn"), F.sum("g").alias("fg"), (F.min("merged") != F.max("merged")).alias("several"))
                .where("several").drop("several"))
        joined = (nodes.join(C.dealt_anew(pool, "host"), ["host", "family"]).where(~_differs("n", "g", "fn", "fg", z))
                  .select("host", "merged", "family"))
        now = C.store(now.join(C.dealt_anew(joined, "host"), ["host", "merged"], "left")
                      .withColumn("merged", F.coalesce("family", "merged")).drop("family"))
    return now


def judged_templates(tree: DataFrame, levels: int, smoothing: float = SMOOTHING, min_purity: float = MIN_PURITY, z: float = Z) -> DataFrame:
    """(host, template, merged, labelled, purity, rejected) from the pages' ``good`` labels (0, 1 or null)."""
    stats = C.store(tree.groupBy("host", "template").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")))
    branch = merged_siblings(stats, levels, z)
    merged = branch.groupBy("host", "merged").agg(F.sum("n").alias("labelled"), F.sum("g").alias("mg"))
    hosts = stats.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("g").alias("hg"))
    every = stats.agg(F.sum("n").alias("an"), F.sum("g").alias("ag"))  # one row
    prior = (F.col("ag") + 0.5 * smoothing) / (F.col("an") + smoothing)
    host_prior = (F.col("hg") + smoothing * prior) / (F.col("hn") + smoothing)
    purity = (F.col("mg") + smoothing * host_prior) / (F.col("labelled") + smoothing)
    return (branch.select("host", "template", "merged").join(C.dealt_anew(merged, "host"), ["host", "merged"])
            .join(C.dealt_anew(hosts, "host"), "host").join(F.broadcast(every), F.lit(True))
            .select("host", "template", "merged", "labelled", purity.alias("purity"), (purity < min_purity).alias("rejected")))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every page.

    ``labels``: (page_id, good), good being 1 or 0; several labels of one page
    count as good only if all are.
    """
    url = F.col(f"`{url_col}`")
    base = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    mark = labels.select(F.col("page_id").alias("_id"), "good").groupBy("_id").agg(F.min("good").alias("good"))
    base = C.store(base.join(mark, F.col("page_id") == F.col("_id"), "left").drop("_id"))
    tree, levels = template_tree(base)
    judged = judged_templates(tree, levels)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (tree.join(C.dealt_anew(judged, "host"), ["host", "template"])
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    "template", "purity"))


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, good): a page shows the document its path's number names."""
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) AS bigint)")
    named = pages.select("page_id", path_of(F.col("url")).alias("path")).select("page_id", number.alias("_doc"))
    marks = labels.select(F.col("doc_id").alias("_doc"),
                          ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int").alias("good"))
    return named.where("_doc is not null").join(marks.where("good is not null"), "_doc").select("page_id", "good")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = C.table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, page_labels(pages, C.table(spark, sf_dir, "labels")))
