"""Benchmark decontamination by greedy string tiling.

A document and a test item that share a *seed* (five words in a row) are
compared by running Karp-Rabin greedy string tiling: rolling hashes of the
least match length find every common place, places on one diagonal grow to
maximal matches, and the longest match whose words are still free is marked
again and again until none of the least length is left.  Tiles never overlap
in either text, so passages in another order still add up.  The share of an
item's words under tiles is its coverage; a document is contaminated when
the coverage of an item reaches the threshold.

The seeds of the test items are compared in blocks of at most ``BLOCK_SEEDS``:
each block is one broadcast of bounded size and one pass over the documents.
Items are dealt to blocks by a hash, as many blocks as the benchmark's words
need, so a larger benchmark makes more passes, not larger broadcasts, and no
task holds all items.  Documents are never shuffled as texts.

Null or empty texts, texts without words: never contaminated, coverage 0.
Items without words match nothing; an item of one to four words is its own
seed and is found wherever these words stand in a row.  Repeated rows get
equal results.  Ties between items go to the smallest item id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

LEAST_MATCH = C.SHINGLE_WORDS
BLOCK_SEEDS = 2_000_000
SPANS = "array<struct<item_id: long, doc_start: int, item_start: int, words: int>>"
SCHEMA = ("doc_id long, text_key long, contaminated boolean, item_id long, coverage double, n_items long, spans " + SPANS)
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("contaminated", pa.bool_()), ("item_id", pa.int64()),
                    ("coverage", pa.float64()), ("n_items", pa.int64()), ("spans", pa.list_(pa.struct(
                        [("item_id", pa.int64()), ("doc_start", pa.int32()), ("item_start", pa.int32()), ("words", pa.int32())])))])


def tiles(pairs: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from common places.

    ``pairs``: (document word, item word) where ``least`` words agree.
    Returns (document start, item start, length) of the tiles, longest first;
    ties go to the smaller item place, then the smaller document place.
    """
    order = np.lexsort((pairs[:, 1], pairs[:, 0] - pairs[:, 1]))
    d, t = pairs[order, 0], pairs[order, 1]
    new = np.ones(len(d), bool)
    new[1:] = ((d[1:] - t[1:]) != (d[:-1] - t[:-1])) | (t[1:] != t[:-1] + 1)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(d))) + least - 1
    heap = [(-int(n), int(b), int(a)) for n, b, a in zip(length, t[start], d[start])]
    heapq.heapify(heap)
    used_d: set[int] = set()
    used_t: set[int] = set()
    out = []
    while heap:
        n, b, a = heapq.heappop(heap)
        n = -n
        # What is still free of this match: runs between marked words.
        free = [(b + i) not in used_t and (a + i) not in used_d for i in range(n)]
        if all(free):
            out.append((a, b, n))
            used_t.update(range(b, b + n))
            used_d.update(range(a, a + n))
            continue
        i = 0
        while i < n:
            j = i
            while j < n and free[j]:
                j += 1
            if j - i >= least:
                heapq.heappush(heap, (i - j, b + i, a + i))
            i = j + 1
    return out


class Seeds:
    """One block of test items: for each seed length, sorted seed hashes with their places.

    The seeds of an item have ``LEAST_MATCH`` words, or all words of a shorter item.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        words, off = C.word_hashes(pa.array([t for _, t in items], pa.large_string()))
        self.words = np.diff(off)
        seed, row, place = C.shingle_hashes(words, off)  # a shorter row's shingle has all its words
        length = np.minimum(self.words[row], LEAST_MATCH)
        self.by_length = {int(k): _Table(seed[length == k], row[length == k], place[length == k]) for k in np.unique(length)}

    def hits(self, words: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(seed length, row, place in the row, item, place in the item) of all equal seeds, by seed length."""
        n = np.diff(off)
        for k, table in self.by_length.items():
            shingle, row, place = C.shingle_hashes(words, off, k)
            whole = n[row] >= k
            shingle, row, place = shingle[whole], row[whole], place[whole]
            at, seed = table.equal(shingle)
            yield k, row[at], place[at], table.item[seed], table.place[seed]


class _Table:
    """Sorted hashes of seeds of one length, and the items and places they come from."""

    def __init__(self, seed: np.ndarray, item: np.ndarray, place: np.ndarray):
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.place = seed[order], item[order], place[order]
        # One bit a seed: most documents' shingles miss it, a small table answers them.
        self.bits = max(16, int(len(seed)).bit_length() + 5)
        self.hit = np.zeros(1 << self.bits, bool)
        self.hit[(self.seed >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def equal(self, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``shingle`` and into the seeds of all equal pairs."""
        maybe = np.flatnonzero(self.hit[(shingle >> np.uint64(64 - self.bits)).astype(np.int64)])
        lo, hi = np.searchsorted(self.seed, shingle[maybe], "left"), np.searchsorted(self.seed, shingle[maybe], "right")
        n = hi - lo
        return np.repeat(maybe, n), np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _scan(batches: Iterator[pa.RecordBatch], seeds: Seeds, threshold: float) -> Iterator[pa.RecordBatch]:
    C.start_task("tiling")
    for batch in batches:
        rows = []
        for _, text in C.chunks(batch.column(1)):
            words, off = C.word_hashes(text)
            found: dict[int, list] = {}
            for least, doc, doc_place, item, item_place in seeds.hits(words, off):
                key = doc * len(seeds.ids) + item
                order = np.argsort(key, kind="stable")
                cut = np.flatnonzero(np.diff(key[order], prepend=-1))
                for group in np.split(order, cut[1:]) if len(order) else ():
                    d, t = int(doc[group[0]]), int(item[group[0]])
                    tiled = tiles(np.stack([doc_place[group], item_place[group]], axis=1), least)
                    found.setdefault(d, []).append((sum(n for _, _, n in tiled) / int(seeds.words[t]), t, tiled))
            for d in range(len(text)):
                best = (None, 0.0)
                over, spans = 0, []
                for cover, t, tiled in found.get(d, []):
                    item = int(seeds.ids[t])
                    if cover > best[1] or (cover == best[1] and item < best[0]):
                        best = (item, cover)
                    if cover >= threshold:
                        over += 1
                        spans += [{"item_id": item, "doc_start": a, "item_start": b, "words": n} for a, b, n in tiled]
                rows.append((over > 0, best[0], best[1], over, spans))
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)]
                                         + [pa.array(c, f.type) for c, f in zip(cols, list(_ARROW)[2:])], schema=_ARROW)


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_SEEDS) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``limit`` words, one block in the driver at a time."""
    words = F.size(F.split(F.col(f"`{text_col}`"), r"\s+"))
    items = C.store(benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").alias("text"),
                                     words.alias("n")).where("item_id is not null and text is not null").distinct())
    n_blocks = -(-(items.agg(F.sum("n")).first()[0] or 0) // limit)
    for block in range(n_blocks):
        held = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        if held:
            yield [(r.item_id, r.text) for r in held]


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = C.SIMILARITY, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                  block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """One row per input row: contaminated, best item, its coverage, number of items over the threshold, tiles."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    parts = []
    for items in blocks_of(benchmark, item_id_col, item_text_col, block_seeds):
        seeds = spark.sparkContext.broadcast(Seeds(items))
        parts.append(base.mapInArrow(lambda it, s=seeds: _scan(it, s.value, threshold), SCHEMA))
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return base.selectExpr("doc_id", "text_key", "false AS contaminated", "CAST(NULL AS long) AS item_id", "0D AS coverage",
                               "0L AS n_items", f"CAST(array() AS {SPANS}) AS spans")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    found = C.store(whole.where("coverage > 0")).dropDuplicates(["doc_id", "text_key", "item_id", "spans"])
    best = F.max(F.struct("coverage", (-F.col("item_id")).alias("minus")))
    per = (found.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.max("contaminated").alias("contaminated"), best.alias("b"), F.sum("n_items").alias("n_items"),
        F.flatten(F.collect_list("spans")).alias("spans")))
    return (base.drop("text").join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", "text_key", F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
                    (-F.col("b.minus")).alias("item_id"), F.coalesce("b.coverage", F.lit(0.0)).alias("coverage"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("spans", F.expr(f"CAST(array() AS {SPANS})")).alias("spans")))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = C.SIMILARITY, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, whatever their ids.

    Only the text hashes of the contaminated rows are stored and joined back:
    Spark knows their size and broadcasts them if it is small.
    """
    judged = contamination(docs, benchmark, threshold, id_col, text_col)
    bad = C.store(judged.where("contaminated").select(F.col("text_key").alias("_bad")).distinct())
    return docs.join(bad, F.xxhash64(F.col(f"`{text_col}`")) == F.col("_bad"), "left_anti")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: contaminated or not, by which item and how far."""
    rows = contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    told = F.transform("spans", lambda s: F.concat_ws(":", s["item_id"], s["doc_start"], s["item_start"], s["words"]))
    return rows.drop("text_key").withColumn("spans", F.array_join(told, ","))
