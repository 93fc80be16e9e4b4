"""Best-fit packing by length patterns fitted with non-negative least squares.

1. Texts become token ids plus an end id; a document longer than a sequence
   is cut into full pieces, its first piece taking the remainder.
2. All pieces are counted by length (at most ``size`` numbers reach the
   driver).  Full pieces are sequences by themselves.
3. Patterns of two or three lengths that fill a sequence exactly are listed
   for the lengths present, and their repeat counts are fitted to the
   histogram by non-negative least squares (accelerated projected gradient).
4. Counts are rounded as far as pieces are left, largest first.  The
   residual histogram is packed by best-fit decreasing on lengths: the
   longest length left, then always the longest that still fits.
5. A piece's place follows from its length and its running number among the
   pieces of that length: each pattern takes a range of these numbers.

Running numbers are made of a count within the task and the sum of the
earlier tasks' counts, so no length, however frequent, meets in one task.
Work in the driver depends on ``size`` alone.

Null text counts as empty: one piece, the end id.  Repeated rows and ids are
separate documents.  An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.llm import common as C
from claimsmith.llm.tokenize import CHUNK, encoder

SIZE = 1024
END_ID = 2
ROUNDS = 400
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, number long"


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes the remainder."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int, size: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    enc, part, seen = encoder(path), TaskContext.get().partitionId(), Counter()
    for held in C.one_at_a_time(batches):
        keys = held[0].column(0).to_pylist()
        for lo, texts in C.chunks(held[0].column(1), CHUNK):
            rows = []
            for key, own in zip(keys[lo:lo + len(texts)], enc.encode_many(texts.to_pylist())):
                ids = np.append(own, np.array([end_id], enc.dtype)).astype("<u4")
                for i, (a, n) in enumerate(cuts(len(ids), size)):
                    raw = ids[a:a + n].tobytes()
                    rows.append((key, i, a, n, zlib.crc32(raw), part, seen[n], raw))
                    seen[n] += 1
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64(), pa.int32()] + [pa.int64()] * 5 + [pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number", "ids"]
            n = 7 + keep_ids
            del texts
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)][:n], names=names[:n])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           end_id: int = END_ID, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """Every document's pieces, with their numbers within task and length; stored."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    return C.store(rows.mapInArrow(lambda it: _pieces(it, path, end_id, size, keep_ids), PIECES + (", ids binary" if keep_ids else "")))


def exact_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """(n, 3) sorted lengths present that add up to ``size``; 0 where a pattern has two."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    a, b = np.meshgrid(lengths, lengths, indexing="ij")
    c = size - a - b
    ok = (a <= b) & (c >= 0) & ((c == 0) | ((c >= b) & there[np.maximum(c, 0)]))
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def nonnegative_fit(patterns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that minimises the squared distance of the patterns' lengths from the histogram."""
    use = (patterns > 0).astype(float)
    n = len(histogram)
    apply = lambda x: np.bincount(patterns.ravel(), (use * x[:, None]).ravel(), n)
    back = lambda r: (use * r[patterns]).sum(axis=1)
    v = np.ones(len(patterns))
    for _ in range(20):
        v = back(apply(v))
        v /= np.linalg.norm(v)
    step = 1.0 / max(1e-12, float(v @ back(apply(v)))) / 1.05
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(apply(y) - histogram))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: Counter, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for what is left: longest first, then always the longest that fits; ``left`` is used up."""
    open_ = sorted(n for n in left if left[n] > 0)
    out = []
    while open_:
        pattern, room = [], size
        used: Counter = Counter()
        while room:
            i = bisect.bisect_right(open_, room) - 1
            while i >= 0 and used[open_[i]] >= left[open_[i]]:
                i -= 1
            if i < 0:
                break
            pattern.append(open_[i])
            used[open_[i]] += 1
            room -= open_[i]
        times = min(left[n] // k for n, k in used.items())
        out.append((tuple(pattern), times))
        for n, k in used.items():
            left[n] -= times * k
            if not left[n]:
                open_.pop(bisect.bisect_left(open_, n))
    return out


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(pattern of lengths, repeats) that use every piece exactly once."""
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    out = []
    if left[size]:
        out.append(((size,), left.pop(size)))
    lengths = np.array(sorted(n for n in left if left[n]), np.int64)
    if len(lengths):
        patterns = exact_patterns(lengths, size)
        if len(patterns):
            target = np.zeros(size + 1)
            target[lengths] = [left[int(n)] for n in lengths]
            x = nonnegative_fit(patterns, target)
            for i in np.argsort(-x, kind="stable"):
                if x[i] < 0.5:
                    break
                need = Counter(int(n) for n in patterns[i] if n)
                times = min([int(round(x[i]))] + [left[n] // k for n, k in need.items()])
                if times:
                    out.append((tuple(sorted(need.elements(), reverse=True)), times))
                    for n, k in need.items():
                        left[n] -= times * k
        out += best_fit(left, size)
    return out


class Places:
    """Sequence and offset of the k-th piece of each length under a plan."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        self.by: dict[int, list] = {}
        base, taken = 0, Counter()
        for pattern, times in patterns:
            offset = 0
            for n, k in sorted(Counter(pattern).items(), reverse=True):
                self.by.setdefault(n, []).append((taken[n], base, k, offset))
                taken[n] += k * times
                offset += k * n
            base += times
        self.sequences = base
        self.by = {n: np.array(v, np.int64) for n, v in self.by.items()}

    def of(self, length: int, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranges = self.by[length]
        row = ranges[np.searchsorted(ranges[:, 0], k, "right") - 1]
        at = k - row[:, 0]
        return row[:, 1] + at // row[:, 2], row[:, 3] + at % row[:, 2] * length


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id`` and ``offset`` added."""
    counts = C.store(found.groupBy("part", "length").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``size`` rows
    places = found.sparkSession.sparkContext.broadcast(Places(plan(histogram, size)))
    earlier = W.partitionBy("length").orderBy("part")  # one row a task and length
    before = counts.select(F.col("part").alias("_part"), F.col("length").alias("_length"),
                           (F.sum("n").over(earlier) - F.col("n")).alias("_before"))
    rows = found.join(before, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    rows = rows.withColumn("number", F.col("number") + F.col("_before")).drop("_part", "_length", "_before", "part")
    names = [c for c in rows.columns if c != "number"]

    def place(batches):
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = length == n
                seq[at], off[at] = places.value.of(int(n), number[at])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + [pa.array(seq), pa.array(off)],
                                             names=[*names, "sequence_id", "offset"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "number")
    return rows.mapInArrow(place, kept + ", sequence_id long, offset long")


def packed_sequences(docs: DataFrame, size: int = SIZE, **options) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, ids as little-endian 32-bit binary."""
    rows = pack(pieces(docs, size=size, keep_ids=True, **options), size)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` ids a sequence
    return (rows.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(C.table(spark, sf_dir, "documents")))
