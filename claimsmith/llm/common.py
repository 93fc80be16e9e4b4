"""Shared helpers of the training-data operators.

* ``table`` reads one table of a data folder (any path Spark can read);
* ``store`` writes an intermediate frame to the shared checkpoint folder and
  reads it back (lineage cut that survives lost executors);
* ``connected_components`` labels a graph given as an edge table;
* the word helpers turn Arrow string columns into 64-bit word and shingle
  hashes without a Python object per word.

A *word* is a maximal run of ASCII letters, digits and non-ASCII bytes of the
lower-cased UTF-8 text, so case, punctuation and spacing never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.sources.sinks import materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
CHUNK_BYTES = 1 << 20

_U = np.uint64
_MUL = _U(0x9E3779B97F4A7C15)  # odd multiplier of the polynomial hashes
_MUL_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD_BYTE = np.array([chr(b).isalnum() or b >= 0x80 for b in range(256)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder as Parquet and read back."""
    return materialize(df, "table")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed with a prefix, so that joins never clash."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def dealt_anew(df: DataFrame, *keys: str) -> DataFrame:
    """The same rows with key columns computed anew, for a join after an aggregate.

    A join on an aggregate's keys would reuse the aggregate's partitioning,
    and the rows of a hot key on the other side would all meet in one task.
    Keys that are computed anew get an exchange of their own on both sides,
    whose hot partitions Spark's skew-join rule splits."""
    kinds = dict(df.dtypes)
    same = {"string": lambda c: F.concat(c, F.lit("")), "binary": lambda c: F.concat(c, F.lit(b""))}
    return df.withColumns({k: same.get(kinds[k], lambda c: c.bitwiseXOR(F.lit(0)))(F.col(k)) for k in keys})


FILTER_BITS, _PAGE = 1 << 26, 15  # bits of a key filter; a page is a bitmap of 2^15 bits


def key_filter(keys: DataFrame, *columns: str) -> DataFrame:
    """(_page, _bits): one bit for each key's hash, stored.

    At most ``FILTER_BITS`` / 2^15 rows of 4 KB (8 MB in all) however many
    keys there are, so it may always be broadcast."""
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    pages = keys.select(F.shiftright(place, _PAGE).alias("_page"), place.bitwiseAND(F.lit((1 << _PAGE) - 1)).alias("bit")).repartition("_page")
    return store(pages.groupBy("_page").agg(F.bitmap_construct_agg("bit").alias("_bits")))


def maybe_in(df: DataFrame, pages: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``_maybe``: false where the columns are none of the filter's keys for sure."""
    place = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    bit = place.bitwiseAND(F.lit((1 << _PAGE) - 1))
    own = df.withColumns({"_place": F.shiftright(place, _PAGE), "_bit": bit})
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, F.col("_bit").bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    return own.join(F.broadcast(pages), F.col("_place") == F.col("_page"), "left").withColumn("_maybe", held).drop("_place", "_bit", "_page", "_bits")


_worker: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a worker process keeps from task to task, for the operator that used it last."""
    if owner not in _worker:
        _worker.clear()
    return _worker.setdefault(owner, {})


def one_at_a_time(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Each batch in a list of its own, emptied before the next batch is read.

    A consumer that takes the batch with ``pop`` and lets go of it holds one
    batch at a time, however large batches are."""
    for batch in batches:
        held = [batch]
        del batch
        yield held
        held.clear()
        pa.default_memory_pool().release_unused()


def start_task(owner: str) -> dict:
    """The operator's cache, after memory that Arrow kept for reuse has gone back."""
    cache = worker_cache(owner)
    pa.default_memory_pool().release_unused()
    return cache


# ---------------------------------------------------------------- components

def _are_stars(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: each component is its smallest id with all others on it."""
    ends = (edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edge table -> (id, component) for every id in an edge.

    ``component`` is the smallest id reachable.  Alternates the large-star
    and small-star steps until only stars are left: O(log n)
    rounds, each linear in the edges.  The neighbourhood minimum is
    pre-aggregated before the shuffle and joined back to the edges, so a hub
    is never gathered in one task, and its edges are split over many.  Self
    loops and nulls are ignored.
    """
    e = store(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .where("u <> v").distinct())
    while not _are_stars(e):
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(dealt_anew(low, "u"), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = store(large.join(dealt_anew(low, "u"), "u")
                  .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                  .where("u <> v").distinct())
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(e.select("v", "v").distinct().toDF("id", "component")))


# --------------------------------------------------------------- word hashes

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (in place on a copy)."""
    x = x.copy()
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MUL)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        p = np.full(max(n, (1 << 18) + 1), base, np.uint64)
        p[0] = 1
        _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers[name][:n]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) slices of about ``limit`` bytes; a longer text stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right")))
        yield lo, column.slice(lo, hi - lo)
        lo = hi


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the row offsets into them; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if column.offset:
        column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and each row's first word (n + 1 offsets)."""
    data, off = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    inside = _WORD_BYTE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):  # bounded windows, so one huge text needs no huge tables
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + CHUNK_BYTES)))
        a, b = starts[lo], ends[hi - 1]
        acc = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data[a:b]] * _power("up", _MUL, b - a), out=acc[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = (acc[e] - acc[s]) * _power("down", _MUL_INV, b - a)[s]
        lo = hi
    return mix(out), np.searchsorted(starts, off)


def shingle_hashes(words: np.ndarray, off: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, word position) of every k-word shingle.

    A row with 1 to k-1 words has one shingle, made of all of them.
    """
    n = np.diff(off)
    rows = np.arange(len(n))
    hs, rs, ps = [], [], []
    if len(words) >= k:
        h = words[:len(words) - k + 1].copy()
        for j in range(1, k):
            h *= _MUL
            h += words[j:len(words) - k + 1 + j]
        row = np.repeat(rows, n)[:len(h)]
        ok = np.arange(len(h)) + k <= off[1:][row]
        hs.append(h[ok])
        rs.append(row[ok])
        ps.append(np.flatnonzero(ok) - off[:-1][row[ok]])
    for m in range(1, k):
        short = rows[n == m]
        if len(short):
            h = words[off[short]].copy()
            for j in range(1, m):
                h = h * _MUL + words[off[short] + j]
            hs.append(h)
            rs.append(short)
            ps.append(np.zeros(len(short), np.int64))
    if not hs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return mix(np.concatenate(hs)), np.concatenate(rs), np.concatenate(ps)
