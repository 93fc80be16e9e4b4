"""Product codes of vectors from Hilbert-sorted flat blocks, in whole numbers.

Vectors are scaled to whole numbers and cut into equal parts; each part has a
codebook that rounds of nearest-entry assignment and flooring means refine.

For every part the sub-vectors are sorted along a Hilbert curve over their
quantised components and cut into flat blocks of at most ``BLOCK`` rows, each
stored with the min/max box and the sum of its rows.  In a round a block
first holds its box against the codebook: an entry whose least distance to
the box is above another one's greatest distance can't be the nearest of any
row.  What is left is the block's shortlist; with one entry the stored sum is
added as it is, else a small exact kernel compares rows and shortlist.

All sums and distances are whole numbers, so codes don't depend on how rows
are dealt.  The kernel multiplies in double precision where every product sum
is below 2^53 (exact) and in 64-bit integers elsewhere.  Only the codebooks
(``PARTS * ENTRIES`` entries, whatever the input) pass through the driver.

Blocks come from range partitions ordered by (part, curve, row), so a million
equal vectors are many blocks in many tasks; label sums are combined before
their shuffle and joined back in a join whose hot labels Spark splits.

Left out: vectors that are null, empty or hold null or non-finite components,
whose components are so large that a squared error might not fit a long
(131,072 and more with 64 components), or whose length isn't that of the kept vector with the smallest id.
A length that the parts don't divide is filled up with zeros.  Null ids
are coded like others and come last when codebooks start; repeated rows are
rows of their own; a table without usable vectors has no rows.  Other columns
are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK, BITS = 256, 4  # rows of a block; bits a component on the curve


def limit(length: int) -> int:
    """Components below this have squared errors below 2^62."""
    return math.isqrt((1 << 62) // (4 * length))


def whole(values: np.ndarray, length: int, parts: int) -> np.ndarray:
    """Scaled components (rows x parts x width), filled up with zeros."""
    width = -(-length // parts)
    out = np.zeros((len(values) // length, width * parts), np.int64)
    out[:, :length] = np.floor(values.astype(np.float64).reshape(-1, length) * SCALE)
    return out.reshape(-1, parts, width)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bytes (rows x k) that sort like the places of integer points below ``2 ** bits`` on the Hilbert curve."""
    x = [c.astype(np.int64) for c in cells.T]
    width = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(width):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = x[0] ^ np.where(x[i] & q, q - 1, swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, width):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & q, q - 1, 0)
    woven = [((v ^ turn) >> b) & 1 for b in range(bits - 1, -1, -1) for v in x]
    return np.packbits(np.stack(woven, axis=1).astype(np.uint8), axis=1)


def shortlist(lo: np.ndarray, hi: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Entries that may be nearest to some row of the box (ties included), in order."""
    least = (np.maximum(np.maximum(lo - book, book - hi), 0) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(book - lo), np.abs(book - hi)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``book``, squared distance) of each row's nearest entry; ties to the first."""
    big = max(int(np.abs(rows).max()), int(np.abs(book).max()), 1)
    if 4 * rows.shape[1] * big * big < 1 << 53:
        x, c = rows.astype(np.float64), book.astype(np.float64)
        apart = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    else:
        apart = np.stack([((rows - c) ** 2).sum(axis=1) for c in book], axis=1)
    at = apart.argmin(axis=1)
    return at, apart[np.arange(len(rows)), at].astype(np.int64)


def _arrays(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _ranges(batches: Iterator[pa.RecordBatch], length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """One row a task and component: its least and greatest value."""
    lo = hi = None
    for batch in batches:
        if batch.num_rows:
            x = whole(_arrays(batch.column(0)), length, parts)
            x = x.reshape(len(x), -1)
            lo = x.min(axis=0) if lo is None else np.minimum(lo, x.min(axis=0))
            hi = x.max(axis=0) if hi is None else np.maximum(hi, x.max(axis=0))
    if lo is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lo)), pa.int32()), pa.array(lo), pa.array(hi)], names=["at", "lo", "hi"])


def _split(batches: Iterator[pa.RecordBatch], length: int, parts: int, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row a part: its place on the curve and its components; id and label go with the first part only."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            own = batch.slice(at, 2048)
            x = whole(_arrays(own.column(3)), length, parts)
            for p in range(parts):
                cells = (x[:, p] - lo[p]) * (1 << BITS) // (hi[p] - lo[p] + 1)
                key = hilbert_keys(cells)
                ids, labels = ((own.column(1), own.column(2)) if p == 0 else
                               (pa.nulls(len(x), own.column(1).type), pa.nulls(len(x), own.column(2).type)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), p), pa.int32()), pa.array([k.tobytes() for k in key], pa.binary()), own.column(0), ids, labels,
                     pa.array([v.tobytes() for v in x[:, p].astype("<i4")], pa.binary())], names=["part", "curve", "row", "id", "label", "x"])


def _flat_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``BLOCK`` rows of one part, with their box and sum."""
    for batch in batches:
        part = batch.column(0).to_numpy()
        cuts = np.union1d(np.flatnonzero(np.diff(part)) + 1, np.arange(0, batch.num_rows, BLOCK))
        for a, b in zip(cuts, np.append(cuts[1:], batch.num_rows)):
            run = batch.slice(a, b - a)
            x = np.frombuffer(b"".join(run.column(5).to_pylist()), "<i4").reshape(b - a, -1)
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
            raw = lambda v: pa.array([v.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[a]], pa.int32()), one(run.column(2)), one(run.column(3)), one(run.column(4)), raw(x),
                 raw(x.min(axis=0)), raw(x.max(axis=0)), raw(x.sum(axis=0, dtype=np.int64))], names=["part", "rows", "ids", "labels", "x", "lo", "hi", "total"])


def _block(batch: pa.RecordBatch, i: int, books: np.ndarray):
    """(part, rows, shortlist, place of each row in it, squared distances, stored sum) of a block; no places where one entry is left."""
    part = batch.column("part")[i].as_py()
    book = books[part]
    ints = lambda c, kind="<i4": np.frombuffer(batch.column(c)[i].as_py(), kind).astype(np.int64)
    some = shortlist(ints("lo"), ints("hi"), book)
    x = ints("x").reshape(-1, book.shape[1])
    return part, x, some, ints("total", "<i8")


def _sums(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, entry, rows, component sums) of a task's blocks."""
    count = np.zeros(books.shape[:2], np.int64)
    total = np.zeros(books.shape, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            part, x, some, stored = _block(batch, i, books)
            if len(some) == 1:
                count[part, some[0]] += len(x)
                total[part, some[0]] += stored
            else:
                entry = some[nearest(x, books[part][some])[0]]
                np.add.at(count[part], entry, 1)
                np.add.at(total[part], entry, x)
    part, entry = np.nonzero(count)
    if len(part):
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]),
                                          pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])


def _codes(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            part, x, some, _ = _block(batch, i, books)
            at, apart = nearest(x, books[part][some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rows").slice(i, 1).flatten(), batch.column("ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten(),
                 pa.array(np.full(len(x), part), pa.int32()), pa.array(some[at], pa.int32()), pa.array(apart)],
                names=["row", "id", "label", "part", "entry", "apart"])


class Codebooks:
    """Codebooks (parts x entries x width); ``text`` lists all components in order."""

    def __init__(self, books: np.ndarray):
        self.books = books

    def refined(self, sums) -> Codebooks:
        """Used entries replaced by their floored means."""
        books = self.books.copy()
        for part, entry, n, total in sums:
            books[part, entry] = [t // n for t in total]
        return Codebooks(books)

    @property
    def text(self) -> str:
        return ",".join(map(str, self.books.ravel().tolist()))


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, x) of vectors with finite components that fit."""
    x, length = F.col("x"), F.size("x")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vec_col}`").alias("x"))
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * F.lit(float(SCALE)) < F.sqrt(F.lit(2.0 ** 60) / F.size("x"))))
    return rows.where(x.isNotNull() & (length > 0)).where(fits)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id",
          vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks] | None:
    """The stored blocks of all usable vectors and the codebooks fitted on them; None without vectors."""
    rows = usable(vectors, id_col, vec_col, label_col)
    order = [F.col("id").asc_nulls_last(), F.col("x")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = len(first[0].x)
    rows = rows.where(F.size("x") == length)
    start = np.array([r.x for r in rows.orderBy(*order).limit(entries).collect()], np.float64)
    books = Codebooks(whole(start.ravel(), length, parts).transpose(1, 0, 2))
    width = books.books.shape[2]
    spread = (rows.select("x").mapInArrow(lambda it: _ranges(it, length, parts), "at int, lo long, hi long")
              .groupBy("at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("at").collect())  # one row a component
    lo, hi = (np.array([r[c] for r in spread]).reshape(parts, width) for c in ("lo", "hi"))
    kinds = dict(rows.dtypes)
    split = (rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "x")
             .mapInArrow(lambda it: _split(it, length, parts, lo, hi), f"part int, curve binary, row long, id {kinds['id']}, label {kinds['label']}, x binary"))
    keys = ["part", "curve", "row"]
    blocks = C.store(split.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(
        _flat_blocks, f"part int, rows array<long>, ids array<{kinds['id']}>, labels array<{kinds['label']}>, x binary, lo binary, hi binary, total binary"))
    for _ in range(rounds):
        now = books.books
        sums = (blocks.select("part", "x", "lo", "hi", "total").mapInArrow(lambda it: _sums(it, now), "part int, entry int, n long, total array<long>")
                .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total")))
        books = books.refined(sums.collect())  # parts x entries rows at most
    return blocks, books


def encode(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, codes, error) of every vector in the blocks; ``codes``: an entry a part."""
    kinds = {c: t[len("array<"):-1] for c, t in blocks.dtypes if t.startswith("array<")}
    final, parts = books.books, len(books.books)
    coded = blocks.mapInArrow(lambda it: _codes(it, final), f"row long, id {kinds['ids']}, label {kinds['labels']}, part int, entry int, apart long")
    entry = lambda p: F.max(F.when(F.col("part") == p, F.col("entry")))
    return (coded.groupBy("row").agg(F.first("id", True).alias("id"), F.first("label", True).alias("label"),
                                     F.array(*[entry(p) for p in range(parts)]).alias("codes"), F.sum("apart").alias("error")).drop("row"))


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together (null where a long can't hold it)."""
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error")).select(F.col("label").alias("_label"), "label_error")
    # Coalesced keys, computed anew on both sides, so that Spark splits a hot label and the nulls.
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return coded.join(sums, text("label") == text("_label")).drop("_label")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per usable embedding: its code, its error, that of its label, and the codebooks' digest."""
    vectors = C.table(spark, sf_dir, "embeddings")
    fitted = train(vectors)
    if fitted is None:
        none = vectors.limit(0)
        return none.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                       (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    blocks, books = fitted
    rows = label_errors(C.store(encode(blocks, books)))
    digits = [F.lpad(F.lower(F.hex(F.get("codes", F.lit(p)))), 2, "0") for p in range(PARTS)]
    return rows.select(F.col("id").alias("vec_id"), F.concat(*digits).alias("code"), "error", "label_error",
                       F.lit(hashlib.sha256(books.text.encode()).hexdigest()).alias("codebooks_sha256"))
