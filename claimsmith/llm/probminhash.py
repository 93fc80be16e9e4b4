"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Elements are five-word shingles weighted 1 + ln(count in the document).  Each
element sends a Poisson process of rate *weight* to ``registers`` registers;
a register keeps the element of its earliest arrival, so two documents agree
in a register with probability equal to their probability Jaccard
``sum_i 1 / sum_j max(x_j/x_i, y_j/y_i)``.  An element stops as soon as its
next arrival is later than the latest register (early termination).

Rows of registers are hashed into bands; documents that share a band are
compared exactly and linked when the probability Jaccard or the plain
Jaccard of their shingle sets reaches the threshold.  Either measure has its
own registers: a document that repeats a shingle has a second sketch with all
weights 1 and the bands of both; without repeats the two sketches are one.

How groups of any size stay linear:

* equal word sequences are one node, named by their hash and represented by
  their smallest id, so a huge group of copies is one node;
* a band's members are compared with the band's smallest node, not with each
  other; links found this way are joined into components;
* only members of one band that ended up in *different* components are then
  compared with each other, in blocks, so no link between components is lost
  and a large group of near copies costs one comparison a member.  Blocks
  sort out pairs by the agreement of their registers (4 standard errors below
  the threshold in both sketches) and compare the rest exactly; only links
  leave them.

Null ids: the row is kept and never linked.  Null or empty text, or text
without any word: no shingle; linked only with rows of the very same
non-empty text.  An id with several texts has a node for each; its class
joins the links of all of them, while ``keep_one`` judges every text by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

BANDS, BAND_ROWS = 32, 6
BLOCK, BLOCK_SHINGLES = 512, 250_000  # members and shingles of one band that meet in a task, on either side
ERRORS = 4.0
_U = np.uint64
_SCALE = 2.0 ** -53


def weights(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def sketch(element: np.ndarray, row: np.ndarray, weight: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """ProbMinHash registers (n_rows x registers) of weighted elements.

    Rounds of 1, 1, 2, 4, ... arrivals an element; after each round elements
    whose last arrival is later than their row's latest register are done.
    """
    q = np.full(n_rows * registers, np.inf)
    z = np.zeros(n_rows * registers, np.uint64)
    at, step, block = np.zeros(len(element)), 0, 1
    while len(element):
        turn = np.arange(step + 1, step + block + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)
        u = C.mix(element[:, None] + turn[None, :])
        gap = -np.log(((u >> _U(11)).astype(np.float64) + 0.5) * _SCALE) / weight[:, None]
        x = at[:, None] + np.cumsum(gap, axis=1)
        k = ((C.mix(u) >> _U(32)) * _U(registers) >> _U(32)).astype(np.int64)
        idx = (row[:, None] * registers + k).ravel()
        flat = x.ravel()
        np.minimum.at(q, idx, flat)
        win = flat == q[idx]
        z[idx[win]] = np.repeat(element, block)[win]
        latest = q.reshape(n_rows, registers).max(axis=1)
        live = x[:, -1] < latest[row]
        element, row, weight, at = element[live], row[live], weight[live], x[live, -1]
        step += block
        block = 1 if step == 1 else block * 2
    return z.reshape(n_rows, registers)


def weighted_elements(shingle: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) with counts; shingles keep 44 bits here."""
    key = np.sort((row.astype(np.uint64) << _U(44)) | (shingle >> _U(20)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(key)))
    key = key[start]
    return key & _U((1 << 44) - 1), (key >> _U(44)).astype(np.int64), count


def band_keys(z: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """One key a band of registers (rows x bands x band rows); equal only within one band's place."""
    key = np.broadcast_to(salt, z.shape[:2]).copy()
    for j in range(z.shape[2]):
        key = C.mix(key * _U(0x9E3779B97F4A7C15) + z[:, :, j])
    return key


def sketches(element: np.ndarray, row: np.ndarray, count: np.ndarray, n_rows: int, registers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weighted registers, registers with all weights 1, rows where the two may differ)."""
    z = sketch(element, row, weights(count), n_rows, registers)
    repeats = np.zeros(n_rows, bool)
    repeats[row[count > 1]] = True
    plain, some = z.copy(), repeats[row]
    if some.any():
        at = np.cumsum(repeats) - 1
        plain[repeats] = sketch(element[some], at[row[some]], np.ones(some.sum()), int(repeats.sum()), registers)
    return z, plain, repeats


def _sketches(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    C.start_task("sketch")
    salt = C.mix(np.arange(1, bands + 1, dtype=np.uint64))
    for batch in batches:
        for lo, text in C.chunks(batch.column(1), C.CHUNK_BYTES // 2):
            words, off = C.word_hashes(text)
            n = len(text)
            shingle, row, _ = C.shingle_hashes(words, off)
            element, at, count = weighted_elements(shingle, row)
            z, plain, repeats = sketches(element, at, count, n, bands * rows)
            key, own = (band_keys(r.reshape(n, bands, rows), salt) for r in (z, plain))
            size = np.bincount(at, minlength=n)
            same, band = [], []
            for i in range(n):
                if size[i]:
                    same.append(hashlib.blake2b(words[off[i]:off[i + 1]].tobytes(), digest_size=16).digest())
                    band.append((np.union1d(key[i], own[i]) if repeats[i] else key[i]).view(np.int64))
                else:
                    raw = text[i].as_py()
                    same.append(hashlib.blake2b(raw.encode(), digest_size=15).digest() if raw else None)
                    band.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), batch.column(2).slice(lo, n), pa.array(same, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(band, pa.list_(pa.int64()))], names=["doc_id", "key", "same", "n", "bands"])


def jaccards(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(probability Jaccard, plain Jaccard) of two shingle lists."""
    return counted_jaccards(*np.unique(a, return_counts=True), *np.unique(b, return_counts=True))


def counted_jaccards(ka: np.ndarray, ca: np.ndarray, kb: np.ndarray, cb: np.ndarray) -> tuple[float, float]:
    """The same from distinct shingles in order and their counts."""
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(ka) + len(kb) - len(common))
    x, y = weights(ca), weights(cb)
    cx, cy = x[ia], y[ib]
    order = np.argsort(cx / cy, kind="stable")
    cx, cy = cx[order], cy[order]
    ratio = cx / cy
    only_x, only_y = x.sum() - cx.sum(), y.sum() - cy.sum()
    up = only_x + np.append(np.cumsum(cx[::-1])[::-1], 0.0)
    down = only_y + np.append(0.0, np.cumsum(cy))
    first = np.searchsorted(ratio, ratio, "left")
    return float((1.0 / (up[first] / cx + down[first] / cy)).sum()), plain


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    def shingles(column, i):
        w, off = C.word_hashes(column.slice(i, 1))
        return C.shingle_hashes(w, off)[0]

    for batch in batches:
        keep, last, known = [], None, None
        for i in range(batch.num_rows):
            if batch.column(0)[i].as_py() != last:
                last, known = batch.column(0)[i].as_py(), shingles(batch.column(2), i)
            keep.append(max(jaccards(known, shingles(batch.column(3), i))) >= threshold)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those (u, v) pairs whose texts reach the threshold."""
    joined = (pairs.join(texts.toDF("v", "tv"), "v").join(texts.toDF("u", "tu"), "u").select("u", "v", "tu", "tv"))
    return joined.mapInArrow(lambda it: _verify(it, threshold), "u long, v long")


def _profiles(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(id, bands, registers as 16 bits, distinct shingles, counts, number of shingles) of texts.

    Bands and registers: those of the weighted sketch, then those of the plain one."""
    salt = C.mix(np.arange(1, bands + 1, dtype=np.uint64))
    for batch in batches:
        for lo, text in C.chunks(batch.column(1), C.CHUNK_BYTES // 2):
            words, off = C.word_hashes(text)
            n = len(text)
            shingle, row, _ = C.shingle_hashes(words, off)
            element, at, count = weighted_elements(shingle, row)
            z, plain, _ = sketches(element, at, count, n, bands * rows)
            band = np.hstack([band_keys(r.reshape(n, bands, rows), salt) for r in (z, plain)])
            short = (C.mix(np.hstack([z, plain])) >> _U(48)).astype("<u2")
            order = np.argsort(row, kind="stable")
            shingle, cut = shingle[order], np.searchsorted(row[order], np.arange(n + 1))
            own = [np.unique(shingle[a:b], return_counts=True) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, n), pa.array([b.view(np.int64) for b in band], pa.list_(pa.int64())),
                 pa.array([r.tobytes() for r in short], pa.binary()), pa.array([k.astype("<u8").tobytes() for k, _ in own], pa.binary()),
                 pa.array([c.astype("<u4").tobytes() for _, c in own], pa.binary()), pa.array([len(k) for k, _ in own], pa.int64())],
                names=["id", "bands", "registers", "shingles", "counts", "n"])


def _block(threshold: float):
    """Links between members of one band in different components, within one pair of blocks.

    A pair is looked at in its first common band only (of two bands in one
    place, the smaller key).  The agreement of the registers of either sketch,
    within ``ERRORS`` standard errors, sorts out the dissimilar ones, an exact
    comparison decides on the rest."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = {c: table.column(c).chunk(0) if table.num_rows else None for c in table.column_names}
        own, bi, bj = (col[c].to_numpy() for c in ("own", "bi", "bj"))
        left, right = np.flatnonzero(own == bi[0]), np.flatnonzero(own == bj[0])
        component, band = col["component"].to_numpy(), col["band"][0].as_py()
        differ = component[left][:, None] != component[right][None, :]
        if bi[0] == bj[0]:
            differ &= left[:, None] < right[None, :]
        keys = np.stack([np.asarray(x) for x in col["bands"].to_numpy(zero_copy_only=False)])
        places = keys.shape[1] // 2
        place = int(np.flatnonzero(keys[0] == band)[0]) % places
        for k in range(place + 1):
            for a in (k, k + places):
                for b in (k, k + places):
                    earlier = keys[left, a][:, None] == keys[right, b][None, :]
                    if k == place:
                        earlier &= (keys[left, a] < band)[:, None]
                    differ &= ~earlier
        i, j = np.nonzero(differ)
        i, j = left[i], right[j]
        registers = np.stack([np.frombuffer(x.as_py(), "<u2") for x in col["registers"]])
        least = threshold - ERRORS * np.sqrt(threshold * (1 - threshold) / (registers.shape[1] // 2))
        agreement = lambda a, b: (registers[a] == registers[b]).reshape(len(a), 2, -1).mean(axis=2).max(axis=1)
        near = np.concatenate([agreement(i[lo:lo + 50_000], j[lo:lo + 50_000]) >= least
                               for lo in range(0, len(i), 50_000)]) if len(i) else np.zeros(0, bool)
        shingles = lambda r: (np.frombuffer(col["shingles"][int(r)].as_py(), "<u8"), np.frombuffer(col["counts"][int(r)].as_py(), "<u4"))
        u, v, last, known = [], [], None, None
        ids = col["id"].to_numpy()
        for a, b in zip(i[near], j[near]):
            if a != last:
                last, known = a, shingles(a)
            if max(counted_jaccards(*known, *shingles(b))) >= threshold:
                u.append(int(ids[a]))
                v.append(int(ids[b]))
        return pa.table({"u": u, "v": v}, schema=schema)

    return run


def between_components(labelled: DataFrame, texts: DataFrame, threshold: float, bands: int, band_rows: int) -> DataFrame:
    """Links (u, v) between members of one band that are in different components.

    ``labelled``: (band, id, component) without the ids that all others of
    the band have been compared with.  Members of a large band meet in blocks
    of bounded size; only links leave the tasks, never pairs."""
    split = (labelled.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"))
             .where("a <> b").select("band"))
    open_ = C.store(labelled.join(C.dealt_anew(split, "band"), "band", "left_semi"))
    known = C.store(texts.join(open_.select("id").distinct(), "id", "left_semi")
                    .mapInArrow(lambda it: _profiles(it, bands, band_rows),
                                "id long, bands array<long>, registers binary, shingles binary, counts binary, n long"))
    members = open_.join(known.select("id", "n"), "id")
    size = members.groupBy("band").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = (members.join(C.dealt_anew(size, "band"), "band").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("band", "id", "component", "own", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj")))
    rows = placed.join(known.drop("n"), "id")
    return C.store(rows.groupBy("band", "bi", "bj").applyInArrow(_block(threshold), "u long, v long")).distinct()


def linked(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, band_rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, node) of every row with an id, and the links (u, v) between nodes.

    ``key`` is the hash of the text, ``node`` that of its words; a text that is
    never linked has a null node."""
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))
    base = base.where("doc_id is not null")
    sketched = C.store(base.mapInArrow(lambda it: _sketches(it, bands, band_rows),
                                       "doc_id long, key long, same binary, n long, bands array<long>")
                       .withColumn("node", F.when(F.col("same").isNotNull(), F.xxhash64("same"))).drop("same")
                       .withColumn("row", F.monotonically_increasing_id()))
    groups = C.dealt_anew(sketched.where("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("rep")), "node")
    reps = sketched.where("n > 0").join(groups, "node").where("row = rep.row")
    band = C.store(reps.select(F.col("node").alias("id"), F.explode("bands").alias("band")))
    first = band.groupBy("band").agg(F.min("id").alias("u"), F.count("*").alias("c")).where("c > 1").select("band", "u")
    shared = C.store(band.join(C.dealt_anew(first, "band"), "band"))
    wanted = C.store(reps.select("doc_id", "key", F.col("node").alias("id")).distinct()
                     .join(shared.select("id").distinct(), "id", "left_semi"))
    # Most texts are no candidate: a filter of bounded size keeps them out of the shuffle, the join is exact.
    # All texts of a node have the same words: any one will do.
    candidates = C.maybe_in(base, C.key_filter(wanted, "doc_id", "key"), "doc_id", "key").where("_maybe").drop("_maybe")
    texts = C.store(candidates.join(wanted, ["doc_id", "key"]).select("id", "text").dropDuplicates(["id"]))
    stars = shared.where("u <> id").select("u", F.col("id").alias("v")).distinct()
    links = C.store(verified(stars, texts, threshold))
    label = C.connected_components(links)
    labelled = (shared.where("id <> u").join(label, "id", "left")
                .select("band", "id", F.coalesce("component", "id").alias("component")))
    more = between_components(labelled, texts, threshold, bands, band_rows)
    return sketched.select("doc_id", "key", "node"), links.union(more)


def components(member: DataFrame, links: DataFrame) -> DataFrame:
    """``member`` rows with the ``component`` of their node."""
    label = C.connected_components(links).withColumnRenamed("id", "node")
    return (member.join(C.dealt_anew(label, "node"), "node", "left")
            .withColumn("component", F.coalesce("component", "node")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = C.SIMILARITY, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, class_id) for every non-null id: class_id is the smallest id of its group."""
    rows, links = linked(docs, id_col, text_col, threshold, bands, band_rows)
    member = C.store(rows.where("node is not null").select("doc_id", "node").distinct())
    # Texts of one id are joined to its smallest node.
    one = member.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("most")).where("v <> most").select("doc_id", "v")
    texts = member.join(C.dealt_anew(one, "doc_id"), "doc_id").where("node <> v").select(F.col("node").alias("u"), "v")
    member = C.store(components(member, links.union(texts)).select("doc_id", "component"))
    low = member.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    classes = member.join(C.dealt_anew(low, "component"), "component").select("doc_id", "class_id").distinct()
    ids = rows.select("doc_id").distinct()
    return (ids.join(classes, "doc_id", "left")
            .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document id: its class, whether it stays."""
    return near_duplicates(C.table(spark, sf_dir, "documents")).withColumn("kept", F.col("class_id") == F.col("doc_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = C.SIMILARITY,
             bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay: one per group of near-equal texts; rows with a null id stay.

    A group keeps a text of its smallest id.  Unlike texts of one id are in
    different groups and all stay; of repeated rows with one id and one text
    exactly one stays.  Their texts are shuffled only where rows do repeat.
    """
    rows, links = linked(docs, id_col, text_col, threshold, bands, band_rows)
    member = C.store(components(rows.where("node is not null"), links).select("doc_id", "key", "component").distinct())
    low = member.groupBy("component").agg(F.min("doc_id").alias("low"))
    least = C.store(member.join(C.dealt_anew(low, "component"), "component").where("doc_id = low")
                    .groupBy("component", "low").agg(F.min("key").alias("least")))
    gone = (member.join(C.dealt_anew(least, "component"), "component").where("doc_id <> low or key <> least")
            .select("doc_id", "key", F.lit(True).alias("gone")))
    many = rows.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key", F.lit(False).alias("gone"))
    judged = C.store(gone.unionAll(many).groupBy("doc_id", "key").agg(F.max("gone").alias("_gone"))
                     .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "_gone"))
    # Rows that are neither a copy nor repeated stay where they are; the others meet their verdict in an exact join.
    own = docs.withColumns({"_own_id": F.col(f"`{id_col}`").cast("long"), "_own_key": F.xxhash64(F.col(f"`{text_col}`"))})
    own = C.maybe_in(own, C.key_filter(judged, "_id", "_key"), "_own_id", "_own_key")
    exact = own.where("_maybe").join(judged, (F.col("_own_id") == F.col("_id")) & (F.col("_own_key") == F.col("_key")), "left")
    parts = [own.where("not _maybe"), exact.where("_gone is null"), exact.where("not _gone").dropDuplicates([id_col, text_col])]
    parts = [part.select(*[F.col(f"`{c}`") for c in docs.columns]) for part in parts]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])
