"""Token-id files with a minimal perfect hash index.

A shard image has a raw payload (little-endian ids, two bytes each where the
vocabulary allows) and an index: where each document starts, and a minimal
perfect hash from document key to document, with a 32-bit fingerprint per
key so that an unknown key is refused (but for 1 in 2^32).  The hash has
levels of bit sets: a key's slot on a level is taken if no other key wants
it, the others go on to the next level; a key's number is the count of set
bits before its own.  Any document is found in constant time, without the
keys and without a scan.

Shards are written by Spark as rows of binary columns, because Spark's
writers reach every store its readers do.  Documents are range partitioned
and sorted by (id, text hash), so equal ids may spread over shards, and cut
into shards of about ``SHARD_IDS`` ids; a task holds one shard at a time.

Null text counts as empty (the end id alone).  Null ids are stored first,
readable in order, without a key.  Repeated ids: one key, several documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.llm import common as C
from claimsmith.llm.tokenize import CHUNK, encoder

SHARD_IDS = 1 << 21
END_ID = 0
_U = np.uint64
_SHARDS = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                     ("low", pa.int64()), ("high", pa.int64()), ("width", pa.int32()),
                     ("keys", pa.binary()), ("nulls", pa.int64()), ("starts", pa.binary()),
                     ("levels", pa.list_(pa.binary())), ("prints", pa.binary()), ("first", pa.binary()), ("payload", pa.binary())])
SHARD_DDL = ("part long, seq long, n_docs long, n_ids long, low long, high long, width int, keys binary, nulls long, "
             "starts binary, levels array<binary>, prints binary, first binary, payload binary")


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    return C.mix(keys.astype(np.int64).view(np.uint64) + _U((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys; ``numbers`` maps them onto 0..n-1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # bit sets, one byte for eight slots
        self.rank, base = [], 0
        for bits in levels:
            words = np.bitwise_count(bits.view(np.uint64)).astype(np.int64)
            self.rank.append(base + np.cumsum(words) - words)
            base += int(words.sum())
        self.size = base

    @staticmethod
    def build(keys: np.ndarray, room: float = 2.0) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(64, -(-int(room * len(left)) // 64) * 64)
            slot = (_hash(left, len(levels)) % _U(size)).astype(np.int64)
            wanted = np.bincount(slot, minlength=size)
            levels.append(np.packbits(wanted == 1, bitorder="little"))
            left = left[wanted[slot] > 1]
        return PerfectHash(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for one that surely isn't there."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            words = bits.view(np.uint64)
            slot = _hash(keys[open_], level) % _U(len(bits) * 8)
            word, bit = (slot >> _U(6)).astype(np.int64), slot & _U(63)
            here = (words[word] >> bit) & _U(1) == 1
            below = np.bitwise_count(words[word] & ((_U(1) << bit) - _U(1))).astype(np.int64)
            out[open_[here]] = (self.rank[level][word] + below)[here]
            open_ = open_[~here]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1000) >> _U(32)).astype(np.uint32)


def shard_image(part: int, seq: int, keys: list[int | None], ids: list[np.ndarray]) -> dict:
    """One shard of documents in ascending key order, null keys first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first = np.unique(known, return_index=True)
    index = PerfectHash.build(distinct)
    number = index.numbers(distinct)
    prints, place = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.uint32)
    prints[number] = fingerprint(distinct)
    place[number] = first + nulls
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<u8")
    payload = np.concatenate(ids)
    return {"part": part, "seq": seq, "n_docs": len(keys), "n_ids": len(payload), "low": int(known[0]) if len(known) else None,
            "high": int(known[-1]) if len(known) else None, "width": payload.dtype.itemsize, "keys": known.astype("<i8").tobytes(),
            "nulls": nulls, "starts": starts.tobytes(), "levels": [b.tobytes() for b in index.levels],
            "prints": prints.astype("<u4").tobytes(), "first": place.astype("<u4").tobytes(), "payload": payload.tobytes()}


class Shard:
    """A shard image read back."""

    def __init__(self, row: dict):
        self.starts = np.frombuffer(row["starts"], "<u8").astype(np.int64)
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.nulls = row["nulls"]
        self.index = PerfectHash([np.frombuffer(b, np.uint8) for b in row["levels"]])
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.first = np.frombuffer(row["first"], "<u4").astype(np.int64)
        self.payload = np.frombuffer(row["payload"], f"<u{row['width']}")

    def documents(self, keys: np.ndarray) -> np.ndarray:
        """First document of each key, -1 for unknown keys."""
        number = self.index.numbers(keys)
        out = np.full(len(keys), -1, np.int64)
        some = np.flatnonzero(number >= 0)
        some = some[self.prints[number[some]] == fingerprint(keys[some])]
        out[some] = self.first[number[some]]
        return out

    def ids(self, document: int) -> np.ndarray:
        return self.payload[self.starts[document]:self.starts[document + 1]]

    def get(self, key: int) -> np.ndarray | None:
        document = int(self.documents(np.array([key], np.int64))[0])
        return None if document < 0 else self.ids(document)


def _write(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int, shard_ids: int) -> Iterator[pa.RecordBatch]:
    enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
    keys, ids, size = [], [], 0
    end = np.array([end_id], enc.dtype)

    def image():
        return pa.RecordBatch.from_pylist([shard_image(part, seq, keys, ids)], schema=_SHARDS)

    for held in C.one_at_a_time(batches):
        own_keys = held[0].column(0).to_pylist()
        for lo, texts in C.chunks(held[0].column(1), CHUNK):
            for key, own in zip(own_keys[lo:lo + len(texts)], enc.encode_many(texts.to_pylist())):
                keys.append(key)
                ids.append(np.concatenate([own, end]))
                size += len(ids[-1])
                if size >= shard_ids:
                    yield image()
                    keys, ids, size, seq = [], [], 0, seq + 1
            del texts
    if keys:
        yield image()


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 end_id: int = END_ID, shard_ids: int = SHARD_IDS, target: str | None = None) -> DataFrame:
    """Encode, write shards in ascending key order, and return the written shards.

    ``target``: folder for the files; by default one below the shared checkpoint folder.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    shards = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(lambda it: _write(it, path, end_id, shard_ids), SHARD_DDL))
    if target is None:
        return C.store(shards)
    shards.write.parquet(target)
    return docs.sparkSession.read.parquet(target)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: v[0].as_py() for k, v in zip(batch.schema.names, batch.slice(i, 1).columns)}
            shard = Shard(row)
            distinct = np.unique(shard.keys)
            first = shard.documents(distinct)
            if (first < 0).any():
                raise ValueError(f"shard {row['part']}/{row['seq']}: index lacks a key")
            # Equal keys stand side by side: each key's documents end where the next key's begin.
            count = np.diff(np.append(first, len(shard.starts) - 1))
            key = [None] * shard.nulls + np.repeat(distinct, count).tolist()
            docs = range(len(shard.starts) - 1)
            crc = [zlib.crc32(shard.ids(d).astype("<u4").tobytes()) for d in docs]
            n = len(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int64()), pa.array([row["seq"]] * n, pa.int64()), pa.array(key, pa.int64()),
                 pa.array(shard.starts[:-1]), pa.array(np.diff(shard.starts)), pa.array(crc, pa.int64())],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, seq, shard_start): ids before each shard; one row a part meets in a window, then one a shard."""
    sizes = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inner = W.partitionBy("part").orderBy("seq")
    return (shards.select("part", "seq", "n_ids").join(parts, "part")
            .select("part", "seq", (F.col("before") + F.sum("n_ids").over(inner) - F.col("n_ids")).alias("shard_start")))


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, found through its shard's index."""
    found = shards.mapInArrow(_read, "part long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (found.join(shard_starts(shards), ["part", "seq"])
            .select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(shards: DataFrame, key: int) -> list[np.ndarray]:
    """Ids of a key's first document in each shard that holds it, by the index alone."""
    rows = shards.where((F.col("low") <= key) & (F.col("high") >= key)).collect()
    return [x for x in (Shard(r.asDict()).get(key) for r in rows) if x is not None]


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(write_shards(C.table(spark, sf_dir, "documents")))
