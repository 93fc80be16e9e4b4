"""Removal of lines that many documents share, by levelled sorted runs of line hashes.

``LineRuns`` keeps how many documents hold each line as *runs*: stored tables
of (128-bit hash of the line's key, documents), sorted by hash.  A new batch
of documents is counted, merge-anti-joined with what the runs already call
frequent, and becomes a run of level 0; ``fanout`` runs of a level are
compacted into one run of the next, so a key is rewritten once a level and
the number of runs is logarithmic in the number of batches.  A key is
frequent when its documents in all runs reach ``least``; counting of frequent
keys ends with the batch that made them so in one run.

The documents' lines then lose those with frequent keys: (document, key)
pairs are semi-joined with the frequent keys, and the hits go back to their
document.  Texts are shuffled once, only if the hits are too many for Spark
to broadcast.

Skew: a line that a third of all documents hold is counted once a task before
any shuffle, and meets the frequent keys in a join whose hot keys Spark splits;
a document's lines are its own, whatever their number.

A line's key is the line without ASCII white space at its ends, A-Z
lower-cased; keys shorter than ``chars`` code points are never counted.  Null
or empty text: one empty line.  A document is a row: repeated rows count
as documents, repeated lines within one do not.  Null ids are documents like
any other; extra columns are kept by ``drop_lines`` whatever their names;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C
from claimsmith.sources.sinks import drop_stored, materialize

LEAST_DOCS, LEAST_CHARS = 10, 1
BATCHES, FANOUT = 4, 2
_ENDS = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_ENDS).lower()  # of bytes: A-Z only


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def line_hashes(text: bytes, chars: int) -> list[bytes | None]:
    """The hash of each line's key; None for keys that are too short to count."""
    out, known = [], {}
    for line in text.split(b"\n"):
        if line not in known:
            key = line_key(line)
            long_enough = len(key) >= chars if chars <= 1 else len(key.decode(errors="replace")) >= chars
            known[line] = key_hash(key) if long_enough else None
        out.append(known[line])
    return out


def _raw(column: pa.Array, i: int) -> bytes:
    value = column[i]
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _keys(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """(row key columns, distinct hashes) of each text."""
    C.start_task("lines")
    for held in C.one_at_a_time(batches):
        batch = held.pop()
        last = batch.num_columns - 1
        for lo, text in C.chunks(batch.column(last)):
            found = [list({h for h in line_hashes(_raw(text, i), chars) if h}) for i in range(len(text))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, len(text)) for c in range(last)], pa.array(found, pa.list_(pa.binary()))],
                                             names=[*batch.schema.names[:last], "keys"])


def _without(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose hashes are listed, with line counts."""
    C.start_task("lines")
    for held in C.one_at_a_time(batches):
        batch = held.pop()
        last = batch.num_columns - 1
        for lo, text in C.chunks(batch.column(last - 1)):
            kept, n, gone = [], [], []
            for i in range(len(text)):
                drop, raw = batch.column(last)[lo + i].as_py(), _raw(text, i)
                lines = raw.count(b"\n") + 1
                if drop:
                    drop = set(drop)
                    rest = [line for line, h in zip(raw.split(b"\n"), line_hashes(raw, chars)) if h not in drop]
                    raw, left = b"\n".join(rest), len(rest)
                kept.append(raw)
                n.append(lines)
                gone.append(lines - left if drop else 0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(lo, len(text)) for c in range(last - 1)], pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=[*batch.schema.names[:last - 1], "kept", "n_lines", "n_dropped"])


class LineRuns:
    """How many documents hold each line, as levels of sorted runs that batches are added to."""

    def __init__(self, least: int = LEAST_DOCS, fanout: int = FANOUT):
        self.least, self.fanout = least, fanout
        self.levels: list[list[tuple[DataFrame, list[str]]]] = []

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run, _ in level]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for more in runs[1:]:
            rows = rows.unionAll(more)
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"))

    def _put(self, rows: DataFrame, level: int) -> None:
        """Store a run sorted by key; a full level is compacted into a run of the next."""
        if level == len(self.levels):
            self.levels.append([])
        path: list[str] = []
        self.levels[level].append((materialize(rows.sortWithinPartitions("key"), stored=path), path))
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(self._merged([run for run, _ in old]), level + 1)
            drop_stored(rows.sparkSession, [p for _, paths in old for p in paths])

    def add(self, keys: DataFrame) -> None:
        """Count a batch: ``keys`` has one row a document and distinct line hash."""
        fresh = keys.groupBy("key").agg(F.count("*").alias("docs"))
        for run in self._runs():
            fresh = fresh.join(run.where(F.col("docs") >= self.least).select("key"), "key", "left_anti")
        self._put(fresh, 0)

    def frequent(self) -> DataFrame:
        """(key, docs) of the keys that ``least`` documents hold; docs is a lower bound above it."""
        return self._merged(self._runs()).where(F.col("docs") >= self.least)

    def release(self, spark: SparkSession) -> None:
        drop_stored(spark, [p for level in self.levels for _, paths in level for p in paths])
        self.levels = []


def _identity(id_col: str, text_col: str):
    """Columns that tell texts of one id apart; equal rows have equal results."""
    return [F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("_text_key")]


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = LEAST_CHARS, batches: int = BATCHES) -> DataFrame:
    """(_id, _text_key, keys, batch) of every row, stored a folder a batch."""
    rows = docs.select(*_identity(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    found = rows.mapInArrow(lambda it: _keys(it, chars), f"_id {rows.schema['_id'].dataType.simpleString()}, _text_key long, keys array<binary>")
    return materialize(found.withColumn("batch", F.pmod(F.xxhash64("_id", "_text_key"), F.lit(batches)).cast("int")), partition_by=["batch"])


def drop_lines(docs: DataFrame, frequent: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with the text's frequent lines gone (``text_col``), and ``n_lines`` and ``n_dropped``."""
    pairs = keys.select("_id", "_text_key", F.explode("keys").alias("key"))
    hits = (pairs.join(frequent.select("key"), "key", "left_semi").groupBy("_id", "_text_key")
            .agg(F.collect_set("key").alias("_drop")))
    hits = C.dealt_anew(C.store(hits).withColumnRenamed("_id", "_hit").withColumnRenamed("_text_key", "_hit_key"), "_hit_key")
    rest = [c for c in docs.columns if c != text_col]
    # Plain numbers for columns carried along, so that clashing names don't matter.
    rows = docs.select(*_identity(id_col, text_col), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col(f"`{text_col}`").alias("text"))
    carried = (rows.join(hits, F.col("_id").eqNullSafe(F.col("_hit")) & (F.col("_text_key") == F.col("_hit_key")), "left")
               .select(*[f"c{i}" for i in range(len(rest))], "text", "_drop"))
    kinds = dict(carried.dtypes)
    schema = "".join(f"c{i} {kinds[f'c{i}']}, " for i in range(len(rest))) + "kept string, n_lines long, n_dropped long"
    done = carried.mapInArrow(lambda it: _without(it, chars), schema)
    return done.select(*[F.col(f"c{rest.index(c)}").alias(c) if c != text_col else F.col("kept").alias(c) for c in docs.columns], "n_lines", "n_dropped")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_DOCS, chars: int = LEAST_CHARS,
          batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` without the lines whose keys ``least`` documents hold, counted batch by batch."""
    keys = hashed(docs, id_col, text_col, chars, batches)
    runs = LineRuns(least, fanout)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b).select(F.explode("keys").alias("key")))
    frequent = C.store(runs.frequent())
    runs.release(docs.sparkSession)
    return drop_lines(docs, frequent, keys, id_col, text_col, chars)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its lines, those dropped, and the digest of the rest."""
    rows = dedup(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
