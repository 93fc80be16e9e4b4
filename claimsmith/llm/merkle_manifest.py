"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf: the hash of its fields.  The leaves of a group, in the
order of their ids, form a tree in which three consecutive nodes hash into
one; the groups' roots, in the order of their names, form the tree above.

Time-forward processing evaluates such a graph by sending each node's value
as a message to the nodes that need it, through a priority queue ordered by
the receiver's label; nodes are visited in label order, so what a node needs
lies at the front of the queue when its turn comes.  Here the queue has two
parts: the *external* one is Spark's sort-based shuffle, in which messages
are dealt by (tree, block) and sorted by label, the *inner* one is a heap
over the nodes of one block of ``3 ** BLOCK_LEVELS`` consecutive nodes.  A
round of the external queue takes every block up ``BLOCK_LEVELS`` levels, so
rounds shrink by that factor and their number is the logarithm of the largest
group.  The reversed sweep sends proof suffixes the same way from the root
down: a block gets one message, its leaves get theirs from the heap.

A hot group is many blocks, so no task ever holds more than a block; places
within groups come from range partitions and their counts, not from a window
over a group.  The driver sees the size of the largest group and the root.

Nulls: a null field hashes as ``-``; null groups are one group, the first;
null ids come first within their group.  Empty texts are fields of length 0.
Repeated ids are ordered by their leaves, and equal rows (repeats) are leaves of their
own with proofs of their own.  An empty table has no root and no rows.  Extra
columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimsmith.llm import common as C

RUN = 3  # consecutive nodes that hash into one
BLOCK_LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


# --------------------------------------------------------------------- leaves

def field(value: Column) -> Column:
    """A field's text: ``-`` for null, else its UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """The digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def group_label(value: Column) -> Column:
    """Bytes that sort like the group's name, null first, and are never null."""
    return F.when(value.isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), F.encode(value.cast("string"), "UTF-8")))


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place within their ``tree`` from 0, and ``n``, the tree's size.

    Rows are range partitioned by (tree, order); a place is the rows of the
    tree in earlier partitions plus the place within the partition.  Equal
    rows are told apart by where they were read, so they spread as well."""
    keys = ["tree", *order, "_read"]
    dealt = (rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
             .drop("_read").withColumn("_row", F.monotonically_increasing_id()))
    dealt = C.store(dealt.withColumn("_part", F.shiftright("_row", 33)))
    runs = dealt.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    tree = W.partitionBy("tree")  # at most one row a partition
    runs = runs.select(F.col("tree").alias("_t"), F.col("_part").alias("_p"), F.sum("_n").over(tree).alias("n"),
                       (F.sum("_n").over(tree.orderBy("_part")) - F.col("_n") - F.col("_first")).alias("_shift"))
    on = (F.col("tree") == F.col("_t")) & (F.col("_part") == F.col("_p"))
    return dealt.join(runs, on).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_t", "_p", "_shift")


# ------------------------------------------------------- within a block: heap

def node_digest(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def levels_of(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def send_up(first: int, digests: list[bytes], top: int) -> dict[tuple[int, int], list[bytes]]:
    """What each node of a block receives: (level, place) -> its children's digests.

    ``digests`` belong to consecutive nodes from place ``first``; the queue
    holds (level, place, slot, digest), so a node's messages come together,
    in order, and before those of any node that depends on it."""
    received = {}
    queue = [(0, first + i, 0, d) for i, d in enumerate(digests)]  # sorted, hence a heap
    while queue:
        level, at = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, at):
            children.append(heapq.heappop(queue)[3])
        received[level, at] = children
        if level < top:
            value = children[0] if level == 0 else node_digest(children)
            heapq.heappush(queue, (level + 1, at // RUN, at % RUN, value))
    return received


def block_root(received: dict, top: int, at: int) -> bytes:
    return received[top, at][0] if top == 0 else node_digest(received[top, at])


def send_down(received: dict, top: int, at: int, suffix: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, proof) of the block's nodes in order: the reversed sweep, from the block's root down.

    A proof is a step a level, from the node to the root: the node's slot, the
    number of siblings, the siblings' digests left to right."""
    queue = [(-top, at, suffix)]
    while queue:
        level, at, proof = heapq.heappop(queue)
        if level == 0:
            yield at, proof
            continue
        children = received[-level, at]
        for slot in range(len(children)):
            step = bytes((slot, len(children) - 1)) + b"".join(children[:slot] + children[slot + 1:])
            heapq.heappush(queue, (level + 1, at * RUN + slot, step + proof))


def siblings(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(slot, siblings) of each step of a proof."""
    i = 0
    while i < len(proof):
        slot, k = proof[i], proof[i + 1]
        yield slot, [proof[j:j + DIGEST] for j in range(i + 2, i + 2 + k * DIGEST, DIGEST)]
        i += 2 + k * DIGEST


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for slot, others in siblings(proof):
        leaf = node_digest(others[:slot] + [leaf] + others[slot:])
    return leaf


# ------------------------------------------------ between blocks: the shuffle

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes, int, list[tuple]]]:
    """(tree, block, its rows) of batches sorted by both; one block is held at a time."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for (tree, block), group in groupby(rows, key=lambda r: r[:2]):
        yield tree, block, list(group)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, 2000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def roots():
        for tree, block, rows in _blocks(batches):
            n = rows[0][3]
            top = min(BLOCK_LEVELS, levels_of(n))
            received = send_up(rows[0][2], [r[4] for r in rows], top)
            yield tree, block, -(-n // RUN ** BLOCK_LEVELS), block_root(received, top, rows[0][2] // RUN ** top)
    yield from _batches(roots(), pa.schema([("tree", pa.binary()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())]))


def _block() -> Column:
    return F.expr(f"pos div {RUN ** BLOCK_LEVELS}").alias("block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """[nodes, their blocks' roots, those of their blocks ...] until every tree is one node."""
    rounds = [nodes]
    size = nodes.agg(F.max("n")).first()[0] or 1
    while size > 1 or len(rounds) == 1:
        above = rounds[-1] if len(rounds) == 1 else rounds[-1].where("n > 1")
        rounds.append(C.store(_dealt(above.select("tree", _block(), "pos", "n", "digest"))
                              .mapInArrow(_climb, "tree binary, pos long, n long, digest binary")))
        size = -(-size // RUN ** BLOCK_LEVELS)
    return rounds


def tree_roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest): the root of every tree."""
    found = [r.where("n = 1").select("tree", "digest") for r in rounds[1:]]
    for more in found[1:]:
        found[0] = found[0].unionAll(more)
    return found[0]


def _deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    kind = first.schema
    schema = pa.schema([("tree", pa.binary()), ("pos", pa.int64()), ("digest", pa.binary()), ("proof", pa.binary()), ("subroot", pa.binary()),
                        *[kind.field(i) for i in range(7, len(kind))]])

    def told():
        yield first
        yield from batches

    def proofs():
        for tree, _, rows in _blocks(told()):
            message, *rows = rows  # sorted before the block's nodes
            top = min(BLOCK_LEVELS, levels_of(rows[0][3]))
            received = send_up(rows[0][2], [r[4] for r in rows], top)
            for row, (at, proof) in zip(rows, send_down(received, top, rows[0][2] // RUN ** top, message[5])):
                yield tree, at, row[4], proof, message[6], *row[7:]
    yield from _batches(proofs(), schema)


def deliver(nodes: DataFrame, messages: DataFrame, payload: tuple[str, ...] = ()) -> DataFrame:
    """(tree, pos, digest, proof, subroot, payload) of all nodes, from one message (tree, block, proof, subroot) a block."""
    kinds = dict(nodes.dtypes)
    none = lambda kind: F.lit(None).cast(kind)
    own = nodes.select("tree", _block(), "pos", "n", "digest", none("binary").alias("proof"), none("binary").alias("subroot"), *payload)
    sent = messages.select("tree", "block", F.lit(-1).cast("long"), none("long"), none("binary"), "proof", "subroot",
                           *[none(kinds[p]) for p in payload])
    more = "".join(f", `{p}` {kinds[p]}" for p in payload)
    return _dealt(own.unionAll(sent)).mapInArrow(_deliver, f"tree binary, pos long, digest binary, proof binary, subroot binary{more}")


def descend(rounds: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Messages for the blocks of ``rounds[0]``; ``outer``: (tree, proof, subroot) of every tree's root."""
    messages = None
    for nodes in rounds[:0:-1]:
        done = nodes.where("n = 1").select("tree", F.col("pos").alias("block")).join(outer, "tree")
        if messages is not None:
            done = done.unionAll(deliver(nodes.where("n > 1"), messages).select("tree", F.col("pos").alias("block"), "proof", "subroot"))
        messages = C.store(done)
    return messages


# ------------------------------------------------------------------- operator

def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "source", id_col: str = "doc_id",
             claim: Column | None = None) -> DataFrame:
    """(id, leaf, claim, subroot, root, proof) of every row, digests as bytes.

    ``claim`` is a leaf digest to hold against the manifest (null: the row's
    own); ``proof`` is read by ``siblings`` and ``fold``."""
    q = lambda c: F.col(f"`{c}`")
    rows = docs.select(group_label(q(group_col)).alias("tree"), q(id_col).alias("id"), leaf_digest([q(f) for f in fields]).alias("digest"),
                       (F.lit(None).cast("binary") if claim is None else claim).alias("claim"))
    rows = C.store(rows)  # the sample that range partitions are cut by then needs no texts
    leaves = place(rows, ["id", "digest"])
    rounds = climb(leaves)
    roots = tree_roots(rounds).select(F.lit(b"").alias("tree"), F.col("tree").alias("name"), "digest")
    top = place(roots, ["name"])
    above = climb(top)
    root = tree_roots(above).first()
    over = above[-1].sparkSession.createDataFrame([(bytearray(), bytearray(), bytearray())], "tree binary, proof binary, subroot binary")
    outer = C.store(deliver(top, descend(above, over), ("name",)).select(F.col("name").alias("tree"), "proof", F.col("digest").alias("subroot")))
    return (deliver(leaves, descend(rounds, outer), ("id", "claim"))
            .select("id", F.col("digest").alias("leaf"), "claim", "subroot",
                    F.lit(bytes(root.digest) if root else None).cast("binary").alias("root"), "proof"))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf, claim, proof = (batch.column(c).to_pylist() for c in ("leaf", "claim", "proof"))
        text = [b"".join(d for _, others in siblings(p) for d in others).hex().encode() for p in proof]
        told = pa.array([hashlib.sha256(t).digest() for t in text], pa.binary())
        folded = pa.array([fold(c if c is not None else x, p) for x, c, p in zip(leaf, claim, proof)], pa.binary())
        kept = batch.select(["id", "leaf", "subroot", "root"])
        yield pa.RecordBatch.from_arrays([*kept.columns, told, folded], names=[*kept.schema.names, "proof_digest", "folded"])


def verify(rows: DataFrame) -> DataFrame:
    """Rows of ``manifest`` with the digest of their proof, and the root their claim leads to."""
    return rows.mapInArrow(_check, f"id {dict(rows.dtypes)['id']}, leaf binary, subroot binary, root binary, proof_digest binary, folded binary")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its leaf and proof; half of the documents claim a text without line ends."""
    docs = C.table(spark, sf_dir, "documents")
    changed = [F.replace(F.col(f), F.lit("\n"), F.lit("")) if f == "text" else F.col(f) for f in FIELDS]
    picked = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    rows = verify(manifest(docs, claim=F.when(picked, leaf_digest(changed))))
    text = lambda c: F.lower(F.hex(c))
    return rows.select(F.col("id").alias("doc_id"), *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
                       text("proof_digest").alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))
