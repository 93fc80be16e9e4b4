"""Token counts by byte-pair merging with a heap and a linked list.

A piece starts as its bytes.  All adjacent pairs that have a merge rank are
in a heap; the lowest rank (leftmost on ties) is popped, its symbols become
one, and the new neighbours enter the heap.  Pairs that an earlier merge
broke are skipped when popped.  The count is symbols minus merges; no ids
are made.  Distinct pieces are remembered within bounds.

Null text counts as empty: 0 bytes, 0 tokens.  Special tokens inside a text
count as one token each, as the library does by default.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C
from claimsmith.llm.tokenize import MEMORY, is_plain, piece_splitter, stretches, tokenizer_path

LIMIT = 1024


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class Remembered(dict):
    """``make(piece)`` for pieces, kept for up to ``MEMORY`` pieces."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece):
        if len(self) >= MEMORY:
            self.clear()
        value = self[piece] = self.make(piece)
        return value


class Counter:
    """``count(text)``: number of tokens of a whole text."""

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        path = path or tokenizer_path()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.symbol = [vocab[c] for c in byte_characters()]
        self.character = {c: vocab[c] for c in byte_characters()}
        self.merge = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = piece_splitter()
        self.library = Tokenizer.from_file(path)  # only splits texts with unusual characters
        self.known = Remembered(lambda piece: self.merged([self.symbol[b] for b in piece.encode()]))
        self.known_characters = Remembered(lambda piece: self.merged([self.character[c] for c in piece]))

    def merged(self, symbols: list[int]) -> int:
        n = len(symbols)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        merge = self.merge
        heap = []
        for i in range(n - 1):
            m = merge.get((symbols[i], symbols[i + 1]))
            if m:
                heap.append((m[0], i, m[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j < 0:
                continue
            m = merge.get((symbols[i], symbols[j]))
            if not m or m[0] != rank:
                continue
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            left -= 1
            if k >= 0:
                before[k] = i
                m = merge.get((new, symbols[k]))
                if m:
                    heapq.heappush(heap, (m[0], i, m[1]))
            h = before[i]
            if h >= 0:
                m = merge.get((symbols[h], new))
                if m:
                    heapq.heappush(heap, (m[0], h, m[1]))
        return left

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts, total = [text], 0
        for s in self.special:
            parts = [q for p in parts for q in p.split(s)]
        total = sum(text.count(s) for s in self.special)
        for part in parts:
            if is_plain(part):
                total += sum(sum(map(self.known.__getitem__, self.split(s))) for s in stretches(part))
            else:
                total += sum(self.known_characters[p] for p, _ in self.library.pre_tokenizer.pre_tokenize_str(part))
        return total


def _count(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[pa.RecordBatch]:
    kept = C.start_task("counter")
    if path not in kept:
        kept[path] = Counter(path)
    count = kept[path].count
    for batch in batches:
        n = [count(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*batch.schema.names[:-1], "n_tokens"])


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                 path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    ``path``: the vocabulary file, by default each worker's installed one.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    out = rows.mapInArrow(lambda it: _count(it, path), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(C.table(spark, sf_dir, "documents"))
