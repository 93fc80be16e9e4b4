"""Codes against plain nearest-entry assignment over whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimsmith.llm import vector_codes as V
from tests.llm.conftest import SF0001

SCHEMA = "vec_id long, embedding array<float>, label int, row long, part int, x string, id string"


def plain_codes(rows):
    kept = [r for r in rows if r.embedding and all(e is not None and math.isfinite(e) for e in r.embedding)]
    kept = sorted(kept, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.embedding))
    if not kept:
        return []
    length = len(kept[0].embedding)
    kept = [r for r in kept if len(r.embedding) == length]
    width = -(-length // 4)
    x = [[math.floor(1024 * e) for e in r.embedding] + [0] * (4 * width - length) for r in kept]
    parts = [[v[p * width:(p + 1) * width] for p in range(4)] for v in x]
    books = [[v[p] for v in parts[:256]] for p in range(4)]

    def assign():
        out = []
        for v in parts:
            out.append([min((sum((a - b) ** 2 for a, b in zip(v[p], c)), e) for e, c in enumerate(books[p])) for p in range(4)])
        return out
    for _ in range(4):
        near = assign()
        for p in range(4):
            members = {}
            for v, n in zip(parts, near):
                members.setdefault(n[p][1], []).append(v[p])
            for e, own in members.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    near = assign()
    errors = {}
    for r, n in zip(kept, near):
        errors[r.label] = errors.get(r.label, 0) + sum(d for d, _ in n)
    text = ",".join(str(e) for book in books for c in book for e in c)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted([(r.vec_id, "".join(f"{e:02x}" for _, e in n), sum(d for d, _ in n), errors[r.label], digest) for r, n in zip(kept, near)], key=repr)


def query_on(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], SCHEMA)
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted((tuple(r) for r in V.op12_vector_codes(spark, str(tmp_path)).collect()), key=repr), df.collect()


def vectors(rng, n, length=8, spread=1.0):
    return [(i, [rng.gauss(0, spread) for _ in range(length)], rng.randrange(3)) for i in range(n)]


def test_query_over_many_blocks_equals_plain(spark, tmp_path):
    """More vectors than entries and blocks, a third of them one vector, one label with most rows."""
    rng = random.Random(4)
    rows = vectors(rng, 400) + [(1000 + i, [0.5] * 8, 7) for i in range(300)]
    got, held = query_on(spark, tmp_path, rows)
    assert got == plain_codes(held)


def test_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    nan, inf = float("nan"), float("inf")
    rows = vectors(rng, 20) + [(30, None, 1), (31, [1.0] * 7 + [None], 1), (32, [nan] + [0.0] * 7, 1), (33, [inf] + [0.0] * 7, 1),
                               (34, [], 1), (35, [1.0] * 4, 1), (None, [0.25] * 8, None), (None, [0.25] * 8, None), (3, [9.0] * 8, None),
                               (3, [9.0] * 8, None), (36, [100_000.0] * 8, 2), (37, [-100_000.0] * 8, 2), (38, [0.0] * 8, None)]
    got, held = query_on(spark, tmp_path, rows)
    assert got == plain_codes(held) and len(got) == 20 + 7


def test_length_that_parts_do_not_divide(spark, tmp_path):
    got, held = query_on(spark, tmp_path, vectors(random.Random(6), 40, length=10))
    assert got == plain_codes(held)


def test_empty_and_unusable_tables(spark, tmp_path):
    assert query_on(spark, tmp_path / "a", [])[0] == []
    assert query_on(spark, tmp_path / "b", [(1, None, 1), (2, [], 1)])[0] == []


@pytest.mark.parametrize("width,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_steps_to_neighbours(width, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width), axis=-1).reshape(-1, width)
    keys = V.hilbert_keys(grid, bits)
    order = sorted(range(len(grid)), key=lambda i: keys[i].tobytes())
    assert len({k.tobytes() for k in keys}) == len(grid)
    assert all(np.abs(grid[a] - grid[b]).sum() == 1 for a, b in zip(order, order[1:]))


def test_shortlist_keeps_every_nearest_entry_and_prunes():
    rng = np.random.default_rng(1)
    book = rng.integers(-300, 300, (256, 4))
    left = []
    for _ in range(50):
        rows = rng.integers(-300, 300, 4) + rng.integers(-20, 20, (64, 4))
        some = V.shortlist(rows.min(axis=0), rows.max(axis=0), book)
        apart = ((rows[:, None] - book[None]) ** 2).sum(axis=2)
        assert set(np.nonzero(apart == apart.min(axis=1)[:, None])[1]) <= set(some)
        assert (some[V.nearest(rows, book[some])[0]] == apart.argmin(axis=1)).all()
        left.append(len(some))
    assert np.mean(left) < 64


def test_kernel_is_exact_for_large_components():
    rng = np.random.default_rng(2)
    rows, book = rng.integers(-(1 << 26), 1 << 26, (50, 16)), rng.integers(-(1 << 26), 1 << 26, (20, 16))
    at, apart = V.nearest(rows, book)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)), e) for e, c in enumerate(book)) for r in rows]
    assert [(int(d), int(e)) for d, e in zip(apart, at)] == want


def test_blocks_are_flat_and_bounded(spark):
    vecs = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    blocks, _ = V.train(vecs, rounds=1)
    stats = blocks.select("part", F.size("rows").alias("n")).groupBy("part").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    assert sorted((r.part, r.n) for r in stats) == [(p, vecs.count()) for p in range(4)] and max(r.most for r in stats) <= V.BLOCK
