import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimsmith.llm import hilbert_sharding as H
from tests.llm.conftest import SF0001, prose


def check(docs, out, shards=8):
    """Every promise of the result, against the rows themselves."""
    texts = sorted((r.doc_id is None, r.doc_id or 0, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 1) for r in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text_crc32, r.size) for r in out) == texts
    total = sum(r.size for r in out)
    largest = max((r.size for r in out), default=0)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r)
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert abs(sum(r.size for r in rows) - total / shards) <= largest + total / shards * 2 / H.GROUP_SHARE
    ordered = [r.hilbert for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (3, 3)):
        cells = spark.range((1 << bits) ** n)
        coords = [F.expr(f"CAST(shiftright(id, {bits * i}) & {(1 << bits) - 1} AS INT)") for i in range(n)]
        rows = cells.select(H.hilbert_index(coords, bits).alias("h"), F.array(*coords).alias("c")).orderBy("h").collect()
        assert [r.h for r in rows] == list(range((1 << bits) ** n))
        assert all(sum(abs(a - b) for a, b in zip(x.c, y.c)) == 1 for x, y in zip(rows, rows[1:]))


def test_promises_hold(spark, make_docs, odd_texts):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["en", "de", None])) for i in range(400)]
    rows += [(1000 + i, t, None) for i, t in enumerate(odd_texts) if t is None or len(t) < 1000] + [(7, rows[7][1], "en")] * 3 + [(None, "x", "en"), (None, None, None)]
    docs = make_docs(rows)
    check(docs.collect(), H.assign(docs).collect())


def test_hot_group_is_cut_and_small_groups_are_not(spark, make_docs):
    rng = random.Random(3)
    rows = [(i, "the same hot text", "en") for i in range(2000)] + [(5000 + i, prose(rng, 10), "en") for i in range(3000)]
    rows += [(9000 + i, rows[2000 + i // 2][1], "de") for i in range(40)]
    docs = make_docs(rows)
    out = H.assign(docs)
    check(docs.collect(), out.collect())
    hot = zlib.crc32(b"the same hot text")
    assert out.where(F.col("text_crc32") != hot).groupBy("text_key").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0


def test_empty_and_files(spark, make_docs, tmp_path):
    assert H.assign(make_docs([])).count() == 0
    docs = make_docs([(i, f"text {i}", "en") for i in range(50)] + [(None, None, None), (3, "text 3", "en")])
    H.write_shards(docs, str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 52 and back.select("_shard").distinct().count() == 4 and set(docs.columns) <= set(back.columns)


def test_strings_with_a_common_prefix_are_told_apart(spark):
    rng = random.Random(6)
    names = [None] * 40 + [f"commoncrawl-2023-{k:02d}" for k in range(20) for _ in range(rng.randint(5, 60))] + ["commoncrawl-2023-07"] * 900
    rng.shuffle(names)
    rows = spark.createDataFrame([(v,) for v in names], "v string")
    share = [i / 16 for i in range(1, 16)]
    got = {r.v: r.cell for r in rows.select("v", sum(c.cast("int") for c in H.string_cuts(rows, "v", share)).alias("cell")).distinct().collect()}
    ordered = sorted(names, key=lambda v: (v is not None, v or ""))
    cuts = [ordered[max(0, -(-int(q * 16) * len(names) // 16) - 1)] for q in share]
    above = lambda v, c: (v is not None, v or "") > (c is not None, c or "")
    assert got == {v: sum(above(v, c) for c in cuts) for v in set(names)} and len(set(got.values())) > 5
    assert H.string_cuts(rows.limit(0), "v", share) == []


def index_by_bits(x, bits):
    """Place on the curve of one cell, bit by bit (the published transpose method, on one cell's whole numbers)."""
    x, n = list(x), len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = 0
    q = 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_order_and_cutting_equal_a_plain_version(make_docs):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["en", "de", "fr", None])) for i in range(300)]
    out = {r.doc_id: r for r in H.assign(make_docs(rows)).collect()}  # no equal texts: cut by the bytes alone
    size = {i: len(t.encode()) + 1 for i, t, _ in rows}
    langs, sizes = sorted((v for *_, v in rows), key=lambda v: v or ""), sorted(size.values())
    at = [-(-k * len(rows) // 16) - 1 for k in range(1, 16)]
    cell = {i: (sum((v or "") > (langs[a] or "") for a in at), 0, sum(size[i] > sizes[a] for a in at)) for i, _, v in rows}
    assert {i: r.hilbert for i, r in out.items()} == {i: index_by_bits(c, 4) for i, c in cell.items()}
    order = sorted(out.values(), key=lambda r: (r.hilbert, r.text_key, r.text_crc32, r.size, r.doc_id))
    before, slots = 0, {}
    for r in order:
        shard = min(7, int((before + r.size / 2) * 8 // sum(size.values())))
        assert (r.shard, r.slot) == (shard, slots.setdefault(shard, 0))
        slots[shard] += 1
        before += r.size


@pytest.mark.parametrize("sf", [SF0001])
def test_query_whole_table(spark, sf):
    out = H.op6_hilbert_sharding(spark, sf).collect()
    check(spark.read.parquet(f"{sf}/documents.parquet").collect(), out)
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
