import random
import re

import pytest

from claimsmith.llm import string_tiling as S
from tests.llm.conftest import SF0001, prose


def words(t):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (t or "").lower())


def coverage(doc, item):
    """Greedy string tiling word by word."""
    d, t = words(doc), words(item)
    least = min(5, len(t))
    if not t:
        return 0.0
    used_d, used_t, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for b in range(len(t)):
            for a in range(len(d)):
                n = 0
                while a + n < len(d) and b + n < len(t) and d[a + n] == t[b + n] and a + n not in used_d and b + n not in used_t:
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return covered / len(t)
        used_d.update(range(a, a + n))
        used_t.update(range(b, b + n))
        covered += n


def fixture(rng):
    items = [(i, prose(rng, rng.randint(12, 30))) for i in range(6)] + [(6, "short one"), (7, ""), (8, None), (9, "the the the the the the the the")]
    docs = []
    for k in range(30):
        t = words(items[k % 6][1])
        cut = rng.randrange(len(t))
        part = t[cut:] + ["between"] * (k % 3) + t[:cut] if k % 2 else t[:cut]
        docs.append((k, prose(rng, 20) + " " + " ".join(part).upper() + ", " + prose(rng, 15)))
    docs += [(100, "Short, one!"), (101, "a short one"), (102, "the " * 40), (103, "the the the the the x the the the the the")]
    return items, docs


@pytest.mark.parametrize("block", [S.BLOCK_SEEDS, 40])
def test_coverage_equals_brute_force(spark, make_docs, odd_texts, block):
    items, docs = fixture(random.Random(3))
    docs += [(200 + i, t) for i, t in enumerate(odd_texts) if t is None or len(t) < 1000] + [(None, items[0][1]), (None, items[0][1]), (0, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = S.contamination(make_docs(docs), bench, block_seeds=block).collect()
    key = lambda i, c, cov, best: (i is None, i or 0, c, round(cov, 9), -1 if best is None else best)
    want = []
    for i, t in docs:
        cover = {k: coverage(t, s) for k, s in items if s}
        best = max(cover, key=lambda k: (cover[k], -k))
        want.append(key(i, cover[best] >= 0.8, cover[best], best if cover[best] else None))
    assert sorted(key(r.doc_id, r.contaminated, r.coverage, r.item_id) for r in got) == sorted(want)


def test_short_items_stand_anywhere(spark, make_docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "omega"), (3, "one two three four")], "item_id long, text string")
    docs = make_docs([(1, "here alpha beta gamma again"), (2, "alpha gamma beta"), (3, "the OMEGA!"), (4, "omegas"), (5, "two three four one"),
                      (6, "one two three four " * 3), (7, "beta gamma"), (8, "alpha beta gamma")])
    got = {r.doc_id: (r.contaminated, r.item_id, r.coverage) for r in S.contamination(docs, bench).collect()}
    assert got == {i: (i in best, best.get(i), float(i in best)) for i in range(1, 9) for best in [{1: 1, 3: 2, 6: 3, 8: 1}]}


def test_empty_tables_and_clean(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    docs = make_docs([(1, "x ONE two three four five six seven y"), (2, None), (None, "one two three four five six seven"), (3, "clean text")])
    out = S.clean(docs, bench)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [2, 3]
    assert S.clean(docs, bench.limit(0)).count() == 4
    assert S.contamination(make_docs([]), bench).count() == 0
    assert S.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_query_whole_table(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    seeds = {tuple(words(t)[i:i + 5]) for _, t in items for i in range(len(words(t)) - 4)}
    out = {r.doc_id: r for r in S.op5_benchmark_decontamination(spark, SF0001).collect()}
    assert len(out) == documents.count()
    for r in documents.collect():
        w = words(r.text)
        if any(tuple(w[i:i + 5]) in seeds for i in range(len(w) - 4)):
            assert out[r.doc_id].contaminated == any(coverage(r.text, t) >= 0.8 for _, t in items)
        else:
            assert not out[r.doc_id].contaminated and out[r.doc_id].coverage == 0
