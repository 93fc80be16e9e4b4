"""Shared lines against plain counting."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from claimsmith.llm import line_dedup as L
from tests.llm.conftest import SF0001, prose

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=10, chars=1):
    texts = [(r.doc_id, (r.text or "").split("\n")) for r in rows]
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs = {}
    for _, lines in texts:
        for k in {key(line) for line in lines}:
            docs[k] = docs.get(k, 0) + 1
    gone = {k for k, n in docs.items() if n >= least and len(k) >= chars}
    out = []
    for doc_id, lines in texts:
        kept = [line for line in lines if key(line) not in gone]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def query_on(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in L.op13_line_dedup(spark, str(tmp_path)).collect()), key=repr)


def test_query_equals_plain_counts(spark, documents):
    assert sorted((tuple(r) for r in L.op13_line_dedup(spark, SF0001).collect()), key=repr) == plain(documents.collect())


def test_lines_around_the_least_count(spark, make_docs, tmp_path):
    """9, 10 and 11 documents; case and white space fold, other letters and inner spaces do not."""
    rng = random.Random(1)
    rows = []
    for i in range(40):
        lines = [prose(rng, 5)] + ["Nine of us"] * (i < 9) + ["  TEN of us\t"] * (i < 10) + ["eleven OF us "] * (i < 11) + ["\x0b hot LINE"] * (i < 30)
        lines += ["ten of us"] * (i == 3) + ["ÄÖ"] * (i < 5) + ["äö"] * (5 <= i < 10) + ["", " \t"] + ["one doc"] * (15 if i == 0 else 0)
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    got = query_on(spark, tmp_path, docs := make_docs(rows))
    assert got == plain(docs.collect()) and got[0][2] > 0


def test_odd_texts_nulls_and_repeats(spark, make_docs, tmp_path, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(5, "same\nrow")] * 9 + [(5, "same\nother")] + [(None, "same\n\x85 x\r")] * 2 + [(None, None), (99, "\n\n")]
    docs = make_docs(rows)
    assert query_on(spark, tmp_path, docs) == plain(docs.collect())


def test_empty_table(spark, make_docs, tmp_path):
    assert query_on(spark, tmp_path, make_docs([])) == []


def test_columns_stay(spark, make_docs):
    docs = make_docs([(i, f"own {i}\nshared") for i in range(12)]).withColumns({"key": F.lit(1), "c0": F.lit("z"), "kept": F.lit(2), "_drop": F.lit(3)})
    rows = L.dedup(docs)
    assert rows.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r.c0, r.kept, r.n_dropped) for r in rows.collect()) == [(i, f"own {i}", "z", 2, 1) for i in range(12)]


@pytest.mark.parametrize("least,fanout,batches", [(1, 2, 5), (3, 2, 7), (4, 3, 4)])
def test_levels_count_like_one_batch(spark, make_docs, least, fanout, batches):
    rng = random.Random(least)
    docs = make_docs([(i, "\n".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 5) for _ in range(4))) for i in range(60)])
    got = L.dedup(docs, least=least, fanout=fanout, batches=batches)
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()), key=repr) == plain(docs.collect(), least)


def test_runs_are_compacted_and_anti_joined(spark):
    keys = lambda *ks: spark.createDataFrame([(bytearray(k),) for k in ks], "key binary")
    runs = L.LineRuns(least=2, fanout=2)
    runs.add(keys(b"a", b"a", b"b"))
    assert [len(level) for level in runs.levels] == [1]
    runs.add(keys(b"a", b"b", b"c"))  # "a" is frequent already and not counted again
    assert [len(level) for level in runs.levels] == [0, 1]
    assert {bytes(r.key): r.docs for r in runs.levels[1][0][0].collect()} == {b"a": 2, b"b": 2, b"c": 1}
    for k in (b"c", b"d", b"d"):
        runs.add(keys(k))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {bytes(r.key) for r in runs.frequent().collect()} == {b"a", b"b", b"c", b"d"}
    runs.release(spark)
    assert runs.levels == []
