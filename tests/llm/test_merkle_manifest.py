"""The manifest against a plain recursive tree over lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from claimsmith.llm import merkle_manifest as M
from tests.llm.conftest import SF0001


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text) -> str:
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(digests):
    """(root, the siblings before and after each leaf, step by step)."""
    steps = [[] for _ in digests]
    under = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 3, len(digests))) for i in range(0, len(digests), 3)]
        for run in runs:
            for k in run:
                for leaf in under[k]:
                    steps[leaf].append(([digests[j] for j in run if j < k], [digests[j] for j in run if j > k]))
        under = [[leaf for k in run for leaf in under[k]] for run in runs]
        digests = [h(*[digests[j] for j in run]) for run in runs]
    return digests[0], steps


def plain_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name], key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text)))
        trees.append((members, *plain_tree([plain_leaf(r, r.text) for r in members])))
    root, above = plain_tree([t[1] for t in trees])
    out = []
    for (members, subroot, steps), over in zip(trees, above):
        for row, own in zip(members, steps):
            text, proof = row.text, own + over
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = plain_leaf(row, text)
            for before, after in proof:
                folded = h(*before, folded, *after)
            out.append((row.doc_id, plain_leaf(row, row.text), subroot, root, h(*[d for b, a in proof for d in b + a]), folded, folded == root))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def query_on(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return M.op11_merkle_manifest(spark, str(tmp_path))


def test_query_equals_plain_tree(spark, documents):
    assert got(M.op11_merkle_manifest(spark, SF0001)) == plain_manifest(documents.collect())


@pytest.mark.parametrize("n", [1, 2, 4, 10])
def test_tree_sizes(spark, make_docs, tmp_path, n):
    """One source around the powers of the run length."""
    docs = make_docs([(i, f"a\nb{i}") for i in range(n)])
    assert got(query_on(spark, tmp_path, docs)) == plain_manifest(docs.collect())


def test_more_rounds_than_one(spark, make_docs, tmp_path):
    """Three full blocks and a lone leaf in a fourth: the lone one is carried up level by level."""
    rng = random.Random(2)
    block = 3 ** M.BLOCK_LEVELS
    rows = [(i, f"t\n{rng.random()}") for i in range(3 * block + 1)]
    docs = make_docs(rows).withColumn("source", F.when(F.col("doc_id") % 100 == 7, F.lit(None)).when(F.col("doc_id") % 100 == 8, "").otherwise("hot"))
    extra = make_docs([(i, f"t\n{i}") for i in range(100)]).withColumn("source", F.concat(F.lit("s"), F.col("doc_id").cast("string")))
    docs = docs.unionAll(extra)
    assert got(query_on(spark, tmp_path, docs)) == plain_manifest(docs.collect())


def test_nulls_repeats_odd_texts_and_clashing_names(spark, make_docs, tmp_path, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(3, "x"), (3, "x"), (3, "y\n"), (None, "n\n"), (None, None)]
    docs = make_docs(rows).withColumns({"lang": F.when(F.col("doc_id") == 1, None).otherwise(F.col("lang")), "tree": F.lit(1), "pos": F.lit(2),
                                        "digest": F.lit("d"), "proof": F.lit(0), "claim": F.lit(0)})
    assert got(query_on(spark, tmp_path, docs)) == plain_manifest(docs.collect())


def test_empty_table(spark, make_docs, tmp_path):
    assert got(query_on(spark, tmp_path, make_docs([]))) == []


def test_proofs_hold_and_changes_are_seen(spark, make_docs):
    docs = make_docs([(i, str(i)) for i in range(20)])
    rows = M.manifest(docs).collect()
    for r in rows:
        assert M.fold(bytes(r.leaf), bytes(r.proof)) == bytes(r.root)
        assert M.fold(bytes(32), bytes(r.proof)) != bytes(r.root)


def test_queue_visits_nodes_in_label_order():
    received = M.send_up(9, [bytes([i]) * 32 for i in range(7)], 2)
    assert list(received) == sorted(received) and received[1, 3] == [bytes([i]) * 32 for i in range(3)] and len(received[1, 5]) == 1
    places = [at for at, _ in M.send_down(received, 2, 1, b"")]
    assert places == list(range(9, 16))
