import random
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from claimsmith.llm import language_id, tokenize
from tests.llm.conftest import SF0001
from tests.llm.test_probminhash import brute as near_groups
from tests.llm.test_secret_scan import S as secret_scan
from tests.llm.test_string_tiling import coverage, words


def test_stages_against_plain_versions(spark, documents):
    """Each stage on the rows its predecessor kept, against brute force."""
    items = [r.text for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    seeds = {tuple(words(t)[i:i + 5]) for t in items for i in range(len(words(t)) - 4)}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SF0001)
        assert out.columns == documents.columns and out.dtypes == documents.dtypes
        docs = spark.createDataFrame(out.collect(), documents.schema)
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "language_id":
            assert set(after) == set(before)  # every document here has a language
        elif name == "minhash_near_dedup":
            groups = near_groups(list(before.items()))
            assert set(after) == {i for i, low in groups.items() if i == low}
        elif name == "benchmark_decontamination":
            def leaks(t):
                w = words(t)
                return any(tuple(w[i:i + 5]) in seeds for i in range(len(w) - 4)) and any(coverage(t, s) >= 0.8 for s in items)
            assert set(after) == {i for i, t in before.items() if not leaks(t)}
        else:
            assert set(after) == set(before)
            assert secret_scan.scan(docs).count() == 0
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).collect()
    enc = tokenize.Encoder()
    want = Counter({i: len(enc.encode(t)) + 1 for i, t in after.items()})
    got = Counter()
    for r in packed:
        got[r.doc_id] += r.length
    assert got == want
    whole = corpus_pipeline.run(spark, SF0001).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_odd_rows_pass_through(spark, make_docs, odd_texts, documents):
    rng = random.Random(1)
    sample = [(r.doc_id, r.text, r.lang) for r in documents.limit(120).collect()]
    rows = sample + [(9000 + i, t, "en") for i, t in enumerate(odd_texts)] + [(None, sample[0][1], "en"), sample[3], (None, None, None)]
    rng.shuffle(rows)
    docs = make_docs(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF0001)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert not [r for r in docs.collect() if not r.text or not any(c.isalpha() for c in r.text)]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() >= docs.count()


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF0001).count() == 0


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "pattern_packing"]
    assert language_id.UNKNOWN == "und" and np.uint64 and zlib.crc32(b"") == 0
