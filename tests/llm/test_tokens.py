import random
import zlib
from collections import Counter as Bag

import numpy as np
import pytest

from claimsmith.llm import bpe_count, pattern_packing, pieces, token_files, tokenize
from tests.llm.conftest import SF0001


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenize.tokenizer_path())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def strange(rng):
    pool = [chr(i) for i in range(0x2100)] + list("😀漢\u3000\ufeff\U00020000")
    return "".join(rng.choice(pool if rng.random() < 0.4 else "  \n\tab1'sé ,.") for _ in range(rng.randint(1, 16))) + rng.choice(["", "", "<|endoftext|>", "<|endoftext|> x"])


def test_counts_and_ids_equal_the_library(library, odd_texts, monkeypatch):
    rng = random.Random(1)
    texts = [strange(rng) for _ in range(1500)] + odd_texts
    want = [ids_of(library, t) for t in texts]
    monkeypatch.setattr(tokenize, "LONG", 64)
    monkeypatch.setattr(tokenize, "MEMORY", 500)
    monkeypatch.setattr(bpe_count, "MEMORY", 500)
    count, enc = bpe_count.Counter(), tokenize.Encoder()
    assert [count.count(t) for t in texts] == [len(w) for w in want]
    for lo in range(0, len(texts), 50):
        assert [a.tolist() for a in enc.encode_many(texts[lo:lo + 50])] == want[lo:lo + 50]


def test_piece_boundaries_equal_the_pattern():
    split, rng = tokenize.piece_splitter(), random.Random(5)
    pool = list("  \n\t\r'''.,!srtvemldaZéß9²1ñ-_\"¡")
    for _ in range(600):
        texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 25))) for _ in range(rng.randint(1, 12))]
        whole, size = "".join(texts), np.cumsum([0] + [len(t) for t in texts])
        code = np.frombuffer(whole.encode("utf-16-le"), "<u2")
        cut = np.append(pieces.piece_starts(code, size[:-1]), len(code)).tolist()
        assert [whole[a:b] for a, b in zip(cut, cut[1:])] == [p for t in texts for p in split(t)]


def test_piece_table_forgets_the_latest_and_grows():
    table = pieces.PieceTable(np.dtype("<u2"), 100)
    rng = np.random.default_rng(1)
    known = {}
    for _ in range(20):
        table.shrink()
        h = np.unique(rng.integers(1, 1 << 63, 90).astype(np.uint64))
        h = h[table.find(h) < 0]
        ids = [rng.integers(0, 9, int(rng.integers(1, 5))) for _ in h]
        table.add(h, np.array([len(x) for x in ids]), np.concatenate(ids))
        known |= {int(k): x.tolist() for k, x in zip(h, ids)}
        flat, before = table.ids(table.find(h))
        assert [flat[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == [known[int(k)] for k in h]
    table.shrink()
    assert table.n == 75 and (table.find(np.array([1, 2, 3], np.uint64)) == -1).all()


def test_count_query_whole_table(spark, library, documents):
    got = {r.doc_id: r for r in bpe_count.op7_token_counts(spark, SF0001).collect()}
    assert len(got) == documents.count()
    for r in documents.collect():
        n = len(ids_of(library, r.text))
        assert (got[r.doc_id].n_bytes, got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (len(r.text.encode()), n, n > 1024)


def test_counts_keep_every_row(spark, make_docs, odd_texts):
    docs = make_docs([(i, t) for i, t in enumerate(odd_texts)] + [(None, "x"), (0, "x"), (0, "x")])
    assert bpe_count.token_counts(docs).count() == len(odd_texts) + 3
    assert bpe_count.token_counts(make_docs([])).count() == 0


def files_brute(library, rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(library, t) + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, library, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = token_files.op8_token_files(spark, SF0001).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == files_brute(library, rows)


def test_files_with_odd_rows_and_small_shards(spark, library, make_docs, odd_texts):
    rows = [(3 * i - 20, t) for i, t in enumerate(odd_texts)] + [(None, "null id"), (None, None)] + [(1, "same")] * 5
    shards = token_files.write_shards(make_docs(rows), shard_ids=8)
    got = token_files.read_documents(shards).collect()
    assert Bag((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Bag((a, n, c) for a, _, n, c in files_brute(library, rows))
    end = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    text = dict(rows)[-20 + 15]
    assert token_files.lookup(shards, -5)[0].tolist() == ids_of(library, text) + [0]
    assert token_files.lookup(shards, 10 ** 12) == []
    assert token_files.read_documents(token_files.write_shards(make_docs([]))).count() == 0


def test_perfect_hash_is_minimal_and_fingerprints_refuse():
    keys = np.unique(np.random.default_rng(0).integers(-2 ** 62, 2 ** 62, 20_000))
    h = token_files.PerfectHash.build(keys)
    assert sorted(h.numbers(keys).tolist()) == list(range(len(keys)))
    shard = token_files.Shard(token_files.shard_image(0, 0, keys.tolist(), [np.array([k % 1000], "<u2") for k in keys]))
    assert all(shard.get(int(k)).tolist() == [k % 1000] for k in keys[:200])
    strangers = np.arange(5_000, dtype=np.int64)
    assert (shard.documents(strangers) < 0).all()


def packing_holds(library, rows, got):
    want = []
    for i, t in rows:
        ids = ids_of(library, t) + [2]
        for p, (a, n) in enumerate(pattern_packing.cuts(len(ids), 1024)):
            want.append((i, p, a, n, zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes())))
    assert Bag((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Bag(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for a, n in sorted(places):
            assert a == end
            end += n
        assert end <= 1024
    return len(by), sum(w[3] for w in want)


def test_packing_query_whole_table(spark, library, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    n, tokens = packing_holds(library, rows, pattern_packing.op10_pattern_packing(spark, SF0001).collect())
    assert n <= 1.03 * tokens / 1024 + 2


def test_packing_of_odd_rows(spark, library, make_docs, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, None), (None, "a"), (4, "same")] + [(4, "same")] * 30
    packing_holds(library, rows, pattern_packing.pack(pattern_packing.pieces(make_docs(rows))).collect())
    assert pattern_packing.pack(pattern_packing.pieces(make_docs([]))).count() == 0


def test_packed_sequences_hold_the_ids(spark, library, make_docs):
    docs = make_docs([(i, "some words here " * (i + 1)) for i in range(30)])
    got = sorted(np.frombuffer(r.ids, "<u4").tolist() for r in pattern_packing.packed_sequences(docs).collect())
    assert sum(map(len, got)) == sum(len(ids_of(library, r.text)) + 1 for r in docs.collect()) and all(len(g) <= 1024 for g in got)


def test_plan_uses_every_piece_and_little_more():
    rng = np.random.default_rng(2)
    for shape in (rng.integers(1, 1025, 20_000), rng.integers(1, 30, 3_000), np.full(999, 513), rng.integers(600, 1025, 500), np.array([1])):
        histogram = {int(k): int(v) for k, v in Bag(shape.tolist()).items()}
        plan = pattern_packing.plan(dict(histogram))
        used = Bag()
        for pattern, times in plan:
            assert sum(pattern) <= 1024
            for n in pattern:
                used[n] += times
        assert dict(used) == histogram
    full = {int(k): int(v) for k, v in Bag(rng.integers(1, 1025, 20_000).tolist()).items()}
    assert sum(t for _, t in pattern_packing.plan(dict(full))) <= 1.01 * sum(k * v for k, v in full.items()) / 1024


def test_fit_finds_the_least_squares():
    lengths = np.array([256, 512, 768])
    patterns = pattern_packing.exact_patterns(lengths, 1024)
    assert patterns.tolist() == [[256, 256, 512], [256, 768, 0], [512, 512, 0]]
    h = np.zeros(1025)
    h[[256, 512, 768]] = [50, 70, 30]  # 10 x (256, 256, 512), 30 x (256, 768), 30 x (512, 512)
    assert np.allclose(pattern_packing.nonnegative_fit(patterns, h, 3000), [10, 30, 30], atol=0.2)
