import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from claimsmith.llm import common as C
from claimsmith.llm import probminhash as P
from tests.llm.conftest import SF0001, prose


def shingles(text):
    w = re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    """The larger of probability and plain Jaccard, by the definitions."""
    x = {k: 1 + np.log(v) for k, v in a.items()}
    y = {k: 1 + np.log(v) for k, v in b.items()}
    both = x.keys() & y.keys()
    jp = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in both)
    return max(jp, len(both) / len(x.keys() | y.keys()) if both else 0)


def brute(rows):
    """id -> smallest id of its group."""
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    known = [(i, t, shingles(t)) for i, t in rows if i is not None and t]
    for k, (i, t, a) in enumerate(known):
        for j, s, b in known[k + 1:]:
            if t == s or (a and b and (a == b or similarity(a, b) >= 0.8)):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def corpus(rng):
    rows, k = [], 0
    passage = prose(rng, 40)
    for g in range(12):
        base = prose(rng, rng.randint(60, 160)).split()
        rows.append((k, " ".join(base)))
        for _ in range(rng.randint(0, 4)):
            k += 1
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 60))):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(99))
            rows.append((k, " ".join(w)))
        k += 1
        rows.append((k, prose(rng, 80) + " " + passage + " " + prose(rng, 60)))
        k += 1
    return rows


def test_groups_equal_brute_force(spark, make_docs, odd_texts):
    rng = random.Random(2)
    rows = corpus(rng)
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts)]
    rows += [(2000, "ONE!"), (2001, "!!!"), (2002, ""), (2003, None), (None, rows[0][1]), (5, rows[5][1]), (2004, rows[3][1].upper() + " !")]
    got = {r.doc_id: r.class_id for r in P.near_duplicates(make_docs(rows)).collect()}
    assert got == brute(rows)


def test_query_whole_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = P.op2_minhash_near_dedup(spark, SF0001).collect()
    assert {r.doc_id: r.class_id for r in out} == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in out) and len(out) == len(rows)


def test_large_group_of_near_copies_is_one_class(spark, make_docs):
    rng = random.Random(4)
    base = prose(rng, 200).split()
    rows = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(rng, 100)) for i in range(50)]
    got = {r.doc_id: r.class_id for r in P.near_duplicates(make_docs(rows)).collect()}
    assert all(got[i] == 0 for i in range(300)) and all(got[1000 + i] == 1000 + i for i in range(50))


def test_keep_one_row_a_group(spark, make_docs):
    text = prose(random.Random(6), 50)
    docs = make_docs([(3, text), (1, text), (1, text), (7, "other text here"), (None, text), (None, None), (9, None)])
    out = P.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 7), (False, 9), (True, 0), (True, 0)]
    assert P.keep_one(make_docs([])).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 44, 300).astype(np.uint64)
    wa, wb = rng.uniform(0.5, 3, 200), rng.uniform(0.5, 3, 200)
    a, b = keys[:200], keys[100:]
    e = np.concatenate([a, b])
    z = P.sketch(e, np.repeat([0, 1], 200), np.concatenate([wa, wb]), 2, 4096)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    both = x.keys() & y.keys()
    true = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in both)
    assert abs((z[0] == z[1]).mean() - true) < 0.03


def test_exact_similarity_equals_definition():
    rng = random.Random(3)
    for _ in range(30):
        a = [rng.randrange(12) for _ in range(rng.randint(1, 20))]
        b = [rng.randrange(12) for _ in range(rng.randint(1, 20))]
        jp, plain = P.jaccards(np.array(a, np.uint64), np.array(b, np.uint64))
        assert abs(max(jp, plain) - similarity(Counter(a), Counter(b))) < 1e-9


def test_word_hashes_ignore_windows(monkeypatch):
    import pyarrow as pa
    texts = pa.array(["Some words, é here", None, "", "x" * 300 + " tail", "a-b c"], pa.large_string())
    w, off = C.word_hashes(texts)
    monkeypatch.setattr(C, "CHUNK_BYTES", 16)
    w2, off2 = C.word_hashes(texts)
    assert w.tolist() == w2.tolist() and off.tolist() == off2.tolist() == [0, 4, 4, 4, 6, 9]


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, 1000 + i) for i in range(1, 200)] + [(i, i + 1) for i in range(2000, 2040)]
    up = {}

    def root(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    want = {i: root(i) for i in list(up)}
    got = {r.id: r.component for r in C.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want


def test_plain_bands_of_strongly_repeated_lines():
    """Of pairs with equal shingle sets, all share a band, however often one repeats some."""
    rng = np.random.default_rng(7)
    pairs, distinct, most = 60, 100, 1000
    grams = rng.integers(0, 1 << 44, (pairs, distinct)).astype(np.uint64)
    element, row = np.tile(grams, (2, 1)).ravel(), np.repeat(np.arange(2 * pairs), distinct)
    count = np.where((row >= pairs) & (np.tile(np.arange(distinct), 2 * pairs) < 20), most, 1)
    z, plain, repeats = P.sketches(element, row, count, 2 * pairs, P.BANDS * P.BAND_ROWS)
    assert not repeats[:pairs].any() and repeats[pairs:].all()
    assert (z[:pairs] == plain[:pairs]).all() and (plain[:pairs] == plain[pairs:]).all()
    assert (z[:pairs] == z[pairs:]).mean() < 0.685


def test_texts_that_repeat_lines_equal_brute_force(spark, make_docs):
    """Copies that repeat a passage many times, some of them where neither is the first of a band."""
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = prose(rng, 100)
        loop = prose(rng, 24) + " "
        for k, times in enumerate((2, 300, 60)):
            rows.append((10 * g + k, base + " " + loop * times))
    got = {r.doc_id: r.class_id for r in P.near_duplicates(make_docs(rows)).collect()}
    assert got == brute(rows) == {10 * g + k: 10 * g for g in range(12) for k in range(3)}


def test_blocks_let_pairs_past_that_only_the_plain_measure_links():
    rng = random.Random(10)
    base, loop = prose(rng, 100), prose(rng, 24) + " "
    texts = pa.array([base + " " + loop * 2, base + " " + loop * 300], pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), texts], names=["id", "text"])
    profile = next(P._profiles(iter([batch]), P.BANDS, P.BAND_ROWS))
    keys = np.stack([np.asarray(x) for x in profile.column(1).to_numpy(zero_copy_only=False)])
    links = 0
    for band in np.intersect1d(keys[0], keys[1]):
        more = {"band": [band] * 2, "component": [1, 2], "own": [0, 0], "bi": [0, 0], "bj": [0, 0]}
        table = pa.Table.from_batches([profile])
        for name, values in more.items():
            table = table.append_column(name, pa.array(values, pa.int64()))
        links += P._block(0.8)(table).num_rows
    assert links == 1


def two_texts():
    """Ids with two unlike texts, one of them with a near copy under another id."""
    rng = random.Random(11)
    rows = []
    for g in range(8):
        a, b = prose(rng, 120), prose(rng, 120)
        rows += [(10 * g, a), (10 * g, b), (10 * g + 1, b + " tail"), (10 * g + 2, a + " end"), (10 * g + 3, prose(rng, 90))]
    return rows


def test_an_id_with_two_texts_has_the_links_of_both(spark, make_docs):
    rows = two_texts()
    got = {r.doc_id: r.class_id for r in P.near_duplicates(make_docs(rows)).collect()}
    assert got == brute(rows) == {10 * g + k: 10 * g + (3 if k == 3 else 0) for g in range(8) for k in range(4)}


def test_keep_one_keeps_unlike_texts_of_one_id(spark, make_docs):
    rows = two_texts()
    rows += [(500, rows[0][1].upper()), (600, None), (600, ""), (600, None), (700, rows[4][1]), (700, rows[4][1] + " more")]
    got = sorted(((r.doc_id, r.text) for r in P.keep_one(make_docs(rows)).collect()), key=str)
    assert got == sorted([t for g in range(8) for t in (rows[5 * g], rows[5 * g + 1], rows[5 * g + 4])] + [(600, None), (600, "")], key=str)
