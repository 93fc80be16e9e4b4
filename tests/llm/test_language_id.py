import random
import zlib

import pyarrow as pa

from claimsmith.llm import language_id as L
from tests.llm.conftest import SF0001

TONGUES = {"aa": "bado kemi lura", "bb": "xyste qwert plonk", "cc": "ñandu élan çava"}


def text(rng, lang, n=30):
    return " ".join(rng.choice(TONGUES[lang].split()) for _ in range(n))


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_whole_table(spark, documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    out = L.op9_language_id(spark, SF0001).collect()
    assert len(out) == len(truth) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in out)
    some = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in some) >= 0.97 * len(some)


def test_odd_rows(spark, make_docs, odd_texts):
    rng = random.Random(1)
    rows = [(i, text(rng, k), k) for i, k in enumerate(sorted(TONGUES) * 60)] + [(5000 + i, t, "aa") for i, t in enumerate(odd_texts)]
    rows += [(None, text(rng, "bb"), "bb"), (7000, text(rng, "cc"), None), (0, rows[0][1], "aa")]
    docs = make_docs(rows)
    out = L.identify(docs, L.train(docs))
    assert out.columns == docs.columns + ["lang_pred", "score"] and out.count() == len(rows)
    for r in out.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
        if r.doc_id is None or r.doc_id < 5000 or r.doc_id == 7000:
            assert r.lang_pred == next(k for k in TONGUES if r.text.split()[0] in TONGUES[k])


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "words", None), (2, None, "aa"), (None, "words", "aa")])
    assert {r.lang_pred for r in L.identify(docs, L.train(docs)).collect()} == {"und"}
    assert L.identify(make_docs([]), L.train(make_docs([]))).count() == 0


def test_held_out_rows_are_not_learned(spark, make_docs):
    ids = [i for i in range(400) if held(i)]
    docs = make_docs([(i, "bado kemi", "only") for i in ids])
    assert L.train(docs).languages == []


def test_grams_equal_plain_loop():
    texts = ["Ab1c, é!", None, "", "...", "x", "two  words", "1a"]
    feature, row, some = L.grams(pa.array(texts, pa.large_string()))
    for i, t in enumerate(texts):
        chars = []
        for c in (t or "").lower():
            if c.isalpha():
                chars.append(c)
            elif chars and chars[-1] != " ":
                chars.append(" ")
        n = len(chars)
        assert (row == i).sum() == sum(max(0, n - k) for k in range(3))
        assert some[i] == any(c.isalpha() for c in t or "")


def test_weights_are_sparse_and_temperature_calibrates(spark, make_docs):
    rng = random.Random(2)
    docs = make_docs([(i, text(rng, k), k) for i, k in enumerate(sorted(TONGUES) * 100)])
    model = L.train(docs)
    assert (model.weight != 0).mean() < 0.05 and 0.05 <= model.temperature <= 20


def test_many_labels_keep_the_fit_bounded(spark, make_docs):
    """A dirty column of 3,000 labels: the most frequent ones are learned, the sample stays within its bound."""
    rng = random.Random(3)
    words = {"en": "the and with from house river", "de": "der und mit von haus fluss"}
    rows = [(i, " ".join(rng.choices(words[l].split(), k=20)), l) for i, l in enumerate(["en", "de"] * 150)]
    rows += [(1000 + i, f"noise {i}", f"x{i}") for i in range(3000)]
    docs = make_docs(rows)
    model = L.train(docs, max_sample=200, max_languages=2)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: r.lang_pred for r in L.identify(docs.where("doc_id < 300"), model).collect()}
    assert got == {i: l for i, _, l in rows[:300]}
