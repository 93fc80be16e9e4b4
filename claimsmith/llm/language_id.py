"""Language identification: sparse multinomial logistic regression.

Features are character one- to three-grams of the lower-cased letters (any
other run is one blank), hashed to ``2 ** BITS``; their values are relative
frequencies times inverse document frequency.  Document frequencies come
from *all* rows that may be learned from.  The weights are fitted with
follow-the-regularised-leader and an elastic-net penalty on a bounded
sample: about ``PER_LANGUAGE`` rows a language chosen by hash, about ``MAX_SAMPLE``
in all, from the ``MAX_LANGUAGES`` most frequent languages (ties by name), so a
column of many stray labels can't outgrow the driver; most weights stay zero.  A fifth of the sample is kept back
to fit a temperature, so scores are calibrated probabilities.

Null texts and texts without letters: ``und``, score 0.  Rows without a
language are not learned from.  Without any row to learn from, every text is
``und``.  Repeated rows count in the document frequencies and once in the
sample.  Null ids: not held out and not learned from.  Ties between
languages go to the first by name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common as C

BITS = 16
PER_LANGUAGE, MAX_SAMPLE = 400, 8_000
MAX_LANGUAGES = 128  # a weight matrix has 2 ** BITS rows for each
EPOCHS, ALPHA, BETA, L1, L2 = 5, 0.5, 1.0, 0.002, 0.002
SCALE = 20.0  # relative frequencies are small; the learner sees them enlarged
UNKNOWN = "und"
_U = np.uint64
CHUNK = 1 << 18  # bytes of text whose n-grams are held at a time


def letters() -> np.ndarray:
    """Which code points are letters; made once a worker."""
    kept = C.worker_cache("letters")
    if not kept:
        kept["table"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return kept["table"]


def grams(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, row, has a letter by row) of every one- to three-gram."""
    data, off = C.text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    row = np.repeat(np.arange(len(column)), np.diff(place))
    letter = letters()[code]
    some = np.bincount(row[letter], minlength=len(column)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (row[1:] == row[:-1])  # one blank after a run of letters
    keep &= some[row]
    code, row = np.where(letter, code, 32)[keep].astype(np.uint64), row[keep]
    feature, rows = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, 4):
        h = h[:len(code) - n + 1] * _U(0x100000001B3) + code[n - 1:]
        if not len(h):
            break
        ok = row[:len(h)] == row[n - 1:]
        x = (h + _U(n)) * _U(0x9E3779B97F4A7C15)
        feature.append((((x ^ (x >> _U(32))) * _U(0xD1342543DE82EF95)) >> _U(64 - bits))[ok].astype(np.int64))
        rows.append(row[:len(h)][ok])
    if not feature:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), some
    return np.concatenate(feature), np.concatenate(rows), some


def _frequencies(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """A task's document frequencies: (feature, rows that hold it), and (-1, rows)."""
    C.start_task("letters")
    df, n, seen = np.zeros(1 << bits, np.int64), 0, np.zeros(1 << bits, bool)
    for batch in batches:
        for _, text in C.chunks(batch.column(0), CHUNK):
            feature, row, some = grams(text, bits)
            n += int(some.sum())
            order = np.argsort(row, kind="stable")
            feature, row = feature[order], row[order]
            cut = np.searchsorted(row, np.arange(len(text) + 1))
            for a, b in zip(cut[:-1], cut[1:]):
                if b > a:
                    seen[feature[a:b]] = True
                    df += seen
                    seen[feature[a:b]] = False
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["feature", "n"])


def _counted(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(lang, features, counts) of each row with a letter."""
    for batch in batches:
        out = []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            feature, _, _ = grams(pa.array([text.as_py()], pa.large_string()), bits)
            if len(feature):
                f, c = np.unique(feature, return_counts=True)
                out.append({"lang": lang, "f": f.tolist(), "c": c.tolist()})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("lang", pa.string()), ("f", pa.list_(pa.int32())), ("c", pa.list_(pa.int32()))]))


class Model:
    """Weights by feature and language (idf and scale folded in), bias, temperature."""

    def __init__(self, languages: list[str], weight: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.weight, self.bias, self.temperature = languages, weight, bias, temperature

    def logits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        bits = int(len(self.weight)).bit_length() - 1
        feature, row, some = grams(column, bits)
        n = np.maximum(1, np.bincount(row, minlength=len(column)))
        out = np.stack([np.bincount(row, w[feature], len(column)) for w in self.weight.T], axis=1) / n[:, None]
        return out + self.bias, some

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        if not self.languages:
            return [UNKNOWN] * len(column), [0.0] * len(column)
        logits, some = self.logits(column)
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return ([self.languages[b] if s else UNKNOWN for b, s in zip(best, some)],
                [float(v) if s else 0.0 for v, s in zip(p.max(axis=1), some)])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, n_features: int, n_labels: int,
         epochs: int = EPOCHS, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by per-coordinate follow-the-regularised-leader with elastic net."""
    z, s = np.zeros((n_features + 1, n_labels)), np.zeros((n_features + 1, n_labels))  # the last row is the bias

    def weights(f):
        zf = z[f]
        return -np.sign(zf) * np.maximum(0.0, np.abs(zf) - L1) / ((BETA + np.sqrt(s[f])) / ALPHA + L2)

    target = np.eye(n_labels)
    rng = np.random.default_rng(seed)
    rows = [(np.append(f, n_features), np.append(x, 1.0)) for f, x in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, x = rows[i]
            w = weights(f)
            g = x[:, None] * (softmax(x @ w) - target[label[i]])[None, :]
            before = s[f]
            after = before + g * g
            z[f] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            s[f] = after
    w = weights(np.arange(n_features + 1))
    return w[:-1], w[-1]


def fitted_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least log loss, between 1/20 and 20."""
    if not len(label):
        return 1.0
    loss = lambda t: -np.log(np.maximum(1e-12, softmax(logits / t)[np.arange(len(label)), label])).mean()
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    return float(min(grid, key=lambda t: (loss(t), abs(np.log(t)))))


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that a model may learn from, as far as the id decides; null for null ids."""
    return F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "UTF-8")) % 3 != 1


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", bits: int = BITS,
          per_language: int = PER_LANGUAGE, max_sample: int = MAX_SAMPLE, max_languages: int = MAX_LANGUAGES) -> Model:
    rows = docs.where(learnable(id_col)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"),
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`")).alias("h")).where("lang is not null and text is not null")
    # The bounded frame of languages that are learned; the whole column never reaches the driver.
    size = (docs.where(learnable(id_col)).groupBy(F.col(f"`{lang_col}`").cast("string").alias("lang")).agg(F.count("*").alias("n"))
            .where("lang is not null").orderBy(F.desc("n"), "lang").limit(max_languages).collect())
    if not size:
        return Model([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0)
    df = np.zeros(1 << bits)
    total = 1
    for r in (rows.select("text").mapInArrow(lambda it: _frequencies(it, bits), "feature long, n long")
              .groupBy("feature").agg(F.sum("n").alias("n")).collect()):  # at most 2 ** bits rows
        if r["feature"] < 0:
            total = max(1, r["n"])
        else:
            df[r["feature"]] = r["n"]
    idf = np.log((1 + total) / (1 + df)) + 1.0
    want = min(per_language, max(1, max_sample // len(size)))
    share = docs.sparkSession.createDataFrame([(r["lang"], int(min(1.0, want / r["n"]) * (1 << 30))) for r in size], "lang string, share long")
    chosen = (rows.join(F.broadcast(share), "lang")  # max_languages rows at most
              .where(F.pmod("h", F.lit(1 << 30)) < F.col("share")).dropDuplicates(["h"]))
    sample = (chosen.select("lang", "text").mapInArrow(lambda it: _counted(it, bits), "lang string, f array<int>, c array<int>")
              .toPandas())
    languages = sorted(set(sample["lang"]))
    if not languages:
        return Model([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0)
    vectors = [(np.asarray(f), SCALE * np.asarray(c) / np.sum(c) * idf[np.asarray(f)]) for f, c in zip(sample["f"], sample["c"])]
    label = np.array([languages.index(x) for x in sample["lang"]])
    # In an order that doesn't depend on how the rows were dealt to tasks.
    order = sorted(range(len(label)), key=lambda i: (label[i], vectors[i][1].sum(), len(vectors[i][0])))
    back = np.array([i for k, i in enumerate(order) if k % 5 == 4], np.int64)
    fit = np.array([i for k, i in enumerate(order) if k % 5 != 4], np.int64)
    weight, bias = ftrl([vectors[i] for i in fit], label[fit], 1 << bits, len(languages))
    logits = np.array([vectors[i][1] @ weight[vectors[i][0]] + bias for i in back]).reshape(len(back), len(languages))
    return Model(languages, weight * idf[:, None] * SCALE, bias, fitted_temperature(logits, label[back]))


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_name: str = "lang_pred", score_name: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score as two more columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights a language
    at = docs.columns.index(text_col)

    def run(batches):
        C.start_task("letters")
        for batch in batches:
            lang, score = [], []
            for _, text in C.chunks(batch.column(at), CHUNK):
                p, s = shared.value.predict(text)
                lang += p
                score += s
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, lang_name, score_name])

    from pyspark.sql import types as T
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()), T.StructField(score_name, T.DoubleType())]))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs)
    rows = docs.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "text")
    return identify(rows, model).drop("text")
