import random

import pytest
from pyspark.sql import types as T

SF0001 = "/root/testdata/sf0.001"
WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll larch marsh north ocean pines quill river stone thorn umber vale willow yarrow zephyr".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(1000)) for _ in range(n))


DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                    + [T.StructField(c, T.StringType()) for c in ("id", "start", "kind", "same", "part", "u", "v", "n", "count", "label", "host", "shard", "size")])


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, lang]) tuples -> documents with extra columns whose names the operators use inside."""
    def make(rows):
        full = []
        for r in rows:
            doc_id, text, lang = (*r, "en")[:3] if len(r) < 3 else r
            full.append((doc_id, text, lang, "src", len(text) if text is not None else None, *["x"] * 13))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    rng = random.Random(5)
    return [None, "", " ", "\n\t", "!!!", "one", "two words", "é", "a" * 50_000, prose(rng, 20_000), "\x00nul   sep", "😀 emoji 漢字 ok",
            "it's <|endoftext|> here", "tail  spaces   ", "ÀÉ ñ ß ﬁ İ"]
