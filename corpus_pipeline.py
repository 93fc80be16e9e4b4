"""The corpus pipeline: five stages over ``documents``, each one operator.

A stage takes (spark, docs, sf_dir) and returns a frame that is written and
read back as the next stage's ``docs``.  All but the last keep the columns
of documents.  A stage's intermediate tables are dropped when the next stage
begins, because its output has been written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsmith.llm import common, language_id, pattern_packing, probminhash, secret_scan, string_tiling
from claimsmith.sources import sinks

LEAST_SCORE = 0.5
# Intermediate tables of the stage that ran last.
_tables: list[str] = []


def _stage(f):
    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()  # a stage whose output was never written keeps its tables
        old = [p for p in _tables if not any(p in name for name in read)]
        sinks.drop_stored(spark, old)
        _tables[:] = [p for p in _tables if p not in old]
        known = set(sinks.STORED)
        out = f(spark, docs, sf_dir)
        _tables.extend(p for p in sinks.STORED if p not in known)
        return out
    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language (no letters, or a score under ``LEAST_SCORE``) go."""
    model = language_id.train(docs)
    rows = language_id.identify(docs, model, lang_name="_lang", score_name="_score")
    known = (F.col("_lang") != language_id.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)
    return rows.where(known).select(*docs.columns)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return probminhash.keep_one(docs).select(*docs.columns)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return string_tiling.clean(docs, common.table(spark, sf_dir, "benchmark")).select(*docs.columns)


@_stage
def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret's span becomes a mark; ``n_chars`` follows the text."""
    rows = secret_scan.redact(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences."""
    return pattern_packing.pack(pattern_packing.pieces(docs))


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", remove_secrets),
    ("pattern_packing", pack),
]

# Learned weights, hashing and the tokenizer can't be written in SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        written: list[str] = []
        docs = sinks.materialize(stage(spark, docs, sf_dir), stored=written)
        sinks.drop_stored(spark, before)
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
