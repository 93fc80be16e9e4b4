"""Queries of the training-data operators, one a numbered operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimsmith.llm.bpe_count import op7_token_counts
from claimsmith.llm.hilbert_sharding import op6_hilbert_sharding
from claimsmith.llm.language_id import op9_language_id
from claimsmith.llm.line_dedup import op13_line_dedup
from claimsmith.llm.merkle_manifest import op11_merkle_manifest
from claimsmith.llm.pattern_packing import op10_pattern_packing
from claimsmith.llm.probminhash import op2_minhash_near_dedup
from claimsmith.llm.secret_scan import op1_secret_scan
from claimsmith.llm.spherical_dedup import op4_embedding_near_dedup
from claimsmith.llm.string_tiling import op5_benchmark_decontamination
from claimsmith.llm.token_files import op8_token_files
from claimsmith.llm.url_templates import op3_url_filter
from claimsmith.llm.vector_codes import op12_vector_codes

OPERATORS = [op1_secret_scan, op2_minhash_near_dedup, op3_url_filter, op4_embedding_near_dedup,
             op5_benchmark_decontamination, op6_hilbert_sharding, op7_token_counts, op8_token_files,
             op9_language_id, op10_pattern_packing, op11_merkle_manifest, op12_vector_codes, op13_line_dedup]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}
