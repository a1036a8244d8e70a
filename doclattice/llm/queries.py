"""The subpackage's registered queries, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from doclattice.llm import decontam, langid, ngram_join, oracle, packing, pii, quality, secrets, sharding, substring, topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": ngram_join.op1,
    "op2_secret_scan": secrets.op2,
    "op3_personal_data": pii.op3,
    "op4_benchmark_decontamination": decontam.op4,
    "op5_language_id": langid.op5,
    "op6_best_fit_packing": packing.op6,
    "op7_substring_dedup": substring.op7,
    "op8_sharding": sharding.op8,
    "op9_quality_classifier": quality.op9,
    "op10_exact_top_k": topk.op10,
}

#: The rest (ownership with lookaround, anchors, models, tokens, heap) is tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": oracle.OP1,
    "op4_benchmark_decontamination": oracle.OP4,
    "op7_substring_dedup": oracle.OP7,
    "op10_exact_top_k": oracle.OP10,
}
