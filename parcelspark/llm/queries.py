"""The registered queries of the subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from parcelspark.llm import (
    bpe, centroids, chat, decontaminate, licenses, line_dedup, lm_scoring, mixing, near_dedup, quality, spelling, substring_dedup, toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_benchmark_decontamination": decontaminate.op1_benchmark_decontamination,
        "op2_license_scans": licenses.op2_license_scans,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_mixing": mixing.op4_mixing,
        "op5_lm_scoring": lm_scoring.op5_lm_scoring,
        "op6_chat_formatting": chat.op6_chat_formatting,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_substring_dedup": substring_dedup.op8_substring_dedup,
        "op9_near_dedup": near_dedup.op9_near_dedup,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_centroid_clustering": centroids.op12_centroid_clustering,
        "op13_bpe_coding": bpe.op13_bpe_coding,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_benchmark_decontamination": decontaminate.OP1_SQL,
        "op3_quality_rules": quality.OP3_SQL,
        "op6_chat_formatting": chat.OP6_SQL,
        "op8_substring_dedup": substring_dedup.OP8_SQL,
    }
