"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from namebridge.llm import (
    decontamination,
    filter_audit,
    jaccard_join,
    language_id,
    license_scan,
    lm_scoring,
    quality_ranker,
    quality_rules,
    sentencepiece_codec,
    sharding,
    spelling_variants,
    suffix_dedup,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_recurrent_language": language_id.query,
        "op2_maximum_entropy": lm_scoring.query,
        "op3_virtual_slots": sharding.query,
        "op4_convolutional_toxicity": toxicity.query,
        "op5_license_rules": license_scan.query,
        "op6_sentencepiece": sentencepiece_codec.query,
        "op7_suffix_dedup": suffix_dedup.query,
        "op8_template_decontamination": decontamination.query,
        "op9_line_frequency": quality_rules.query,
        "op10_jaccard_join": jaccard_join.query,
        "op11_spelling_tiles": spelling_variants.query,
        "op12_pairwise_ranking": quality_ranker.query,
        "op13_filter_audit": filter_audit.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_suffix_dedup": suffix_dedup.SQL,
        "op9_line_frequency": quality_rules.SQL,
        "op10_jaccard_join": jaccard_join.SQL,
        "op13_filter_audit": filter_audit.SQL,
    }
