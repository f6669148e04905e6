"""The queries of this package and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrina.llm import (bpe, centroids, conversation_repair, exact_dedup, html_main_text, language_id, line_dedup, near_dedup, packing,
                         personal_data, quality_rules, resampling, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_resampling": resampling.op3_resampling,
    "op4_main_text": html_main_text.op4_main_text,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_packing": packing.op9_packing,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_personal_data": personal_data.op11_personal_data,
    "op12_centroids": centroids.op12_centroids,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op6_near_dedup": near_dedup.OP6_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_conversation_repair": conversation_repair.OP13_SQL,
}
