"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, embedding_dedup, jaccard, packing, pii, quality, resampling, revisits, search, sharding, token_files, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": pii.op1_personal_data,
    "op2_token_counts": tokens.op2_token_counts,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_packing": packing.op4_packing,
    "op5_revisits": revisits.op5_revisits,
    "op6_quality": quality.op6_quality,
    "op7_embedding_dedup": embedding_dedup.op7_embedding_dedup,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_sharding": sharding.op9_sharding,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
    "op11_ranked_search": search.op11_ranked_search,
    "op12_target_resampling": resampling.op12_target_resampling,
    "op13_token_files": token_files.op13_token_files,
}

ORACLES: dict[str, str] = {"op5_revisits": revisits.OP5_SQL, "op8_decontamination": decontamination.OP8_SQL, "op11_ranked_search": search.OP11_SQL, "op12_target_resampling": resampling.OP12_SQL}
