"""The corpus operators' queries over whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import decontamination, licenses, lines, packing, repeats, secrets, simhash, tokens, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_suffix_dedup": repeats.op3_suffix_dedup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_benchmark_decontamination": decontamination.op5_benchmark_decontamination,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_line_dedup": lines.op7_line_dedup,
    "op8_secret_scan": secrets.op8_secret_scan,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_token_counts": tokens.op10_token_counts,
}

ORACLE_SQL: dict[str, str] = {"op9_exact_topk": topk.ORACLE}
