"""Registered queries of the text operators, with comparison SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import (
    bpe, html_text, langid, lexical, licenses, maxent, merkle, negatives, ngram_join, packing, quality, substring,
    url_templates,
)
from tradewind.llm.common import read_table

Run = Callable[[SparkSession, str], DataFrame]


def _over(table: str, run: Callable[[DataFrame], DataFrame]) -> Run:
    return lambda spark, sf_dir: run(read_table(spark, sf_dir, table))


QUERIES: dict[str, Run] = {
    "op1_lm_scoring": _over("documents", maxent.op1_lm_scoring),
    "op2_best_fit_packing": _over("documents", packing.op2_best_fit_packing),
    "op3_substring_dedup": _over("documents", substring.op3_substring_dedup),
    "op4_license_scan": _over("documents", licenses.op4_license_scan),
    "op5_ngram_jaccard_join": _over("documents", ngram_join.op5_ngram_jaccard_join),
    "op6_language_id": _over("documents", langid.op6_language_id),
    "op7_merkle_fingerprints": _over("documents", merkle.op7_merkle_fingerprints),
    "op8_html_extraction": _over("pages", html_text.op8_html_extraction),
    "op9_quality_rules": _over("documents", quality.op9_quality_rules),
    "op10_byte_bpe": _over("documents", bpe.op10_byte_bpe),
    "op11_hard_negatives": _over("embeddings", negatives.op11_hard_negatives),
    "op12_url_filter": _over("pages", url_templates.op12_url_filter),
    "op13_ranked_search": lambda spark, sf_dir: lexical.op13_ranked_search(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")),
}
SQL: dict[str, str] = {
    "op9_quality_rules": quality.OP9_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_url_filter": url_templates.OP12_SQL,
    "op13_ranked_search": lexical.OP13_SQL,
}
